"""Language-model scoring by a log-bilinear model trained with noise-contrastive estimation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage

HELD_OUT_OF, HELD_OUT = 7, 2

# Outputs of the neural model: the end, the most frequent words, and one class for all other words.
CLASSES = 1024
WIDTH = 32
LAGS = (1, 2)
LAG_WEIGHTS = (2 / 3, 1 / 3)
NOISE_PER_TOKEN = 10.0
STEPS = 150
LEARNING_RATE = 0.05
SEED = 5

# Words with at least this share of all training tokens go to every task: there can be at most a million.
FREQUENT_SHARE = 1e-6
# A task passes on its counts when it holds so many different words.
HELD_WORDS = 200_000

_END, _OTHER = 0, CLASSES - 1


def is_held_out(doc_id: Column) -> Column:
    """Held out by the CRC of the id; a null id is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def _words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []  # on bytes: A-Z and ASCII white space only


# -- counts over the whole training part


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per task; the null word is the end of a text."""
    held: Counter = Counter()
    ends = 0

    def told(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        ends += batch.num_rows
        for text in batch.column(0).cast(pa.binary()):
            held.update(_words(text.as_py()))
            if len(held) > HELD_WORDS:
                yield told(held)
                held = Counter()
    yield told({**held, None: ends} if ends else held)


def word_counts(train: DataFrame) -> DataFrame:
    """A stored table ``(word, n)`` of all training tokens; the null word stands for the ends."""
    counted = train.select("text").mapInArrow(_count_words, "word binary, n bigint")
    return stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


@dataclass
class Vocabulary:
    """What tasks need of the counts: places of frequent words, their counts, and totals.

    The first ``CLASSES - 2`` words are classes 1 and up; other words are one class, within which they
    share its chance by their counts, one more each, and one for all words never seen.
    """

    places: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    distinct: int
    ends: int
    other_tokens: int
    other_distinct: int

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of each word among the frequent ones, or -1."""
        get = self.places.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    @staticmethod
    def classes(found: np.ndarray) -> np.ndarray:
        """Class of each word, and the end."""
        own = np.where((found >= 0) & (found < CLASSES - 2), found + 1, _OTHER)
        return np.append(own, _END)


def vocabulary(counts: DataFrame, share: float = FREQUENT_SHARE) -> Vocabulary:
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"),
        F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)).alias("ends"),
    ).first()
    frequent = (
        counts.where(F.col("word").isNotNull() & (F.col("n") >= share * totals["n"])).toPandas()
        .sort_values(["n", "word"], ascending=[False, True])
    )
    n = frequent["n"].to_numpy(np.int64)
    top = min(CLASSES - 2, len(n))
    return Vocabulary(
        {bytes(w): i for i, w in enumerate(frequent["word"])}, n, totals["n"], totals["v"], totals["ends"],
        totals["n"] - totals["ends"] - int(n[:top].sum()), totals["v"] - (totals["ends"] > 0) - top,
    )


def _before(classes: np.ndarray, lag: int) -> np.ndarray:
    """The class ``lag`` tokens back; before the text there are ends."""
    return np.concatenate((np.full(min(lag, len(classes)), _END), classes[:-lag]))


def _count_pairs(sent):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        total = np.zeros(len(LAGS) * CLASSES * CLASSES, np.int64)
        waiting: list[np.ndarray] = []

        def add() -> None:
            if waiting:
                total[:] += np.bincount(np.concatenate(waiting), minlength=len(total))
                waiting.clear()

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                own = words.classes(words.find(_words(text.as_py())))
                waiting += [(k * CLASSES + _before(own, lag)) * CLASSES + own for k, lag in enumerate(LAGS)]
                if len(waiting) >= 2000:
                    add()
            add()
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    return rows


def pair_counts(train: DataFrame, words: Vocabulary) -> DataFrame:
    """``(cell, n)``: counts of (class some tokens back, class) over all training tokens, for each lag.

    There are at most ``2 * CLASSES ** 2`` cells, however large the corpus is. Each lag has one at least.
    """
    spark = train.sparkSession
    sent = spark.sparkContext.broadcast(words)
    found = train.select("text").mapInArrow(_count_pairs(sent), "cell bigint, n bigint")
    none = spark.range(len(LAGS)).select((F.col("id") * CLASSES**2).alias("cell"), F.lit(0).cast("bigint").alias("n"))
    return found.unionByName(none).groupBy("cell").agg(F.sum("n").alias("n"))


# -- the model


def train_lag(counts: np.ndarray) -> np.ndarray:
    """Normalised chances of each class after each class, from a log-bilinear model of rank ``WIDTH``.

    The score of class w after class a is r[a] . q[w] + b[w]. Noise-contrastive estimation tells the
    counted pairs from noise drawn from the classes' own shares, ``NOISE_PER_TOKEN`` for each token.
    Since there are finitely many pairs, the objective is summed over all of them with the noise's
    expected counts, without drawing any. One matrix product over all classes then gives the sums that
    normalise the scores.
    """
    n = len(counts)
    rng = np.random.default_rng(SEED)
    shares = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * n)
    after = counts.sum(axis=1, keepdims=True)
    scale = max(counts.sum(), 1.0)
    data = (counts / scale).astype(np.float32)
    noise = (NOISE_PER_TOKEN * after / scale * shares).astype(np.float32)
    offset = np.log(NOISE_PER_TOKEN * shares).astype(np.float32)
    weights = [
        rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32), rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32),
        np.log(shares).astype(np.float32),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        r, q, b = weights
        true = 1 / (1 + np.exp(np.clip(offset - (r @ q.T + b), -30, 30)))
        slope = data - (data + noise) * true
        rate = LEARNING_RATE * (1 - step / (STEPS + 1))
        for k, g in enumerate((slope @ q, slope.T @ r, slope.sum(axis=0))):
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            fixed = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            weights[k] = weights[k] + rate * fixed[0] / (np.sqrt(fixed[1]) + 1e-8)
    r, q, b = weights
    scores = (r @ q.T + b).astype(np.float64)
    scores -= scores.max(axis=1, keepdims=True)
    chances = np.exp(scores)
    return (chances / chances.sum(axis=1, keepdims=True)).astype(np.float32)


@dataclass
class LogBilinear:
    words: Vocabulary
    chances: np.ndarray  # by lag, class before, class

    def score(self, found: np.ndarray, classes: np.ndarray) -> float:
        """log10 probability of a text, but for the counts of words that are not frequent."""
        p = sum(w * c[_before(classes, lag), classes] for w, lag, c in zip(LAG_WEIGHTS, LAGS, self.chances))
        known = found[found >= CLASSES - 2]
        own = np.log10(self.words.counts[known] + 1.0).sum() if len(known) else 0.0
        others = int((classes == _OTHER).sum())
        return float(np.log10(p.astype(np.float64)).sum() + own - others * np.log10(self.other_mass))

    @property
    def other_mass(self) -> float:
        return self.words.other_tokens + self.words.other_distinct + 1.0


def _train_group(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros(CLASSES**2)
    counts[cells["cell"].to_numpy(np.int64) % CLASSES**2] = cells["n"].to_numpy(float)
    chances = train_lag(counts.reshape(CLASSES, CLASSES))
    return pd.DataFrame({"lag": key[0], "before": range(CLASSES), "chances": [row.tobytes() for row in chances]})


def fit(train: DataFrame, words: Vocabulary) -> LogBilinear:
    """A model for each lag, trained in a task of its own on its sums, which are at most ``CLASSES ** 2``."""
    lag = F.floor(F.col("cell") / CLASSES**2).cast("int")
    rows = (
        pair_counts(train, words).groupBy(lag.alias("lag"))
        .applyInPandas(_train_group, "lag int, before int, chances binary").collect()
    )
    chances = np.zeros((len(LAGS), CLASSES, CLASSES), np.float32)
    for row in rows:
        chances[row["lag"], row["before"]] = np.frombuffer(row["chances"], np.float32)
    return LogBilinear(words, chances)


# -- scoring

_PARTS = "row bigint, id bigint, held_out boolean, word binary, n bigint, known bigint, base double, score double"


def _score_rows(sent):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        words = model.words
        log_counts = np.log10(words.counts + 1.0)
        log_end = np.log10(words.ends + 1.0)

        def scored(row: int, text: bytes | None) -> Iterator[tuple]:
            own = _words(text)
            found = words.find(own)
            seen = found[found >= 0]
            base = float(log_counts[seen].sum() + log_end)
            yield row, None, len(own) + 1, len(seen) + (words.ends > 0), base, model.score(found, words.classes(found))
            if len(seen) < len(own):
                for word, n in Counter([own[i] for i in np.flatnonzero(found < 0).tolist()]).items():
                    yield row, word, n, 0, 0.0, 0.0

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                texts = some.column(3).cast(pa.binary()).to_pylist()
                told = [x for i, text in enumerate(texts) for x in scored(i, text)]
                place, word, n, known, base, score = zip(*told)
                place = pa.array(place, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(place), some.column(1).take(place), some.column(2).take(place),
                        pa.array(word, pa.binary()), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                    ],
                    ["row", "id", "held_out", "word", "n", "known", "base", "score"],
                )

    return rows


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Counts and pair counts are taken over all training rows. ``score`` is the log10 probability that the
    model gives the whole text and its end. Each text is scored where it is read. Words that are not
    frequent are passed on with their row, once per row and word, and meet their counts in a join: none
    of them has over a millionth of the training tokens, so no key of the counts is hot, and adaptive
    execution may split what held-out rows repeat. Null and blank texts are their end alone; without
    training rows every token is unseen; repeated rows are scored again; no rows give no rows.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
        is_held_out(F.col(id_column)).alias("held_out"), F.col(text).alias("text"),
    )
    train = rows.where("NOT held_out")
    counts = word_counts(train)
    words = vocabulary(counts)
    model = docs.sparkSession.sparkContext.broadcast(fit(train, words))
    parts = stage(rows.mapInArrow(_score_rows(model), _PARTS), "scores")
    # The null word of the counts is the end, which every text has scored already.
    seen = counts.where("word IS NOT NULL").select("word", F.col("n").alias("c"))
    rare = parts.where("word IS NOT NULL").select("row", "word", "n").join(seen, "word", "left").select(
        "row", F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"),
        (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("extra"),
    )
    extra = rare.groupBy("row").agg(F.sum("known").alias("known_rare"), F.sum("extra").alias("extra"))
    whole = parts.where("word IS NULL").join(extra, "row", "left")
    more = F.coalesce("extra", F.lit(0.0))
    return whole.select(
        "id", "held_out", F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n") * F.lit(float(np.log10(words.tokens + words.distinct + 1)))).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
