"""URL filters: domain rules, then the ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage

ORDER = 5
# Both models are tables of so many hashed cells, which bounds what is sent to the tasks.
CELLS = 1 << 19
# Weight of the shorter context in each estimate, and rows a context needs before it is used.
SMOOTHING = 1.0
LEAST_EVIDENCE = 2
# One labelled URL in so many sets the threshold; of the accepted among them, this share may fall below it.
HELD_OUT = 5
FALSE_REJECTS = 0.01

# The rules (verdict, host and path).
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# Words that mark a host as unwanted where they stand between its dots and hyphens. They label training rows.
REJECT_WORDS = (
    "ads", "adult", "bet", "bets", "betting", "casino", "dating", "gambling", "lottery", "payday", "pharmacy", "pills", "poker", "porn", "sex",
    "spam", "track", "tracker", "tracking", "viagra", "warez", "xxx",
)

_START, _END = b"\x02", b"\x03"
_STEP, _MIX, _CHAR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_EVEN = 1.0 / 256


def host_and_path(url: Column) -> dict[str, Column]:
    """Host (A-Z lowered) and path; both are empty where the URL is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    ascii_lower = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {
        "host": F.coalesce(ascii_lower, F.lit("")), "path": F.coalesce(F.regexp_extract(url, pattern, 2), F.lit("")),
    }


def ruled(rules: tuple[tuple[str, str], ...] = RULES) -> dict[str, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return {"rule": rule, "ruled": verdict}


# -- models


@dataclass
class UrlModel:
    """Counts of hashed contexts and of contexts with their next byte, for accepted (1) and rejected (0)."""

    contexts: np.ndarray
    follows: np.ndarray

    def score(self, urls: list[bytes]) -> np.ndarray:
        """Log-likelihood of accepted less that of rejected, per character (the end counts as one)."""
        if not urls:
            return np.zeros(0)
        chars, own, _ = _laid_out(urls)
        ratio = np.zeros(len(chars))
        for label, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(chars), _EVEN)
            for context, follow in _cells(chars):
                seen = self.contexts[label, context]
                better = (self.follows[label, follow] + SMOOTHING * p) / (seen + SMOOTHING)
                p = np.where(seen >= LEAST_EVIDENCE, better, p)
            ratio += sign * np.log(p)
        scored = own >= 0
        sums = np.bincount(own[scored], ratio[scored], len(urls))
        return sums / np.bincount(own[scored], minlength=len(urls))


def _laid_out(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in a row, each URL after ``ORDER`` start bytes and before an end; whose each byte is (-1: start)."""
    lead = _START * ORDER
    chars = np.frombuffer(b"".join(lead + u + _END for u in urls), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(u) + ORDER + 1 for u in urls), np.int64, len(urls))
    own = np.repeat(np.arange(len(urls)), sizes)
    at = np.arange(len(chars)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return chars, np.where(at < ORDER, -1, own), sizes


def _cells(chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells of each byte's context and of context with byte, for contexts of 0 to ``ORDER`` bytes."""
    context = np.zeros(len(chars), np.uint64)
    shift = np.uint64(64 - int(CELLS).bit_length() + 1)
    for k in range(ORDER + 1):
        if k:
            before = np.concatenate((np.zeros(k, np.uint64), chars[:-k])) if len(chars) > k else np.zeros(len(chars), np.uint64)
            context = (context + before + np.uint64(1)) * _STEP
            context ^= context >> np.uint64(29)
        mixed = (context + np.uint64(k + 1)) * _MIX
        follow = (mixed ^ (mixed >> np.uint64(31))) + (chars + np.uint64(1)) * _CHAR
        follow = (follow ^ (follow >> np.uint64(30))) * _STEP
        yield (mixed >> shift).astype(np.int64), (follow >> shift).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, the counts of each cell: key = ((label * 2) + kind) * CELLS + cell."""
    total = np.zeros(4 * CELLS, np.int64)
    for batch in batches:
        urls, labels = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        chars, own, _ = _laid_out(urls)
        scored = own >= 0
        base = labels[own[scored]].astype(np.int64) * 2 * CELLS
        for context, follow in _cells(chars):
            total += np.bincount(base + context[scored], minlength=4 * CELLS)
            total += np.bincount(base + CELLS + follow[scored], minlength=4 * CELLS)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["cell", "n"])


def fit(labelled: DataFrame) -> UrlModel:
    """Models from all rows ``(url, accepted)``. At most ``4 * CELLS`` sums reach the driver."""
    counts = (
        labelled.select("url", F.col("accepted").cast("int").alias("accepted"))
        .mapInArrow(_count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    )
    table = np.zeros(4 * CELLS, np.float32)
    table[counts["cell"].to_numpy(np.int64)] = counts["n"].to_numpy(np.float32)
    table = table.reshape(2, 2, CELLS)
    return UrlModel(table[:, 0].copy(), table[:, 1].copy())


def scores(rows: DataFrame, model: UrlModel) -> DataFrame:
    """``rows`` (first column ``url``) with ``llr``; a null URL scores as an empty one."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [u or b"" for u in batch.column(0).cast(pa.binary()).to_pylist()]
            llr = pa.array(sent.value.score(urls), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, llr], [*batch.schema.names, "llr"])

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(score, f"{kinds}, llr double")


def calibrate(held_out: DataFrame, false_rejects: float = FALSE_REJECTS) -> float:
    """The threshold that parts rows ``(accepted, llr)`` best while few accepted ones fall below it.

    Scores are counted in bins of a thousandth. Without rows of both kinds nothing is rejected.
    """
    bins = held_out.groupBy(F.floor(F.col("llr") * 1000).alias("bin")).agg(
        F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad")
    ).toPandas().sort_values("bin")
    good, bad = bins["good"].to_numpy(float), bins["bad"].to_numpy(float)
    if not good.sum() or not bad.sum():
        return float("-inf")
    lost = np.concatenate(([0.0], np.cumsum(good))) / good.sum()
    caught = np.concatenate(([0.0], np.cumsum(bad))) / bad.sum()
    value = np.where(lost <= false_rejects, caught - lost, -np.inf)
    best = np.flatnonzero(value == value.max())
    edges = np.concatenate((bins["bin"].to_numpy(float), [bins["bin"].max() + 1])) / 1000
    # Between the bin below the best cut and the one above it, take the middle.
    cut = best[0]
    return float((edges[cut] + edges[max(cut - 1, 0)]) / 2)


def judge(
    pages: DataFrame, id_column: str = "page_id", url: str = "url",
    rules: tuple[tuple[str, str], ...] = RULES, reject_words: tuple[str, ...] = REJECT_WORDS,
) -> DataFrame:
    """``(id, host, path, rule, verdict, llr)`` for every row.

    The longest rule that fits decides. Elsewhere the two models do: both are counted over all labelled
    rows but the held-out ones, which set the threshold. Rejected examples are URLs whose host has one
    of ``reject_words`` between dots and hyphens; accepted ones are all others that no rule blocks, so
    that both models see every domain and language. The models read host and path only. Null URLs and those without ``://`` have neither, score
    zero and are allowed unless the threshold says otherwise; repeated rows are judged alike; without
    examples of both kinds nothing is blocked but by rule; no rows give no rows.
    """
    narrow = pages.select(F.col(id_column).alias("id"), F.col(url).alias("given"))
    parts = narrow.withColumns(host_and_path(F.col("given"))).withColumns(ruled(rules))
    parts = stage(parts.select(F.concat("host", "path").alias("url"), "id", "host", "path", "rule", "ruled"), "urls")
    unwanted = F.arrays_overlap(F.split("host", "[.-]"), F.array(*[F.lit(w) for w in reject_words]))
    accepted = F.when(unwanted, F.lit(False)).when(F.coalesce(F.col("ruled") == "allow", F.lit(True)), F.lit(True))
    labelled = parts.select("url", accepted.alias("accepted")).where("accepted IS NOT NULL")
    held = F.crc32("url") % HELD_OUT == 0
    model = fit(labelled.where(~held))
    limit = calibrate(scores(labelled.where(held), model))
    verdict = F.coalesce("ruled", F.when(F.col("llr") < limit, F.lit("block")).otherwise(F.lit("allow")))
    return scores(parts, model).select("id", "host", "path", "rule", verdict.alias("verdict"), "llr")
