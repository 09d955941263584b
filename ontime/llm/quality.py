"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Everything here is DataFrame expressions and aggregates.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import let, stage, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW_WORDS = 3
# At the start of each word: this word, taken, and ahead of it three words, kept. It never steps back.
_WINDOW = "(?<![^ ])(?=([^ ]++ [^ ]++ [^ ]++))[^ ]++"

# Share of a group that the estimate is drawn from, and the rounds that concentrate it.
CORE_SHARE = 0.75
ROUNDS = 5
# Chance that a document drawn from a normal group is rejected.
REJECT_CHANCE = 1e-3
# Rows that the estimate over all documents weighs beside a group's own.
PRIOR_ROWS = 50
# Statistics are whole multiples of 1/UNIT, so that sums do not depend on their order.
UNIT = 1024
# Squared distances are counted in bins of a 32nd of a power of two when a share of rows is sought.
BINS_PER_DOUBLING = 32
GROUP = ("lang", "source")


def base_statistics(text: Column) -> dict[str, Column]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of whole texts."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    return {
        "n_words": F.size("__words").cast("bigint"),
        "word_chars": F.length(F.concat_ws("", "__words")).cast("bigint"),
        "n_symbols": F.coalesce(F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")), F.lit(0)).cast("bigint"),
        "n_dup_lines": F.coalesce(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("__words")),
    }


def repeated_words(parts: Column) -> Column:
    """Words that lie in a window of three words which the text holds twice or more.

    Most texts repeat nothing and stop at the comparison of the number of distinct windows. Else windows
    are hashed to 64 bits and sorted with their places, so equal ones are neighbours; sorting is all
    this costs, also in a text of one repeated line.
    """
    # Compiled expressions make the windows, not a function for each word, which would take several times as long.
    windows = F.regexp_extract_all(F.concat_ws(" ", parts), F.lit(_WINDOW), F.lit(1))

    def covered(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda w, i: F.struct(F.xxhash64(w).alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            n = F.size(s)
            before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(s, 1, n - 1))
            after = F.concat(F.slice(s, 2, n - 1), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
            sides = F.zip_with(before, after, lambda b, a: F.struct(b["h"].alias("b"), a["h"].alias("a")))
            kept = F.zip_with(
                s, sides, lambda x, y: F.when(x["h"].eqNullSafe(y["b"]) | x["h"].eqNullSafe(y["a"]), x["i"])
            )
            return F.sort_array(F.filter(kept, lambda i: i.isNotNull()))

        def total(at: Column) -> Column:
            following = F.concat(F.slice(at, 2, F.size(at) - 1), F.array(F.lit(2**31 - 1)))
            steps = F.zip_with(at, following, lambda a, b: F.least(b - a, F.lit(WINDOW_WORDS)))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

        return let(let(placed, places), total)

    none = F.lit(0).cast("bigint")
    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(covered(w)))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five statistics and ``base_failed``."""
    parts = F.coalesce(words(F.col(text)), F.array().cast("array<string>"))
    found = docs.withColumn("__words", parts).withColumns(base_statistics(F.col(text)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).drop("__words")


# -- the statistic vector

# Least spread of each coordinate. Most clean texts hold no symbols and repeat nothing, so these two hardly
# vary in the core; a few symbols or a repeated line, or length alone, must not reject a text.
COORDINATES = (
    ("length", 1.0), ("word_length", 0.05), ("symbols", 0.5), ("repeats", 1.0),
)
D = len(COORDINATES)


def vector() -> dict[str, Column]:
    """The statistics, transformed so that ordinary texts spread evenly, in whole multiples of 1/UNIT."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        f"x{k}": F.round(value * UNIT).cast("bigint")
        for k, value in enumerate(
            (
                F.log1p("n_words"),
                F.log1p(F.col("word_chars") / n),
                F.sqrt(100 * F.col("n_symbols") / n),
                F.sqrt(100 * (F.col("n_repeat_words") + F.col("n_dup_lines")) / n),
            )
        )
    }


def chi_square_share(x: float, even_degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    terms = sum((x / 2) ** k / math.factorial(k) for k in range(even_degrees // 2))
    return 1 - math.exp(-x / 2) * terms


def chi_square_point(rest: float, even_degrees: int) -> float:
    """The value that a chi-square variable exceeds with probability ``rest``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        terms = sum((mid / 2) ** k / math.factorial(k) for k in range(even_degrees // 2))
        low, high = (mid, high) if math.exp(-mid / 2) * terms > rest else (low, mid)
    return high


CORE_POINT = chi_square_point(1 - CORE_SHARE, D)
CONSISTENCY = CORE_SHARE / chi_square_share(CORE_POINT, D + 2)
LIMIT = chi_square_point(REJECT_CHANCE, D)

_PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _same(left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}")) for g in GROUP]
    )


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(f"x{i}").alias(f"s{i}") for i in range(D)]
    sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _PAIRS]
    return rows.groupBy(*keys).agg(*sums)


def _estimate(moments: DataFrame, inflate: float) -> DataFrame:
    """Centre and Cholesky factor of every group's covariance, drawn towards that of all groups.

    Each group is pooled with ``PRIOR_ROWS`` rows of the estimate over all groups of its start, and
    every coordinate keeps its least spread, so a group of one row or of equal rows has a factor too.
    """
    over_all = Window.partitionBy("start")
    found = moments
    totals = {f"a_{c}": F.sum(c).over(over_all) for c in ["n", *[f"s{i}" for i in range(D)], *[f"p{i}{j}" for i, j in _PAIRS]]}
    found = found.withColumns(totals)
    n, prior, every = F.col("n").cast("double"), float(PRIOR_ROWS), F.col("a_n").cast("double")
    found = found.withColumns(
        {
            **{f"g{i}": F.col(f"s{i}") / n / UNIT for i in range(D)},
            **{f"o{i}": F.col(f"a_s{i}") / every / UNIT for i in range(D)},
        }
    ).withColumn("w", n / (n + prior))
    cov = {
        f"c{i}{j}": (
            F.col("w") * (F.col(f"p{i}{j}") / n / UNIT**2 - F.col(f"g{i}") * F.col(f"g{j}"))
            + (1 - F.col("w")) * (F.col(f"a_p{i}{j}") / every / UNIT**2 - F.col(f"o{i}") * F.col(f"o{j}"))
        ) * inflate + (COORDINATES[i][1] ** 2 if i == j else 0.0)
        for i, j in _PAIRS
    }
    centre = {f"m{i}": F.col("w") * F.col(f"g{i}") + (1 - F.col("w")) * F.col(f"o{i}") for i in range(D)}
    found = found.withColumns({**cov, **centre})
    for i in range(D):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}")
            found = found.withColumn(f"l{i}{j}", value)
    log_det = reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in range(D)])
    return found.withColumn("log_det", log_det).select("start", *GROUP, "n", "log_det", *_FACTOR)


_FACTOR = [*[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i, j in _PAIRS]]


def squared_distance() -> Column:
    """Mahalanobis distance squared, by forward substitution through the Cholesky factor."""
    solved: list[Column] = []
    for i in range(D):
        rest = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, [z * z for z in solved])


def _measured(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Rows beside their group's estimate for each start, with distance and distance bin."""
    joined = rows.alias("r").join(estimate.alias("e"), _same("r", "e")).select("r.*", *[F.col(f"e.{c}") for c in ("start", *_FACTOR)])
    found = joined.withColumn("d2", squared_distance())
    step = F.floor(F.log2(F.greatest(F.col("d2"), F.lit(2.0**-20))) * BINS_PER_DOUBLING).cast("int")
    return found.withColumn("bin", step).drop(*_FACTOR)


def _core_bins(measured: DataFrame) -> DataFrame:
    """Per group and start, the bin with which the core share of its rows is reached."""
    counts = measured.groupBy("start", *GROUP, "bin").agg(F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy("start", *GROUP)
    reached = counts.withColumns(
        {"so_far": F.sum("rows").over(own.orderBy("bin")), "all": F.sum("rows").over(own)}
    )
    return reached.where(F.col("so_far") >= CORE_SHARE * F.col("all")).groupBy("start", *GROUP).agg(
        F.min("bin").alias("core_bin")
    )


def _medians(rows: DataFrame) -> DataFrame:
    """First start: per group, the middle of each coordinate with the spread of the middle half, uncorrelated."""
    one = rows.select(*GROUP, F.posexplode(F.array(*[F.col(f"x{i}") for i in range(D)])).alias("k", "x"))
    # Values are whole multiples of 1/UNIT and bounded, so counting them is exact and mergeable.
    counts = one.groupBy(*GROUP, "k", F.floor(F.col("x") / 16).alias("x")).agg(F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy(*GROUP, "k")
    counts = counts.withColumns({"so_far": F.sum("rows").over(own.orderBy("x")), "all": F.sum("rows").over(own)})
    at = lambda q: F.min(F.when(F.col("so_far") >= q * F.col("all"), F.col("x"))) * 16 / UNIT
    quarters = counts.groupBy(*GROUP, "k").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    per = quarters.groupBy(*GROUP).agg(
        *[F.max(F.when(F.col("k") == i, F.col("q2"))).alias(f"m{i}") for i in range(D)],
        *[
            F.max(F.when(F.col("k") == i, F.sqrt(F.pow((F.col("q3") - F.col("q1")) / 1.349, 2) + floor**2))).alias(f"l{i}{i}")
            for i, (_, floor) in enumerate(COORDINATES)
        ],
    )
    zero = {f"l{i}{j}": F.lit(0.0) for i, j in _PAIRS if i != j}
    return per.withColumns(zero).select(F.lit("median").alias("start"), *GROUP, *_FACTOR)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Centre and scatter per language and source, of least determinant over two starts.

    ``rows`` is a stored table of statistic vectors. One start is the median and middle half of each
    coordinate, the other the plain mean and covariance. Each round keeps the ``CORE_SHARE`` of a
    group's rows that lie nearest and estimates again from those (a concentration step, which cannot
    raise the determinant but for bin width and the pull towards all groups). Only sums and counts per
    group are shuffled, made partial first, however many rows one source holds.
    """
    plain = _estimate(_moments(rows.withColumn("start", F.lit("mean")), "start", *GROUP), 1.0)
    estimate = stage(
        plain.select("start", *GROUP, *_FACTOR).unionByName(_medians(rows)).coalesce(1), "estimates"
    )
    for _ in range(ROUNDS):
        measured = _measured(rows, estimate)
        bins = stage(_core_bins(measured).coalesce(1), "cores")
        core = (
            measured.alias("r").join(bins.alias("b"), _same("r", "b") & (F.col("r.start") == F.col("b.start")))
            .where("r.bin <= b.core_bin").select("r.*")
        )
        estimate = stage(_estimate(_moments(core, "start", *GROUP), CONSISTENCY).coalesce(1), "estimates")
    best = estimate.groupBy(*GROUP).agg(F.min_by(F.struct("start", *_FACTOR), F.struct("log_det", "start")).alias("best"))
    return stage(best.select(*GROUP, "best.*").coalesce(1), "estimates")


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with statistics, ``base_failed``, squared distance ``d2`` and ``kept``.

    The estimates are drawn from the documents that pass the base rules; those are rejected whose
    squared distance from their group exceeds ``LIMIT``. A null language or source is a group of its
    own; a null or blank text has no words and fails; repeated rows are judged alike; a group of any
    size has an estimate, as it is pooled with that of all documents; no rows give no rows. Columns of
    ``docs`` may have any names; one with the name of a result is not in the result twice, see
    :func:`keep_good` for all columns as they were.
    """
    judged = _judged_rows(docs, text)
    results = [c for c in judged.columns if c not in ("doc", *GROUP)]
    return judged.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in results], *results)


def _judged_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row as ``doc``, beside its statistics and verdict. Both are stored together, so texts are read once."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *GROUP, F.col(text).alias("text"))
    own = stage(statistics(rows).withColumns(vector()).drop("text"), "statistics")
    return _judged(own, own.where(~F.col("base_failed")).select(*GROUP, *[f"x{i}" for i in range(D)]))


def judged_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """As ``judge``, for an id and the statistics only: texts are read once, statistics are stored."""
    own = stage(statistics(docs, text).withColumns(vector()).drop(text), "statistics")
    return _judged(own, own.where(~F.col("base_failed")).select(*GROUP, *[f"x{i}" for i in range(D)]))


def _judged(own: DataFrame, rows: DataFrame) -> DataFrame:
    estimates = robust_estimates(rows)
    joined = own.alias("r").join(estimates.alias("e"), _same("r", "e"), "left").select(
        "r.*", *[F.col(f"e.{c}") for c in _FACTOR]
    )
    within = F.coalesce(F.col("d2") <= LIMIT, F.lit(True))
    return (
        joined.withColumn("d2", squared_distance()).withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(within))
        .drop(*_FACTOR, *[f"x{i}" for i in range(D)])
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, in the columns of ``docs``, whatever their names."""
    kept = _judged_rows(docs).where("kept")
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
