"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import stage, word_count

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
SEED = 17

# The coin of a document is a number below this, drawn from its content.
COINS = 1 << 32
# Coins are summed in so many bins per source when a threshold is settled.
BINS = 4096


def coin(*columns: Column) -> Column:
    """A number below ``COINS`` that depends on the seed and the values only (a null is a value)."""
    parts = [F.concat(F.lit(f"|{SEED}|"), F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))) for c in columns]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("bigint")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: int = MOST_REPEATS
) -> DataFrame:
    """``target`` and ``rate`` for every row ``(source, source_size)``.

    Sources in code-point order, null last, take the weights in turn and share ``total_share`` of all
    sizes by weight. A target stops at ``most`` times its source; what that frees is shared again by
    weight until none is above. Sources fill up in the order of capacity per weight, so the level at
    which sharing ends follows from running sums over that order: source k is full just when the
    level reached with all sources before it full is at least its own capacity per weight.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(in_order) - 1) % len(weights) + 1)
    filling = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("weight", weight).withColumn("fill", most * F.col("source_size") / F.col("weight"))
    levels = ranked.withColumns(
        {
            "full_before": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most,
            "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "wanted": F.sum("source_size").over(everything) * total_share,
            "place": F.row_number().over(filling),
        }
    ).withColumn("level", (F.col("wanted") - F.col("full_before")) / F.col("weight_left"))
    first_open = F.min(F.when(F.col("level") < F.col("fill"), F.struct("place", "level"))).over(everything)
    open_level = first_open["level"]
    target = F.least(
        (most * F.col("source_size")).cast("double"),
        F.coalesce(open_level * F.col("weight"), F.lit(float("inf"))),
    )
    return levels.withColumn("target", target).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def plan(docs: DataFrame, source: str = "source", size: Column | None = None, key: Column | None = None) -> DataFrame:
    """One row per source: its size, target, whole copies, and the coin below which one more is taken."""
    size = word_count(F.col("text")) if size is None else size
    key = coin(F.col("doc_id"), F.col("text")) if key is None else key
    # One pass over the texts: sizes summed per source and coin bin, partly before the shuffle.
    bins = stage(
        docs.select(F.col(source).alias("source"), size.alias("size"), F.floor(key / (COINS // BINS)).alias("bin"))
        .groupBy("source", "bin").agg(F.sum("size").alias("size")),
        "coins",
    )
    goal = targets(bins.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = goal.withColumn("copies", F.floor("rate").cast("int")).withColumn("fraction", F.col("rate") - F.floor("rate"))
    goal = stage(goal.withColumn("source_key", F.col("source")), "targets")
    # The fraction is the probability; the threshold is the end of the bin whose running sum comes
    # nearest to the fraction of the source, so chance does not move a small source off its target.
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bin"))
    ends = bins.withColumn("taken", running).unionByName(
        bins.groupBy("source").agg(F.lit(0).cast("bigint").alias("size"), F.lit(-1).cast("bigint").alias("bin"))
        .withColumn("taken", F.lit(0).cast("bigint"))
    )
    off = F.abs(F.col("taken") - F.col("fraction") * F.col("source_size"))
    nearest = (
        ends.join(goal.drop("source"), F.col("source").eqNullSafe(F.col("source_key")))
        .groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("bin"))).alias("best"))
        .select(F.col("source").alias("near_source"), (F.col("best.bin") + 1).alias("bins_taken"))
    )
    return stage(
        goal.drop("source").join(nearest, F.col("source_key").eqNullSafe(F.col("near_source"))).select(
            F.col("source_key"), "source_size", "target", "rate", "copies",
            F.when(F.col("fraction") > 0, F.col("bins_taken")).otherwise(0).alias("bins_taken"),
        ),
        "mix",
    )


def copies(docs: DataFrame, source: str = "source", size: Column | None = None, key: Column | None = None) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``: how often each row is taken.

    A row is taken floor(rate) times, and once more when its coin, drawn from seed, id and text, is
    below the threshold of its source: floor(rate) + 1 is at most the cap, as a rate at the cap has no
    fraction. Reruns agree, as nothing depends on partitions or order. Null sources are a source of
    their own; null or blank texts have size 0 and follow the rate of their source; repeated rows
    share a coin; a source without words has target 0; no rows give no rows.
    """
    size = word_count(F.col("text")) if size is None else size
    key = coin(F.col("doc_id"), F.col("text")) if key is None else key
    mix = plan(docs, source, size, key).select(
        F.col("source_key").alias("__source"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"), F.col("copies").alias("__whole"), F.col("bins_taken").alias("__bins"),
    )
    joined = docs.withColumns({"__size": size, "__bin": F.floor(key / (COINS // BINS))}).join(
        mix, F.col(source).eqNullSafe(F.col("__source"))
    )
    extra = (F.col("__bin") < F.col("__bins")).cast("int")
    return joined.withColumn("__copies", F.col("__whole") + extra).drop("__bin", "__bins", "__whole", "__source")


def mix(docs: DataFrame) -> DataFrame:
    """Every row as often as it is taken, in the columns of ``docs``, whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    return (
        copies(docs.select(whole, "doc_id", "source", "text")).where("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """What each document adds to the mix."""
    return copies(docs).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"),
    )


# What mix_report returns, as DuckDB SQL over a view ``documents``.
SQL = f"""
WITH docs AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('|{SEED}|' || coalesce('=' || doc_id, '-') || '|{SEED}|' || coalesce('=' || text, '-')), 1, 8)
      AS BIGINT) // {COINS // BINS} AS bin
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST)) % 3 WHEN 1 THEN 3.0::DOUBLE WHEN 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM sizes
), ranked AS (
  SELECT *, 2 * source_size / weight AS fill,
    2 * coalesce(sum(source_size) OVER f, 0) AS full_before,
    sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS weight_left,
    1.5 * sum(source_size) OVER () AS wanted, row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS place
  FROM weighed
  WINDOW f AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, CAST(wanted - full_before AS DOUBLE) / weight_left AS level FROM ranked
), goals AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), coalesce(
    (SELECT arg_min(level, place) FROM levels WHERE level < fill) * weight, 'infinity'::DOUBLE)) AS target
  FROM levels
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals
), ends AS (
  SELECT source, bin, sum(sum(size)) OVER (PARTITION BY source ORDER BY bin) AS got FROM docs GROUP BY source, bin
  UNION ALL SELECT source, -1, 0 FROM sizes
), chosen AS (
  SELECT e.source, arg_min(bin + 1, (abs(got - (rate - floor(rate)) * source_size), bin)) AS bins
  FROM ends e JOIN rated r ON e.source IS NOT DISTINCT FROM r.source GROUP BY e.source
)
SELECT d.doc_id, d.size, r.source_size, r.target,
  CAST(d.size * (floor(rate) + CASE WHEN rate > floor(rate) AND d.bin < c.bins THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source
"""
