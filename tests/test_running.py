"""Running totals over partitions, and what is made of them: exact areas under curves, indexes of categories."""

import random

import pytest
from helpers import plan, rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ontime.operators import features, metrics, quality
from ontime.operators.running import running_totals
from ontime.session import INITIAL_PARTITIONS, PIECE_BYTES, plan_shuffles, scanned_bytes, shuffle_width
from ontime.sources.tables import Table


@pytest.fixture
def spread(spark):
    """Sorts and shuffles keep all their partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_running_totals_add_up_across_partitions(spark, spread):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("k"), (F.col("id") % 11).alias("v"))
    got = {r.k: (r.n, r.s) for r in running_totals(df, [F.asc("k")], {"n": F.lit(1), "s": F.col("v")}).collect()}
    total = 0
    values = {r.k: r.v for r in df.collect()}
    for k in range(5000):
        assert got[k] == (k, total)
        total += values[k]
    assert running_totals(df.limit(0), [F.asc("k")], {"n": F.lit(1)}).count() == 0


def brute_auc(data):
    late, on_time = ([s for s, y, n in data if y == side for _ in range(n)] for side in (1.0, 0.0))
    return sum((p > q) + (p == q) / 2 for p in late for q in on_time) / (len(late) * len(on_time))


def test_exact_auc_per_group(spark, spread):
    rng = random.Random(4)
    data = {g: [(round(rng.random(), 2), float(rng.random() < 0.4), rng.randint(1, 3)) for _ in range(90)] for g in "abc"}
    table = [(g, y, float(s > 0.5), s, n) for g, found in data.items() for s, y, n in found]
    counts = spark.createDataFrame(table, "g string, label double, prediction double, score double, n bigint")
    got = {r.g: r.auc for r in metrics.exact_auc(counts, "g").collect()}
    assert got == {g: pytest.approx(brute_auc(found), abs=1e-12) for g, found in data.items()}
    one = counts.where("g = 'a'")
    assert metrics.area_under_roc(one) == got["a"]
    theirs = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", weightCol="n", numBins=0).evaluate(one)
    assert got["a"] == pytest.approx(theirs, abs=1e-12)
    assert metrics.area_under_roc(one.where("label = 1")) == 0.0


def test_auc_of_very_many_rows_is_exact(spark):
    """Products of the counts exceed 64 bits."""
    big = 4_000_000_000
    counts = spark.createDataFrame(
        [(1.0, 1.0, 0.9, big), (0.0, 1.0, 0.9, big), (1.0, 0.0, 0.1, big), (0.0, 0.0, 0.1, big)],
        "label double, prediction double, score double, n bigint",
    )
    assert metrics.area_under_roc(counts) == 0.5


def test_a_million_categories_are_indexed_without_the_driver(spark, spread, tmp_path, monkeypatch):
    n = 1_000_000
    df = spark.range(0, n + 500, 1, 8).select(F.concat(F.lit("v"), F.col("id") % n).alias("c"))
    collect = type(df).collect

    def watched(self):
        found = collect(self)
        assert len(found) <= 1, "rows came to the driver"  # one tells what the dictionary takes in memory
        return found

    monkeypatch.setattr(type(df), "collect", watched)
    monkeypatch.setattr(type(df), "toPandas", lambda self: pytest.fail("rows came to the driver"))
    table = features.category_table(df, "c", str(tmp_path / "index"))
    monkeypatch.undo()
    found = table.frame.agg(
        F.count(F.lit(1)), F.countDistinct("c_idx"), F.min("c_idx"), F.max("c_idx"), F.count_if((F.col("n") == 2) != (F.col("c_idx") < 500))
    ).first()
    assert tuple(found) == (n, n, 0.0, n - 1.0, 0)
    twice = sorted(f"v{i}" for i in range(500))
    assert [r.c for r in table.frame.where("c_idx < 500").orderBy("c_idx").collect()] == twice
    small = spark.createDataFrame([(twice[3],), ("new",), (None,)], "c string")
    for measured in (table, Table(table.frame, table.path)):  # broadcast, joined by value
        got = {r.c: r.c_idx for r in features.index_by_tables(small, {"c": measured}).collect()}
        assert got == {twice[3]: 3.0, "new": float(n), None: float(n)}


def test_tables_index_as_the_indexer_does(spark, ws, tmp_path):
    frame = ws.features("arrival").select("origin", "carrier_code", "day_of_month")
    dictionaries = {c: features.category_table(frame, c, str(tmp_path / c)) for c in ("origin", "carrier_code")}
    got = features.index_by_tables(frame, dictionaries)
    stage = features.index_stage(["origin", "carrier_code"])
    assert rows(got) == rows(stage.fit(frame).transform(frame).select(got.columns))


# -- profiles of text


def test_a_text_profile_reads_its_file_once(spark, ws):
    from ontime.sources.files import scan_csv

    raw = scan_csv(spark, ws.flights_csv, null_text="NA")
    once = quality.profile_in_one_scan(raw)
    assert plan(once).count("Scan csv") == 2  # named in the tree and in its details: one scan
    assert plan(quality.profile(raw)).count("Scan csv") > 2
    assert rows(once) == rows(quality.profile(raw))


def test_profiles_agree_on_odd_values(spark):
    df = spark.createDataFrame(
        [(0.0, "a", [1], None), (-0.0, "", [1, 2], None), (float("nan"), None, None, None), (float("nan"), "a", [], None)],
        "d double, s string, a array<int>, n date",
    )
    assert rows(quality.profile_in_one_scan(df)) == rows(quality.profile(df))
    assert rows(quality.profile_in_one_scan(df.limit(0))) == rows(quality.profile(df.limit(0)))


# -- width of shuffles


def test_shuffles_are_as_wide_as_the_input_asks(spark, tmp_path, monkeypatch):
    assert shuffle_width(0, 8) == 32
    assert shuffle_width(10**12, 8) == -(-10**12 // PIECE_BYTES)
    assert shuffle_width(10**12, 4000) == 16_000
    assert 10**14 / shuffle_width(10**14, 4000) < 1 << 30  # 100 TB: less than a gigabyte to a piece
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    size = scanned_bytes(stored)
    assert 0 < size < 100_000 and scanned_bytes(stored, stored) == 2 * size
    assert scanned_bytes(stored.join(stored.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))) == 2 * size


def test_the_session_widens_and_never_overrules(spark, monkeypatch):
    from ontime import session

    frame, before = spark.range(10), spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(INITIAL_PARTITIONS)
        assert plan_shuffles(spark, frame) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        monkeypatch.setattr(session, "scanned_bytes", lambda *frames: 10**12)
        wide = plan_shuffles(spark, frame)
        assert wide == -(-10**12 // PIECE_BYTES) == int(spark.conf.get(INITIAL_PARTITIONS))
        monkeypatch.setattr(session, "scanned_bytes", lambda *frames: 10**10)
        assert plan_shuffles(spark, frame) == wide
        spark.conf.set(INITIAL_PARTITIONS, "11")
        monkeypatch.setattr(session, "scanned_bytes", lambda *frames: 10**13)
        assert plan_shuffles(spark, frame) == 11 == int(spark.conf.get(INITIAL_PARTITIONS))
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if before is None else spark.conf.set(INITIAL_PARTITIONS, before)
