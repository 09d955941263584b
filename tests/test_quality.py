from helpers import plan, rows
from ontime.operators import quality


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "n int, s string")
    got = [tuple(r) for r in quality.profile(df).orderBy("position").collect()]
    assert got == [(1, "n", "int", 3, 1, 1), (2, "s", "string", 3, 1, 2)]


def test_profile_of_an_empty_table(spark):
    got = quality.profile(spark.createDataFrame([], "n int")).first()
    assert tuple(got) == (1, "n", "int", 0, 0, 0)


def test_sample_is_the_same_on_any_layout(spark):
    df = spark.range(100).selectExpr("(id * 37) % 100 as a", "id as b")
    first = quality.sample(df.repartition(7)).collect()
    assert first == quality.sample(df.coalesce(1)).collect()
    assert [r["a"] for r in first] == [0, 1, 2, 3, 4]


def test_row_count(spark):
    assert quality.row_count(spark.range(42)).first()["n_rows"] == 42


def test_short_values_are_counted_as_themselves_and_long_ones_by_a_digest(spark):
    texts = ["", "a", "x" * 15, "x" * 16, "x" * 17, "é" * 8, None, "a", "x" * 17]
    found = quality.profile_in_one_scan(spark.createDataFrame([(t,) for t in texts], "t string"))
    assert rows(found) == [(1, "t", "string", 9, 1, 6)]
    # A short value takes its own bytes of the shuffle, and no digest is made of it.
    assert "octet_length" in plan(found)
