"""Stages return the columns they were given, whatever their names are."""

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from ontime.llm import quality

# Names that the operators use inside, and some that need quoting.
NAMES = "x0 m0 l00 start n_words kept d2 bin __row __size __copies __copy __doc doc row fp id component_id rows all a.b __words base_failed h e r"


def named(spark):
    """Documents whose extra columns each hold a value of their own."""
    texts = [(100 + i, " ".join(f"w{(131 * i + k * k) % 1009}" for k in range(200)), "en", "s", 0, None) for i in range(1, 40)]
    docs = brute.odd_docs(spark, [r for r in brute.ROWS if r[0] != 8 and r[0] != 9] + texts).drop("row")
    return docs.withColumns({n: F.concat(F.lit(f"{n}="), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES.split()})


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name(spark, name, step):
    docs = named(spark)
    found = step(spark, docs, "")
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n}={'-' if r.doc_id is None else r.doc_id}" for n in NAMES.split())


def test_packing_reads_no_other_columns(spark):
    docs = named(spark)
    plain = corpus_pipeline.STAGES[-1][1](spark, docs.select("doc_id", "text"), "").collect()
    assert sorted(map(str, corpus_pipeline.STAGES[-1][1](spark, docs, "").collect())) == sorted(map(str, plain))


def test_judging_takes_any_names(spark):
    found = quality.judge(named(spark))
    row = found.where("doc_id = 5").first()
    assert row.x0 == "x0=5" and row.n_words == 0 and row.kept is False
