"""The jobs end to end, from CSV files to scored rows."""

import json

import pytest
from helpers import rows

from ontime import __main__ as jobs
from ontime.operators.models import Learner, GRADIENT_BOOSTING
from ontime.plans import training
from ontime.plans.load import TABLES, open_warehouse
from ontime.plans.reports import REPORTS


@pytest.fixture(scope="module")
def loaded(spark, ws, tmp_path_factory):
    data = ws.flights_csv.rsplit("/", 1)[0]
    assert {p.rsplit("/", 1)[0] for p in (ws.causes_csv, ws.airports_csv)} == {data}
    warehouse = str(tmp_path_factory.mktemp("jobs") / "warehouse")
    jobs.main(["load", "--data", data, "--warehouse", warehouse])
    return warehouse


def test_load_from_files_equals_load_from_frames(spark, ws, loaded):
    """The CSV holds "NA" where the frame holds null text, so tail numbers differ in that word only."""
    stored = open_warehouse(spark, loaded)
    assert set(stored.tables) == set(TABLES)
    for name in TABLES:
        expected = ws.warehouse[name]
        if name == "fact_flights":
            expected = expected.replace("Unknown", "NA", ["tail_number"])
        assert stored[name].schema.simpleString() == expected.schema.simpleString()
        assert rows(stored[name]) == rows(expected)


def test_reports_are_written(spark, ws, loaded, tmp_path):
    jobs.main(["report", "--warehouse", loaded, "--out", str(tmp_path), "rp_carrier_delays", "flights_summary"])
    written = spark.read.parquet(str(tmp_path / "rp_carrier_delays"))
    assert rows(written) == rows(REPORTS["rp_carrier_delays"](ws.warehouse))
    assert not (tmp_path / "rp_monthly_delays").exists()
    jobs.main(["report", "--warehouse", loaded, "--out", str(tmp_path)])
    assert {p.name for p in tmp_path.iterdir()} == set(REPORTS)


def test_reports_are_kept_in_the_catalog(spark, ws, loaded, tmp_path):
    spark.sql(f"CREATE DATABASE kept LOCATION '{tmp_path}/kept.db'")
    try:
        for _ in range(2):
            jobs.main(["report", "--warehouse", loaded, "--database", "kept", "rp_carrier_delays"])
        assert {t.name for t in spark.catalog.listTables("kept") if not t.isTemporary} == {"rp_carrier_delays"}
        assert rows(spark.newSession().table("kept.rp_carrier_delays")) == rows(REPORTS["rp_carrier_delays"](ws.warehouse))
    finally:
        spark.sql("DROP DATABASE kept CASCADE")


def test_unknown_reports_and_jobs_are_refused(loaded, tmp_path):
    with pytest.raises(SystemExit):
        jobs.main(["report", "--warehouse", loaded, "--out", str(tmp_path), "nothing"])
    with pytest.raises(SystemExit):
        jobs.main([])


def test_train_and_score(spark, loaded, tmp_path, monkeypatch):
    small = (Learner(GRADIENT_BOOSTING.name, GRADIENT_BOOSTING.kind, {"maxIter": 1, "maxDepth": 1}),)
    monkeypatch.setattr(jobs, "compare_models", lambda *a, **k: training.compare_models(*a, learners=small, **k))
    jobs.main(["train", "--warehouse", loaded, "--out", str(tmp_path / "run"), "--partitions", "4", "--compact",
               "--split", "random", "--stamp", "first"])
    assert {p.name for p in (tmp_path / "run" / "first").iterdir()} == {
        "run_metrics", "best_models", "timings", "arrival_GBT", "departure_GBT",
    }
    row = {
        "carrier_code": "C0001", "origin": "A01", "destination": "A02", "distance": 100, "air_time": 42,
        "day_of_week": "Sunday", "is_weekend": 1.0, "day_of_month": 3, "month": 4, "time_of_day": "Night",
    }
    (tmp_path / "rows.json").write_text(json.dumps(row) + "\n" + json.dumps({**row, "origin": "elsewhere"}))
    jobs.main(["score", "--model", str(tmp_path / "run" / "first" / "arrival_GBT"), "--rows", str(tmp_path / "rows.json"),
               "--out", str(tmp_path / "scored")])
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.count() == 2 and scored.columns[-2:] == ["prediction", "delay_probability"]
    jobs.main(["trees", "--model", str(tmp_path / "run" / "first" / "arrival_GBT"), "--out", str(tmp_path / "nodes")])
    nodes = spark.read.parquet(str(tmp_path / "nodes"))
    assert nodes.where("leaf AND value IS NOT NULL").count() == 2 and nodes.where("NOT leaf AND left IS NOT NULL").count() == 1


def test_jdbc_load_needs_its_settings(spark, ws, tmp_path, monkeypatch):
    for name in ("JDBC_HOST", "JDBC_PORT", "JDBC_DB", "JDBC_USER", "JDBC_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    data = ws.flights_csv.rsplit("/", 1)[0]
    with pytest.raises(KeyError):
        jobs.main(["load", "--data", data, "--warehouse", str(tmp_path / "w"), "--jdbc"])
