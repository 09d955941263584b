"""Folders that a run stages, and loads that are published whole or not at all."""

import os

import pytest
from helpers import flights, rows
from pyspark.sql import functions as F

from ontime import __main__ as jobs
from ontime import staging
from ontime.operators.models import GRADIENT_BOOSTING, Learner
from ontime.plans import load, training
from ontime.plans.load import TABLES, open_warehouse
from ontime.schemas import TARGETS
from ontime.session import shared_folder
from ontime.sources import tables

ONE = (Learner("GBT", GRADIENT_BOOSTING.kind, {"maxIter": 1, "maxDepth": 1}),)


def put(spark, name):
    path = staging.staged_folder(spark, name)
    spark.range(3).write.parquet(path)
    return path


def on_disk(path):
    return os.path.exists(path.removeprefix("file://").removeprefix("file:"))


def test_an_owner_takes_its_folders_along_and_no_others(spark):
    mine = put(spark, "mine")
    with staging.owner(spark):
        first = put(spark, "first")
        with staging.owner(spark):
            second = put(spark, "second")
            assert on_disk(first) and on_disk(second)
        assert on_disk(first) and not on_disk(second)
    assert on_disk(mine) and not on_disk(first)
    assert mine in staging.staged_folders(spark, staging.SESSION)
    staging.remove(spark, mine)


def test_folders_go_after_a_failure(spark):
    before = staging.staged_folders(spark)
    with pytest.raises(ZeroDivisionError), staging.owner(spark):
        lost = put(spark, "lost")
        raise ZeroDivisionError
    assert not on_disk(lost) and staging.staged_folders(spark) == before


def test_folders_that_are_still_read_stay(spark):
    with staging.owner(spark, "reader", keep=True):
        read, other = put(spark, "read"), put(spark, "other")
    staging.release(spark, "reader", spark.read.parquet(read).inputFiles())
    assert on_disk(read) and not on_disk(other) and staging.staged_folders(spark, "reader") == [read]
    staging.release(spark, "reader")
    assert not on_disk(read) and not staging.staged_folders(spark, "reader")


def folders(spark):
    return set(os.listdir(shared_folder(spark))) - {"checkpoints"}


def test_training_leaves_nothing_staged(spark, ws):
    enriched = ws.enriched
    before, seen = staging.staged_folders(spark), folders(spark)
    comparison = training.compare_models(enriched, learners=ONE, split="random")
    assert staging.staged_folders(spark) == before and folders(spark) == seen
    assert comparison.metrics.count() == len(TARGETS)


def test_failed_training_leaves_nothing_staged(spark, ws, monkeypatch):
    enriched = ws.enriched
    before, seen = staging.staged_folders(spark), folders(spark)
    monkeypatch.setattr(training, "evaluate", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        training.compare_models(enriched, learners=ONE)
    assert staging.staged_folders(spark) == before and folders(spark) == seen


def test_queries_leave_only_what_they_share(spark, folder, tmp_path):
    from ontime import catalogue
    from ontime.workspace import close_workspace

    for name in os.listdir(folder):
        os.symlink(f"{folder}/{name}", tmp_path / name)
    before, seen = staging.staged_folders(spark), folders(spark)
    queries, source = catalogue.queries(), str(tmp_path)
    for name in ("eval_auc", "metrics_long", "string_index_tables", "eval_planted_model", "dim_carrier"):
        assert queries[name](spark, source).count() > 0
    assert staging.staged_folders(spark) == before
    shared = folders(spark) - seen
    assert len(shared) == 1
    close_workspace(spark, source)
    assert folders(spark) == seen
    assert queries["dim_carrier"](spark, source).count() > 0
    close_workspace(spark, source)


def test_a_job_leaves_nothing_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "report", lambda spark, args: put(spark, "report"))
    parser = jobs.parser
    monkeypatch.setattr(jobs, "parser", lambda: parser())
    before = staging.staged_folders(spark)
    jobs.main(["report", "--warehouse", "w", "--out", str(tmp_path)])
    assert staging.staged_folders(spark) == before


def test_small_files_are_made_once(spark, tmp_path):
    path = f"{tmp_path}/a/note"
    assert staging.read_text(spark, path) is None
    assert staging.write_text(spark, path, "first\n") and not staging.write_text(spark, path, "second\n")
    assert staging.read_text(spark, path) == "first\n"
    staging.remove(spark, path)
    staging.remove(spark, path)
    assert staging.names_in(spark, f"{tmp_path}/a") == [] == staging.names_in(spark, f"{tmp_path}/nothing")


# -- loads


def load_some(spark, ws, folder, *changes):
    return load.load_warehouse(flights(spark, *changes), ws.airports, ws.causes, folder)


def contents(warehouse):
    return {name: rows(warehouse[name]) for name in TABLES}


def test_a_failed_load_leaves_the_former_warehouse(spark, ws, tmp_path, monkeypatch):
    folder = str(tmp_path / "warehouse")
    with pytest.raises(FileNotFoundError):
        open_warehouse(spark, folder)
    load_some(spark, ws, folder, {"distance": 1}, {"distance": 2})
    former = contents(open_warehouse(spark, folder))
    for broken in ("store_delay_reasons", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(load, broken, lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                load_some(spark, ws, folder, {"distance": 3})
        assert contents(open_warehouse(spark, folder)) == former
        assert len([n for n in os.listdir(folder) if n.startswith("load-")]) == 1


def test_a_table_that_fails_leaves_the_former_warehouse(spark, ws, tmp_path):
    folder = str(tmp_path / "warehouse")
    load_some(spark, ws, folder, {"distance": 1})
    former = contents(open_warehouse(spark, folder))
    bad = ws.causes.withColumn("year", F.raise_error(F.lit("no such year")).cast("int"))
    with pytest.raises(Exception, match="no such year"):
        load.load_warehouse(flights(spark, {"distance": 9}), ws.airports, bad, folder)
    assert contents(open_warehouse(spark, folder)) == former


def test_frames_opened_on_the_former_load_are_still_read(spark, ws, tmp_path):
    folder = str(tmp_path / "warehouse")
    opened = [load_some(spark, ws, folder, {"distance": d}) and open_warehouse(spark, folder) for d in (1, 2)]
    assert [w["dim_route"].first()["distance"] for w in opened] == [1, 2]
    load_some(spark, ws, folder, {"distance": 3})
    assert opened[1]["dim_route"].first()["distance"] == 2
    assert open_warehouse(spark, folder)["dim_route"].first()["distance"] == 3
    assert len(tables.published(spark, folder)) == 2 == len([n for n in os.listdir(folder) if n.startswith("load-")])


def test_a_note_cut_short_is_no_load(spark, ws, tmp_path):
    folder = str(tmp_path / "warehouse")
    load_some(spark, ws, folder, {"distance": 1})
    former = contents(open_warehouse(spark, folder))
    notes = sorted(os.listdir(f"{folder}/{tables.PUBLISHED}"))
    name = open(f"{folder}/{tables.PUBLISHED}/{[n for n in notes if not n.startswith('.')][-1]}").read().strip()
    staging.write_text(spark, f"{folder}/{tables.PUBLISHED}/{1:012d}", name[:-2])
    assert contents(open_warehouse(spark, folder)) == former
    load_some(spark, ws, folder, {"distance": 7})  # takes the number after the broken one
    assert open_warehouse(spark, folder)["dim_route"].first()["distance"] == 7
