"""Runs: one publish for all tables, exclusive versions, resuming after a failure, nothing left behind."""

import os

import pytest
from pyspark.sql import types as T

from shopshift.checks.legacy_db import write_legacy_db
from shopshift.plans import run as R
from shopshift.session import ensure_checkpoint_dir
from shopshift.sinks.writers import RunConflict, commit_run, drop_old_versions, publish, refresh, write_version
from shopshift.sources.tables import Stages, create_file, last_run, live_folders, materialise, read_table, read_text, stages_of, version_log

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("entity_id", T.LongType()), T.StructField("email", T.StringType())])


def table(spark, *ids):
    return spark.createDataFrame([(i, f"{i}@x") for i in ids], SCHEMA)


def ids(spark, path):
    return sorted(r["entity_id"] for r in read_table(spark, path).collect())


def test_a_file_is_created_once(spark, scratch):
    path = f"{scratch}/a/b.json"
    assert read_text(spark, path) == ""
    assert create_file(spark, path, "é1\n") and not create_file(spark, path, "2")
    assert read_text(spark, path) == "é1\n"


def test_versions_of_a_run_count_together(spark, scratch):
    a, b = f"{scratch}/a", f"{scratch}/b"
    for t in (a, b):
        refresh(table(spark, 1), t)
    folders = [write_version(table(spark, 2), t) for t in (a, b)]
    assert publish(spark, a, folders[:1], "r1", 1) == 2
    # a run that stops here is not seen, and what comes later is
    assert ids(spark, a) == ids(spark, b) == [1] and [v["version"] for v in version_log(spark, a)] == [1]
    assert publish(spark, b, folders[1:], "r1", 1) == 2
    assert ids(spark, b) == [1] and last_run(spark, scratch) == 0
    commit_run(spark, scratch, 1, "r1", ["a", "b"])
    assert ids(spark, a) == ids(spark, b) == [2] and last_run(spark, scratch) == 1
    with pytest.raises(RunConflict):
        commit_run(spark, scratch, 1, "r2", ["a"])
    # a run that lost its number never counts; a table refreshed by itself does at once
    publish(spark, a, [write_version(table(spark, 3), a)], "r2", 1)
    assert ids(spark, a) == [2]
    refresh(table(spark, 4), a)
    assert ids(spark, a) == [4] and [v["version"] for v in version_log(spark, a)] == [1, 2, 4]
    dropped = drop_old_versions(spark, a, keep=1)
    assert len(dropped) == 3 and ids(spark, a) == [4]


def test_a_taken_number_is_passed_over(spark, scratch, monkeypatch):
    from shopshift.sinks import writers as W

    path = f"{scratch}/t"
    refresh(table(spark, 1), path)
    first = W.version_entries(spark, path)
    refresh(table(spark, 2), path)
    # a publisher that has not seen version 2 yet
    monkeypatch.setattr(W, "version_entries", lambda *_: first)
    assert publish(spark, path, [write_version(table(spark, 3), path)]) == 3
    assert ids(spark, path) == [3]


def test_stages_go_with_their_run(spark):
    with stages_of(Stages(spark, "test-run")) as stages:
        assert sorted(r[0] for r in materialise(table(spark, 5, 6)).select("entity_id").collect()) == [5, 6]
        assert os.path.isdir(stages.folder.removeprefix("file:"))
        stages.drop()
        assert not os.path.isdir(stages.folder.removeprefix("file:"))


def test_many_folders_become_one(spark, scratch):
    path = f"{scratch}/t"
    folders = [write_version(table(spark, *range(i, i + 1 + 40 * (i == 3))), path) for i in range(0, 100 * R.MAX_FOLDERS, 100)] + [write_version(table(spark, *range(9000, 9400)), path)]
    out = R.bounded(spark, path, folders, "x")
    assert len(out) == R.MAX_FOLDERS // 2 and folders[-1] in out and out[-1].endswith("-merged")
    assert sum(spark.read.parquet(f).count() for f in out) == sum(spark.read.parquet(f).count() for f in folders)
    assert R.bounded(spark, path, folders[:2], "x") == folders[:2]


JOBS = ("customers", "addresses", "legacy_products")


def content(spark, target, names):
    return {n: sorted(map(repr, read_table(spark, f"{target}/{n}").collect())) for n in names}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_a_failed_run_is_resumed(spark, scratch, monkeypatch):
    legacy, target, other = (f"{scratch}/{n}" for n in ("legacy", "target", "other"))
    cfg = write_legacy_db(spark, SF, legacy, target)
    write_legacy_db(spark, SF, f"{scratch}/legacy2", other)
    whole = R.migrate(spark, legacy, other, cfg, JOBS)
    want = content(spark, other, whole)

    tried, write = [], R.write_version

    def failing(df, path, schema=None, name=None):
        tried.append(path)
        if len(tried) == 4:
            raise OSError("lost")
        return write(df, path, schema, name)

    monkeypatch.setattr(R, "write_version", failing)
    with pytest.raises(OSError):
        R.migrate(spark, legacy, target, cfg, JOBS)
    # nothing of it is seen: tables that were there are as before, the others are not there
    assert live_folders(spark, f"{target}/catalog_product_entity") == [f"{target}/catalog_product_entity.parquet"]
    assert live_folders(spark, f"{target}/customer_entity") == [] and last_run(spark, target) == 0
    done = list(tried[:3])
    tried.clear()
    monkeypatch.setattr(R, "write_version", lambda df, path, schema=None, name=None: (tried.append(path), write(df, path, schema, name))[1])
    # a run that is not resumed writes everything, and fails before its record
    monkeypatch.setattr(R, "commit_run", lambda *_: (_ for _ in ()).throw(OSError("lost again")))
    with pytest.raises(OSError):
        R.migrate(spark, legacy, target, cfg, JOBS)
    assert set(done) <= set(tried) and live_folders(spark, f"{target}/customer_entity") == []
    tried.clear()
    monkeypatch.undo()
    monkeypatch.setattr(R, "write_version", lambda df, path, schema=None, name=None: (tried.append(path), write(df, path, schema, name))[1])
    got = R.migrate(spark, legacy, target, cfg, JOBS, resume=True)
    assert tried == [] and set(got) == set(whole)  # the last attempt had finished all targets
    assert content(spark, target, got) == want
    # neither stages nor journals nor folders of failed runs are left
    assert not os.path.isdir(f"{target}/_journal") or os.listdir(f"{target}/_journal") == []
    run_id = version_log(spark, f"{target}/customer_entity")[-1]["run_id"]
    assert not [n for n in os.listdir(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/stages") if n.startswith(run_id.split("-")[0])]
    left = [n for n in os.listdir(target) if ".__v" in n and run_id not in n]
    assert left == []
