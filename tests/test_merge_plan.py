"""Merges are counted while they are written, and held against their plan."""

import pytest
from pyspark.sql import functions as F

from lakestar.sources.table import Clause, MergeCounts, MergeMismatch, VersionedTable, insert_only, upsert


def table(spark, path, rows=((1, "a"), (2, "b"), (3, "c"), (4, "d"))):
    t = VersionedTable(spark, str(path)).create("id int, v string")
    for row in rows:  # a file each
        t.append(spark.createDataFrame([row], "id int, v string"), files=1)
    return t


def test_counts_by_clause_and_carried_rows(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t").create("id int, v string")
    t.append(spark.createDataFrame([(i, "old") for i in range(100)], "id int, v string").coalesce(1))
    source = spark.createDataFrame([(i, "new") for i in range(90, 130)], "id int, v string")
    m = t.merge(source, ["id"], [Clause("delete", "matched", "target.id = 99"), Clause("update", "matched", "target.id < 95"), Clause("update", "matched"), Clause("insert", "not_matched", "source.id < 120"), Clause("insert", "not_matched")])
    assert (m.inserted, m.updated, m.deleted, m.carried) == (30, 9, 1, 90) and m.by_clause == {1: 5, 2: 4, 3: 20, 4: 10} and m.planned == MergeCounts(30, 9, 1)
    assert t.read().count() == 129


def test_only_touched_files_count(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    m = t.merge(spark.createDataFrame([(2, "x"), (9, "y")], "id int, v string"), ["id"], upsert("true"))
    assert (m.inserted, m.updated, m.deleted, m.carried) == (1, 1, 0, 0)
    gone = t.merge(spark.createDataFrame([], "id int, v string"), ["id"], [Clause("delete", "not_matched_by_source", "target.v = 'y' or target.id = 4")])
    assert (gone.inserted, gone.updated, gone.deleted) == (0, 0, 2) and sorted(r.id for r in t.read().collect()) == [1, 2, 3]


def test_a_plan_of_the_caller_must_be_met(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    source, before = spark.createDataFrame([(9, "y")], "id int, v string"), t.version()
    files = sorted(p.name for p in (tmp_path / "t/data").glob("*.parquet"))
    for wrong in (MergeCounts(inserted=2), MergeCounts(inserted=1, updated=1), MergeCounts(deleted=1)):
        with pytest.raises(MergeMismatch, match="disagrees with its plan"):
            t.merge(source, ["id"], insert_only(), planned=wrong)
    assert t.version() == before and sorted(p.name for p in (tmp_path / "t/data").glob("*.parquet")) == files
    m = t.merge(source, ["id"], insert_only(), planned=MergeCounts(inserted=1))
    assert m.version == before + 1 == t.version() and m.inserted == 1
    assert "numTargetRowsInserted\": 1" in t.history().orderBy(F.desc("version")).first().metrics
    with pytest.raises(MergeMismatch):  # planned rows that aren't there
        t.merge(source, ["id"], insert_only(), planned=MergeCounts(inserted=1))
    with pytest.raises(ValueError, match="negative"):
        MergeCounts(inserted=-1)


def test_a_plan_of_nothing_does_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    before = t.version()
    m = t.merge(spark.createDataFrame([(9, "y")], "id int, v string"), ["id"], insert_only(), planned=MergeCounts())
    assert m.skipped and m.version == before == t.version() and t.read().where("id = 9").isEmpty()
    same = t.merge(spark.createDataFrame([(1, "a")], "id int, v string"), ["id"], upsert("not (target.v <=> source.v)"))
    assert same.skipped and t.version() == before


def test_what_was_written_decides(spark, tmp_path, monkeypatch):
    """Rows that change between the plan and the write, here by a table that loses some, are seen before the commit."""
    t = table(spark, tmp_path / "t")
    observed = VersionedTable._observed_write
    monkeypatch.setattr(VersionedTable, "_observed_write", lambda self, rows, *more: observed(self, rows.where("id <> 7"), *more))
    before = t.version()
    with pytest.raises(MergeMismatch, match="planned 2 inserts, 0 updates, 0 deletes; wrote 1, 0, 0"):
        t.merge(spark.createDataFrame([(7, "x"), (8, "y")], "id int, v string"), ["id"], insert_only())
    assert t.version() == before and t.read().count() == 4


def test_partitioned_and_empty_tables(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/p").create("id int, v string", ("v",))
    m = t.merge(spark.createDataFrame([(i, f"v{i % 3}") for i in range(30)], "id int, v string"), ["id"], upsert("true"))
    assert (m.inserted, m.updated, m.carried) == (30, 0, 0)
    m = t.merge(spark.createDataFrame([(0, "v2"), (None, "v1")], "id int, v string"), ["id"], upsert("true"))
    assert (m.inserted, m.updated) == (1, 1) and m.carried <= 9 and t.read().count() == 31
