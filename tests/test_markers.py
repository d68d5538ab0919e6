"""Landings are built when their markers are seen, acknowledged last, and once."""

import json

import pytest

from lakestar.sources import landing
from lakestar.sources.files import Files
from lakestar.sources.table import VersionedTable, insert_only
from lakestar.streaming import markers


def lake(spark, tmp_path):
    local, remote = f"{tmp_path}/local", f"{tmp_path}/lake"
    table = VersionedTable(spark, f"{tmp_path}/table").create("v string, n int")

    def land(day, *rows):
        landing.write_jsonl(spark.createDataFrame([("pub", day, v, n) for v, n in rows], "publisher string, ingest_date string, v string, n int"), local)
        return landing.land(spark, local, remote, "pub", f"{day}T00:00:00Z")[1]

    def build(marked):
        assert [r.publisher for r in marked.select("publisher").distinct().collect()] == ["pub"]
        done = table.merge(landing.scan_jsonl(spark, f"{remote}/pub", "v string, n int").select("v", "n"), ["v"], insert_only())
        return {"inserted": done.inserted}

    return remote, table, land, build


def test_each_landing_once(spark, tmp_path):
    remote, table, land, build = lake(spark, tmp_path)
    run = lambda checkpoint="c": markers.process_markers(spark, remote, build, f"{tmp_path}/{checkpoint}", now="later")
    assert run() == 0 and table.version() == 0
    first = land("2026-01-01", ("a", 1), ("b", 2))
    assert run() == 1 and table.read().count() == 2 and run() == 0
    told = json.loads(Files(spark, remote).read(first + markers.SUFFIX))
    assert told["inserted"] == 2 and told["processed_at"] == "later"
    land("2026-01-02", ("c", 3))
    land("2026-01-03", ("d", 4))
    assert run() == 2 and table.read().count() == 4
    version = table.version()
    assert run("other") == 0 and table.version() == version  # a checkpoint that is lost: the siblings know


def test_a_restart_between_merge_and_acknowledgement_changes_nothing(spark, tmp_path, monkeypatch):
    remote, table, land, build = lake(spark, tmp_path)
    marker = land("2026-01-01", ("a", 1))
    create = Files.create

    def lost(self, path, *more, **options):
        if path.endswith(markers.SUFFIX):
            raise OSError("the driver is gone")
        create(self, path, *more, **options)

    monkeypatch.setattr(Files, "create", lost)
    with pytest.raises(Exception, match="the driver is gone"):
        markers.process_markers(spark, remote, build, f"{tmp_path}/c")
    version, rows = table.version(), sorted(map(tuple, table.read().collect()))
    assert version == 1 and rows == [("a", 1)] and not Files(spark, remote).exists(marker + markers.SUFFIX)
    monkeypatch.setattr(Files, "create", create)
    assert markers.process_markers(spark, remote, build, f"{tmp_path}/c") == 1
    assert table.version() == version and Files(spark, remote).exists(marker + markers.SUFFIX)


def test_a_build_that_fails_is_not_acknowledged(spark, tmp_path):
    remote, table, land, build = lake(spark, tmp_path)
    marker = land("2026-01-01", ("a", 1))

    def fails(marked):
        raise RuntimeError("no silver")

    with pytest.raises(Exception, match="no silver"):
        markers.process_markers(spark, remote, fails, f"{tmp_path}/c")
    assert not Files(spark, remote).exists(marker + markers.SUFFIX)
    assert markers.process_markers(spark, remote, build, f"{tmp_path}/c") == 1 and table.read().count() == 1
