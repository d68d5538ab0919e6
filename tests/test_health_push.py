"""A push of scrape health is one transaction over three tables, which get the columns they lack."""

import pytest
from pyspark.sql import functions as F

from lakestar.operators.gates import OUTCOMES
from lakestar.sources import health
from lakestar.sources.publish import Warehouse

MANIFEST = "publisher string, normalised_url string, url_type string, status string, last_seen_at timestamp, last_changed_at timestamp, last_http_status int, fetch_count long, last_run_id string"


def manifest(spark, *rows):
    df = spark.createDataFrame([(p, u, kind, status, 200, 1, "r") for p, u, kind, status in rows], "publisher string, normalised_url string, url_type string, status string, last_http_status int, fetch_count long, last_run_id string")
    return df.withColumns({"last_seen_at": F.lit("2026-01-01").cast("timestamp"), "last_changed_at": F.lit(None).cast("timestamp")})


def run(spark, run_id, written, drop=(), **more):
    df = health.run_row(spark, None, "p", 0, "2026-01-02").withColumns({"run_id": F.lit(run_id), "bronze_written": F.lit(written).cast("long")} | {k: F.lit(v).cast("long") for k, v in more.items()})
    return df.drop(*drop)


def test_push_replaces_snapshots_and_upserts_runs(spark, tmp_path):
    w = Warehouse(spark, f"jdbc:derby:{tmp_path}/w;create=true")
    first = manifest(spark, ("p", "j1", "journal", "ok"), ("p", "a1", "article", "ok"), ("p", "a2", "article", "failed"), ("q'x", "j9", "journal", "ok"))
    assert health.push_warehouse(w, first, "p", "2026-01-02", run(spark, "r1", 1)) == health.Pushed(1, 3, 1)
    assert health.push_warehouse(w, first, "q'x", "2026-01-02") == health.Pushed(0, 1, 1)
    again = manifest(spark, ("p", "j2", "journal", "blocked"), ("p", "a1", "article", "ok"))
    assert health.push_warehouse(w, again, "p", "2026-01-03", run(spark, "r1", 7)) == health.Pushed(1, 2, 1)
    assert health.push_warehouse(w, again, "p", "2026-01-03", run(spark, "r2", 8)).runs == 1
    assert sorted((r.RUN_ID, r.BRONZE_WRITTEN) for r in w.read("scrape_runs").collect()) == [("r1", 7), ("r2", 8)]
    assert sorted((r.PUBLISHER, r.URL_TYPE, r.STATUS, r.ROW_COUNT) for r in w.read("scrape_status").collect()) == [("p", "article", "ok", 1), ("p", "journal", "blocked", 1), ("q'x", "journal", "ok", 1)]
    assert sorted((r.PUBLISHER, r.JOURNAL_URL) for r in w.read("scrape_journals").collect()) == [("p", "j2"), ("q'x", "j9")]
    # A publisher without rows has none left.
    assert health.push_warehouse(w, again.limit(0), "p", "2026-01-04") == health.Pushed(0, 0, 0)
    assert {r.PUBLISHER for r in w.read("scrape_status").union(w.read("scrape_status")).collect()} == {"q'x"}


def test_a_failure_in_the_third_table_leaves_the_first_as_it_was(spark, tmp_path):
    w = Warehouse(spark, f"jdbc:derby:{tmp_path}/w;create=true")
    good, bad = manifest(spark, ("p", "j1", "journal", "ok")), manifest(spark, ("p", "j2", "journal", "ok"), ("p", "j2", "journal", "ok"))
    health.push_warehouse(w, good, "p", "2026-01-02", run(spark, "r1", 1))
    with pytest.raises(Exception, match="duplicate key"):
        health.push_warehouse(w, bad, "p", "2026-01-03", run(spark, "r2", 2, sent_away=5))
    assert [r.RUN_ID for r in w.read("scrape_runs").collect()] == ["r1"] and "sent_away" not in w.columns("scrape_runs")
    assert [r.ROW_COUNT for r in w.read("scrape_status").collect()] == [1] and [r.JOURNAL_URL for r in w.read("scrape_journals").collect()] == ["j1"]
    fresh = Warehouse(spark, f"jdbc:derby:{tmp_path}/fresh;create=true")
    with pytest.raises(Exception, match="duplicate key"):
        health.push_warehouse(fresh, bad, "p", "2026-01-03", run(spark, "r2", 2))
    assert not fresh.has("scrape_runs") and not fresh.has("scrape_journals")


def test_counters_unknown_to_the_table_are_added(spark, tmp_path):
    w = Warehouse(spark, f"jdbc:derby:{tmp_path}/w;create=true")
    rows = manifest(spark, ("p", "j1", "journal", "ok"))
    health.push_warehouse(w, rows, "p", "2026-01-02", run(spark, "r1", 1, drop=(OUTCOMES[0],)))
    assert OUTCOMES[0] not in w.columns("scrape_runs")
    health.push_warehouse(w, rows, "p", "2026-01-02", run(spark, "r2", 2, pages_seen=44))
    found = {r.RUN_ID: r for r in w.read("scrape_runs").collect()}
    assert (found["r1"].PAGES_SEEN, found["r2"].PAGES_SEEN) == (None, 44) and OUTCOMES[0] in w.columns("scrape_runs")
    # A column that only the table has stays, empty in the new row.
    health.push_warehouse(w, rows, "p", "2026-01-02", run(spark, "r3", 3))
    assert {r.RUN_ID: r.PAGES_SEEN for r in w.read("scrape_runs").collect()} == {"r1": None, "r2": 44, "r3": None}
