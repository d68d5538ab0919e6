import contextlib
import datetime
import io
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lakestar.plans import catalog, catalog_lake
from lakestar.sources import landing
from lakestar.sources.files import Files
from tests.oracle import compare


def test_asof_join_gives_every_event_its_version(spark, tmp_path):
    at = lambda minute: datetime.datetime(2024, 1, 1, 0, minute)
    rows = [(i, i % 4, "abc"[i * i % 7 % 3], at(i * 5 % 17)) for i in range(40)] + [(40, None, "a", at(3))]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    want = []
    for event, user, _, ts in rows:
        changes, before = [], None
        for _, _, kind, t in sorted((r for r in rows if r[1] == user is not None), key=lambda r: (r[3], r[0])):
            if kind != before:
                changes.append((t, kind))
            before = kind
        valid = [c for c, after in zip(changes, [*changes[1:], (datetime.datetime.max, None)], strict=True) if c[0] <= ts < after[0]] if changes else []
        want.append((event, user, valid[0][1] if valid else None, valid[0][0] if valid else None))
    got = sorted(tuple(r) for r in catalog.QUERIES["r24_asof_join"](spark, str(tmp_path)).collect())
    assert got == sorted(want, key=lambda r: r[0])


def test_entry_covers_every_event(spark, sf_dir):
    assert __spark_entry__.entry(spark).select("event_id").distinct().count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_every_page_has_an_action(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = catalog.QUERIES["r61_landing_plan"](spark, sf_dir)
    assert plan.count() == pages.count() and plan.where("action is null").count() == 0
    assert {r.action for r in plan.select("action").distinct().collect()} == {"empty", "new", "unchanged", "replaced"}


def test_markers_and_deletes_see_every_row(spark, sf_dir):
    events = [r.event_id for r in spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id").collect()]
    keys = {r.key for r in catalog.QUERIES["r61_pending_markers"](spark, sf_dir).collect()}
    assert keys == {f"m/{e}.json" for e in events if e % 2}
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus").collect()
    kept = {r.o_orderkey for r in catalog.QUERIES["r54_merge_delete_by_source"](spark, sf_dir).collect()}
    assert kept == {k for k, status in orders if k % 3 == 0 or status != "F"}


def test_refresh_policy_counts_seconds_as_its_sql_does(spark, tmp_path):
    at = [datetime.datetime(2024, 1, 22, 0, 0, s, us) for s in (0, 1) for us in (0, 1, 999_999)] + [datetime.datetime(2024, 1, 21, 23, 59, 59, 999_999), None]
    rows = [(i * 65 + 1, t, kind) for i, (t, kind) in enumerate((t, kind) for t in at for kind in ("other", "view", None))]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string").coalesce(1).write.parquet(f"{tmp_path}/written")
    next(tmp_path.glob("written/*.parquet")).rename(tmp_path / "events.parquet")
    shutil.rmtree(tmp_path / "written")
    compare(spark, str(tmp_path), catalog.QUERIES["r58_refresh_policy"], catalog.SQL["r58_refresh_policy"])


def test_page_fields_leave_references_that_the_sql_leaves(spark, tmp_path):
    texts = ["cut &amp", "a &amp; b", "&quot;q&quot;", "&amp;quot;", "&lt;", "&&amp;&", "&#38;", "AT&T", ""]
    rows = [(i, f"<html><title>{t}</title><h1>{t}</h1><p>x</p><li>&quot;</li></html>") for i, t in enumerate(texts)] + [(99, None)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/written")
    next(tmp_path.glob("written/*.parquet")).rename(tmp_path / "pages.parquet")
    shutil.rmtree(tmp_path / "written")
    compare(spark, str(tmp_path), catalog.QUERIES["r64_html_extract"], catalog.SQL["r64_html_extract"])


def test_two_runs_over_the_same_pages_share_one_parse(spark, sf_dir):
    rows = catalog.QUERIES["r84_record"](spark, sf_dir)
    assert rows.collect()
    with contextlib.redirect_stdout(io.StringIO()) as shown:
        rows.explain()
    assert "ReusedExchange" in shown.getvalue()


def test_issue_pages_are_parsed_by_many_tasks(spark, sf_dir):
    assert spark.read.parquet(f"{sf_dir}/customer.parquet").rdd.getNumPartitions() == 1 and catalog.QUERIES["r80_issue_page"](spark, sf_dir).rdd.getNumPartitions() == 4


def test_issue_pages_are_parsed_by_many_tasks(spark, sf_dir):
    assert spark.read.parquet(f"{sf_dir}/customer.parquet").rdd.getNumPartitions() == 1 and catalog.QUERIES["r80_issue_page"](spark, sf_dir).rdd.getNumPartitions() == 4


def test_article_pages_are_parsed_by_many_tasks(spark, sf_dir):
    assert spark.read.parquet(f"{sf_dir}/customer.parquet").rdd.getNumPartitions() == 1 and catalog.QUERIES["r81_article_page"](spark, sf_dir).rdd.getNumPartitions() == 4


def test_rich_texts_are_parsed_by_many_tasks(spark, sf_dir):
    assert spark.read.parquet(f"{sf_dir}/customer.parquet").rdd.getNumPartitions() == 1 and catalog.QUERIES["r82_rich_text"](spark, sf_dir).rdd.getNumPartitions() == 4


def test_disabled_tasks_do_not_meet_in_one_partition(spark, tmp_path):
    lines = [f"p,https://x.test/{i},{'no' if i % 4 else 'yes'}," for i in range(4000)]
    (tmp_path / "tasks.csv").write_text("\n".join(["publisher,url,enabled,note", *lines]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(key, value)
        parts = landing.tasks_with_flags(spark, str(tmp_path / "tasks.csv"), "p").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum(F.col("first").cast("int"))).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(parts) == 4 and max(r[1] for r in parts) < 1300


def test_landed_records_of_one_file_are_written_by_many_tasks(spark, sf_dir, tmp_path):
    landing.write_jsonl(catalog_lake._records(spark, sf_dir), str(tmp_path))
    assert {len({f.name[:10] for f in day.glob("*.json")}) for day in tmp_path.glob("pub/ingest_date=*")} == {4}


def test_landing_copies_files_in_bulk(spark, tmp_path, monkeypatch):
    names = ["a b", "c,d", "{e}", "[f]", "g*", "h?", "i\\j", "k^", "l%20m", "ü", "plain.json", *(f"n{i}" for i in range(150))]
    for folder in ("", "day=1/", "day=2/x y/{z}/"):
        (tmp_path / "here/pub" / folder).mkdir(parents=True, exist_ok=True)
        for name in names:
            (tmp_path / "here/pub" / folder / name).write_text(folder + name)
    (tmp_path / "here/pub/empty").write_text("")
    monkeypatch.setattr(Files, "copy", None)
    counts, marker = landing.land(spark, f"{tmp_path}/here", f"{tmp_path}/there", "pub", "2026-01-01T00:00:00Z")
    told = lambda root: {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert counts["uploaded"] == 3 * len(names) and counts["empty_skipped"] == 1 and marker
    assert told(tmp_path / "there/pub") == {k: v for k, v in told(tmp_path / "here/pub").items() if v}
    files = Files(spark, str(tmp_path))
    assert [(p.removeprefix(f"file:{tmp_path}/here/pub/"), n) for p, n in files.tree(f"{tmp_path}/here/pub")] == sorted((k, len(v.encode())) for k, v in told(tmp_path / "here/pub").items())
    with pytest.raises(OSError, match="1 of 2 files"):
        files.copy_all(f"{tmp_path}/here/pub", f"{tmp_path}/other", ["plain.json", "nowhere"])
