import datetime
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestar.__main__ import main
from lakestar.operators import dims, gates, relational
from lakestar.plans import lakehouse as lh
from lakestar.plans.gold import classify_key, merge_type1, star_violations
from lakestar.sources import health, landing
from lakestar.sources.files import Files
from lakestar.sources.lock import LockHeld, lock
from lakestar.sources.publish import Warehouse, ddl, latest_success, publish, publish_logged
from lakestar.sources.table import Clause, CommitConflict, VersionedTable, insert_only, upsert


def record(h, **more):
    row = dict.fromkeys(lh.TEXT_COLUMNS, "") | {c: [] for c in (*lh.ROLE_COLUMNS, *lh.RICH_COLUMNS)}
    row |= {"run_id": "run-1", "scraped_at": "2026-09-26T05:35:06.839069Z", "publisher": "pub", "url_hash": h, "source_url": f"https://example.test/{h}", "payload_hash": h}
    row |= {"article_url": f"https://example.test/{h}", "journal_url": "https://example.test/j", "journal_title": "J", "english_title": f"Title {h}", "doi": f"10.1016/{h}", "authors": [{"name": "Ann B.", "affiliation": "", "email": ""}]}
    return row | more


class Lake:
    def __init__(self, spark, root):
        self.spark, self.landing = spark, root / "landing"
        t = lambda n: VersionedTable(spark, f"{root}/{n}")
        self.bronze, self.silver, self.quarantine, self.dq = t("bronze"), t("silver"), t("quarantine"), t("dq")
        self.gold = {n: t(n) for n in lh.TABLES}

    def land(self, day, run, *rows):
        folder = self.landing / f"pub/ingest_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{run}.jsonl").write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))

    def load(self):
        return lh.load_bronze(self.spark, str(self.landing), self.bronze, "pub", "2026-10-01T00:00:00Z")

    def refine(self, now="2026-10-01T00:00:00Z"):
        return lh.build_silver(self.bronze, self.silver, self.quarantine, self.dq, "dq-1", now)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_bronze_is_idempotent_and_append_only(lake):
    lake.land("2026-09-24", "run-1", record("a"), record("b"))
    assert lake.load().inserted == 2
    again = lake.load()
    assert again.skipped and again.version == lake.bronze.version()
    with pytest.raises(ValueError, match="append-only"):
        lake.bronze.overwrite(lake.bronze.read())


@pytest.mark.parametrize("rows", [[record("a"), record("a")], [record("a", publisher="other")], [record("a", scraped_at="never")], [record("")]])
def test_bad_batches_are_refused(lake, rows):
    lake.land("2026-09-24", "run-1", *rows)
    with pytest.raises(ValueError):
        lake.load()
    assert not lake.bronze.exists()


def test_malformed_lines_fail_and_empty_landing_raises(lake):
    with pytest.raises(FileNotFoundError):
        lake.load()
    lake.land("2026-09-24", "run-1", record("a"), "this is not JSON")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|FAILED_READ"):
        lake.load()


def test_newest_valid_version_wins_and_history_counts_all(lake):
    lake.land("2026-09-24", "run-1", record("a", scraped_at="2026-09-24T00:00:00Z"), record("q", english_title=" "))
    lake.land("2026-09-25", "run-2", record("a", run_id="run-2", scraped_at="2026-09-25T00:00:00Z", english_title="New"))
    lake.land("2026-09-26", "run-3", record("a", run_id="run-3", scraped_at="2026-09-26T00:00:00Z", english_title=""))
    lake.load()
    done = lake.refine()
    row = lake.silver.read().first()
    assert (done.rows, done.quarantined) == (1, 2)
    assert (row.english_title, row.version_count, str(row.first_seen_at)) == ("New", 3, "2026-09-24 00:00:00")
    assert lake.refine().merge.skipped


def test_cleaning_of_records(lake):
    good = record("g", article_publication_month="Sep", article_publication_day="31", article_publication_year="2019", reference_count=" 7 ", copyright_year="2018", start_page="41", last_page="44", author_keyword="x|| y|x", doi="doi: 10.5555/AbC", license_type="https://creativecommons.org/licenses/by/4.0/", volume="012", issue="2", authors=[{"name": " Eva   Q. ", "affiliation": "", "email": " e@q "}, {"name": "", "affiliation": "lost", "email": ""}])
    odd = record("o", article_publication_month="Winter", article_publication_year="2019", issue_publication_month="May-June", reference_count="many", copyright_year="3000", start_page="9", last_page="8", volume="+3", issue="000000000012", doi="", article_type="  ", authors=[])
    lake.land("2026-09-24", "r", good, odd)
    lake.load()
    lake.refine()
    g, o = lake.silver.read().orderBy("url_hash").collect()
    assert (g.article_pub_month, g.article_pub_day, g.article_date_precision, str(g.article_pub_month_start)) == (9, None, "month", "2019-09-01")
    assert (g.reference_count, g.copyright_year, g.page_count, g.volume_num, g.issue_num, g.keywords) == (7, 2018, 4, 12, 2, ["x", "y"])
    assert (g.doi, g.doi_valid, g.license_code, g.author_count, g.authors[0].name, g.authors[0].email) == ("10.5555/abc", True, "CC BY 4.0", 1, "Eva Q.", "e@q")
    assert (o.article_pub_month, o.article_date_precision, o.reference_count, o.copyright_year, o.page_count, o.volume_num, o.issue_num) == (None, "year", None, None, None, None, 12)
    assert (o.doi, o.doi_valid, o.article_type_key) == (None, False, None)
    assert o.dq_flags == ["missing_doi", "no_authors", "missing_abstract", "unparsed_pub_month", "month_range", "bad_reference_count", "bad_copyright_year", "bad_page_range"]
    assert lake.dq.read().count() == len(lh.RULES)


def test_records_without_a_raw_page_are_loaded_with_a_warning(lake, spark, tmp_path):
    lake.land("2026-09-24", "run-1", record("a"), record("b"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.html.gz").write_bytes(b"x")
    with pytest.warns(UserWarning, match="1 records without a raw page"):
        assert lh.load_bronze(spark, str(lake.landing), lake.bronze, "pub", "2026-10-01T00:00:00Z", f"{tmp_path}/raw").inserted == 2


def test_classes_without_spark():
    assert classify_key("case_report") == ("research", True) and classify_key("editorial_board") == ("front_back_matter", False) and classify_key(None) == classify_key("x") == ("unclassified", False)


def test_silver_heals_rows_that_were_altered(lake):
    lake.land("2026-09-24", "run-1", record("a"), record("b"))
    lake.load()
    lake.refine()
    lake.silver.overwrite(lake.silver.read().withColumn("english_title", F.when(F.col("url_hash") == "a", "tampered").otherwise(F.col("english_title"))))
    done = lake.refine()
    assert done.merge.updated == 1 and {r.english_title for r in lake.silver.read().collect()} == {"Title a", "Title b"}


def test_gold_renames_journals_and_keeps_facts_as_of(lake, spark):
    lake.land("2026-09-24", "run-1", record("a", scraped_at="2026-09-24T00:00:00Z"), record("b", scraped_at="2026-09-24T00:00:00Z", authors=[{"name": "ANN B", "affiliation": "", "email": ""}, {"name": "Cy", "affiliation": "", "email": ""}], article_type="Alien material"))
    lake.load()
    lake.refine()
    lh.build_gold(spark, lake.silver.read(), lake.gold)
    lake.land("2026-09-27", "run-2", record("a", run_id="run-2", scraped_at="2026-09-27T00:00:00Z", journal_title="J2"))
    lake.load()
    lake.refine()
    done = lh.build_gold(spark, lake.silver.read(), lake.gold)
    unknown, *versions = lake.gold["dim_journal"].read().orderBy("effective_from").collect()
    assert (unknown.journal_sk, unknown.publisher, unknown.is_current) == (-1, "Unknown", True)
    assert [(v.journal_title, v.is_current) for v in versions] == [("J", False), ("J2", True)] and versions[0].effective_to == versions[1].effective_from
    facts = {r.url_hash: r.journal_sk for r in lake.gold["fact_article"].read().collect()}
    assert facts == {"a": versions[1].journal_sk, "b": versions[0].journal_sk}
    assert done["dim_date"].skipped and lake.gold["dim_author"].read().count() == 3
    kind = lake.gold["dim_article_type"].read().where("article_type_key = 'alien_material'").first()
    assert (kind.content_class, kind.is_scholarly) == ("unclassified", False)
    assert lh.build_gold(spark, lake.silver.read(), lake.gold)["fact_article"].skipped


def test_issues_and_broken_stars(lake, spark):
    more = {"issue_url": "https://example.test/i1", "volume": "3"}
    lake.land("2026-09-24", "run-1", record("a", **more), record("b", scraped_at="2026-09-27T00:00:00Z", **{**more, "volume": "4"}), record("c"))
    lake.load()
    lake.refine()
    lh.build_gold(spark, lake.silver.read(), lake.gold)
    issues = {r.issue_url: r for r in lake.gold["dim_issue"].read().collect()}
    assert set(issues) == {"Unknown", "https://example.test/i1"} and issues["https://example.test/i1"].volume_num == 4 and issues["Unknown"].issue_sk == -1
    facts = {r.url_hash: r for r in lake.gold["fact_article"].read().collect()}
    assert facts["a"].issue_sk == issues["https://example.test/i1"].issue_sk and facts["c"].issue_sk == -1 and facts["a"].version_count == 1 and len(facts["a"]._row_hash) == 64
    # Each broken invariant is told.
    broken = lake.gold["fact_article"].read().withColumns({"issue_sk": F.lit(5).cast("long"), "journal_sk": F.lit(6).cast("long")})
    lake.gold["fact_article"].overwrite(broken.where("url_hash <> 'c'"))
    wrong = star_violations(lake.silver.read(), lake.gold).first().asDict()
    assert {k for k, n in wrong.items() if n} == {"orphans_fact_article_issue_sk", "orphans_fact_article_journal_sk", "facts", "orphans_bridge_article_author_article_sk"}
    with pytest.raises(ValueError, match="surrogate keys collide"):
        merge_type1(lake.gold["dim_author"], lake.gold["dim_author"].read().withColumn("author_nk", F.concat("author_nk", F.lit("!"))), "author_sk", ("author_nk",))


def test_merge_rules(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t").create("id int, v string")
    one = spark.createDataFrame([(1, "one")], "id int, v string")
    assert t.merge(one, ["id"], insert_only()).inserted == 1
    with pytest.raises(ValueError, match="several source rows"):
        t.merge(one.union(one), ["id"], upsert("true"))
    first_wins = t.merge(one, ["id"], [Clause("update", "matched", "true", {"v": "'first'"}), Clause("delete", "matched")])
    assert (first_wins.updated, first_wins.deleted, t.read().first().v) == (1, 0, "first")
    assert t.read(version=1).first().v == "one" and [r.operation for r in t.history().orderBy("version").collect()] == ["CREATE TABLE", "MERGE", "MERGE"]
    with pytest.raises(CommitConflict):
        t._commit(2, "WRITE", {}, [], [])
    with pytest.raises(ValueError):
        t.vacuum(1)


def test_compaction_keeps_rows(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t").create("id int, tags array<string>", properties={"appendOnly": "true"})
    for i in range(3):
        t.append(spark.createDataFrame([(i, [f"t{i}"]), (i + 10, None)], "id int, tags array<string>").coalesce(1))
    assert t.detail()["files"] == 3 and t.optimize() and t.detail()["files"] == 1 and t.read().count() == 6 and not t.optimize()


def test_publication_swaps_and_skips(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t").create("id int, v string")
    t.append(spark.createDataFrame([(1, "x")], "id int, v string"))
    w = Warehouse(spark, f"jdbc:derby:{tmp_path}/db;create=true")
    done = publish(w, {"dim_t": t}, {"dim_t": ["id"]})
    assert done.rows == {"dim_t": 1} and publish(w, {"dim_t": t}, {}, done.versions).skipped
    with pytest.raises(Exception):
        w.execute("DELETE FROM dim_t", "INSERT INTO nowhere VALUES (1)", transaction=True)
    assert w.read("dim_t").count() == 1
    with pytest.raises(ValueError):
        ddl("bad name", t.read().schema)
    log = VersionedTable(spark, f"{tmp_path}/log")
    assert not publish_logged(w, {"dim_t": t}, {}, log).skipped and publish_logged(w, {"dim_t": t}, {}, log).skipped
    with pytest.raises(ValueError):
        publish_logged(w, {"bad name": t}, {}, log, force=True)
    assert latest_success(log) == {"dim_t": 1} and [r.status for r in log.read().orderBy("started_at").collect()] == ["success", "failed"]


def test_a_publication_that_does_not_hold_is_never_live(spark, tmp_path):
    t = lambda name, ddl, rows: (lambda v: (v.append(spark.createDataFrame(rows, ddl)), v)[1])(VersionedTable(spark, f"{tmp_path}/{name}").create(ddl))
    dim, fact = t("dim_d", "d_sk int, v string", [(1, "x")]), t("fact_f", "f_sk int, d_sk int", [(1, 1)])
    w, foreign = Warehouse(spark, f"jdbc:derby:{tmp_path}/db2;create=true"), {"fact_f": {"d_sk": ("dim_d", "d_sk")}}
    keys, log = {"dim_d": ["d_sk"], "fact_f": ["f_sk"]}, VersionedTable(spark, f"{tmp_path}/log")
    assert publish_logged(w, {"dim_d": dim, "fact_f": fact}, keys, log, foreign=foreign).rows == {"dim_d": 1, "fact_f": 1}
    fact.append(spark.createDataFrame([(2, 9)], "f_sk int, d_sk int"))
    with pytest.raises(Exception, match="orphans"):
        publish_logged(w, {"dim_d": dim, "fact_f": fact}, keys, log, foreign=foreign)
    assert w.read("fact_f").count() == 1 and {r.TABLE_NAME: r.TABLE_VERSION for r in w.read("layer_status").collect()} == {"dim_d": 1, "fact_f": 1}
    with lock(spark, f"{log.root}.lock"), pytest.raises(LockHeld):
        publish_logged(w, {"dim_d": dim}, keys, log)


def test_log_checkpoints_and_replaced_rows(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t").create("id int, p string", ("p",))
    for i in range(12):
        t.append(spark.createDataFrame([(i, "a" if i % 2 else "b")], "id int, p string"), files=1)
    assert t.files.exists(f"{tmp_path}/t/_log/{10:020d}.checkpoint.json") and t.version() == 12
    assert sorted(r.id for r in t.read().collect()) == list(range(12)) and t.read(version=11).count() == 11 and t.read(version=3).count() == 3
    t.replace_where(spark.createDataFrame([(99, "a")], "id int, p string"), "p = 'a' or id = 2")
    assert sorted(r.id for r in t.read().collect()) == [0, 4, 6, 8, 10, 99]


def test_changes_at_one_time_follow_their_order(spark):
    rows = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 1, 2), (1, "c", 1, 3), (1, "c", 2, 4)], "k int, v string, t int, o int").withColumn("t", F.timestamp_seconds("t"))
    got = dims.scd2(rows, ["k"], "t", ["v"], [F.col("t"), F.col("o")]).collect()
    assert sorted((r.v, r.effective_from == r.effective_to, r.is_current) for r in got) == [("a", True, False), ("b", True, False), ("c", False, True)]


def test_landing_mirrors_files_and_marks_last(spark, tmp_path):
    local, remote = f"{tmp_path}/local", f"{tmp_path}/remote"
    rows = spark.createDataFrame([("pub", "2026-01-01", "a", 1), ("pub", "2026-01-02", "b", None)], "publisher string, ingest_date string, v string, n int")
    landing.write_jsonl(rows, local)
    (tmp_path / "local/pub/empty.jsonl").write_text("")
    counts, marker = landing.land(spark, local, remote, "pub", "2026-01-03T00:00:00Z")
    assert counts["uploaded"] >= 2 and counts["empty_skipped"] >= 1 and marker.endswith("_markers/pub/20260103T000000Z.json")
    assert json.loads(Files(spark, remote).read(marker))["uploaded"] == counts["uploaded"]
    again, none = landing.land(spark, local, remote, "pub", "2026-01-04T00:00:00Z")
    assert none is None and again["unchanged"] == counts["uploaded"]
    got = landing.scan_jsonl(spark, f"{remote}/pub", "publisher string, v string, n int")
    assert sorted((r.v, str(r.ingest_date)) for r in got.collect()) == [("a", "2026-01-01"), ("b", "2026-01-02")]
    with pytest.raises(ValueError):
        landing.land(spark, local, remote, "../pub", "now")
    with pytest.raises(FileNotFoundError):
        landing.land(spark, local, remote, "nobody", "now")


def test_health_of_complete_and_incomplete_runs(spark, tmp_path):
    (tmp_path / "r1").mkdir()
    (tmp_path / "r1/log").write_text('x\n{"event":"ingestion_run_complete","run_id":"run-7","timestamp":"2026-01-01T00:00:00Z","bronze_written":3}\n{"event":')
    done = health.run_row(spark, f"{tmp_path}/r1/log", "p", 0, "2026-01-02").first()
    assert (done.run_id, done.status, done.bronze_written, done.parse_failed) == ("run-7", "complete", 3, None)
    lost = health.run_row(spark, f"{tmp_path}/r2/log", "p", 1, "2026-01-02").first()
    assert (lost.run_id, lost.status, lost.ingest_exit_code) == ("incomplete-r2", "incomplete", 1)


def test_claims_follow_bronze(spark):
    order = []
    gates.commit_batch(lambda: order.append("bronze"), lambda: order.append("manifest"))
    assert order == ["bronze", "manifest"]

    def fails():
        raise OSError("disk full")

    with pytest.raises(OSError):
        gates.commit_batch(fails, lambda: order.append("claimed"))
    assert order == ["bronze", "manifest"]
    with pytest.raises(RuntimeError):
        gates.balance(spark.createDataFrame([("a", 2)], "outcome string, n long"), 3)


def test_command_line_from_pages_to_gold(spark, tmp_path, capsys):
    root = f"{tmp_path}/lake"
    run = lambda command, *more: main([command, "--root", root, "--publisher", "pub", *more])
    assert run("producer", "--listing", "x", "--records", "y") == 3
    assert run("init") == 0
    listed = [{"url_hash": h, "normalised_url": f"https://x/{h}", "url_type": "article", "ordinal": i, "doi": f"10.1/{h}", "payload_hash": h, "http_status": 200, "result": "ok"} for i, h in enumerate(("a", "b", "a"))]
    (tmp_path / "listing.jsonl").write_text("\n".join(map(json.dumps, listed)))
    (tmp_path / "records.jsonl").write_text("\n".join(json.dumps(record(h) | {"ordinal": i}) for i, h in enumerate(("a", "b"))))
    inputs = ("--listing", f"{tmp_path}/listing.jsonl", "--records", f"{tmp_path}/records.jsonl")
    assert run("producer", *inputs) == 0 and "dup_in_run_url" in capsys.readouterr().out
    assert [run("bronze"), run("silver", "--sample", "2"), run("gold", "--queries")] == [0, 0, 0]
    assert "articles by journal and class" in capsys.readouterr().out
    table = lambda n: VersionedTable(spark, f"{root}/{n}").read()
    assert table("gold/fact_article").count() == 2 and table("manifest").where("status = 'ok'").count() == 2 and table("ops/status").first().row_count == 2
    assert run("export") == 0 and len(json.loads((tmp_path / "lake/out/pub/J/J.json").read_text())["articles"]) == 2
    assert [run("publish", "--warehouse", f"jdbc:derby:{tmp_path}/w;create=true"), run("smoke"), run("maintenance", "--vacuum-hours", "3"), run("maintenance", "--dry-run")] == [0, 0, 2, 0]
    assert run("producer", "--listing", f"{tmp_path}/none", "--records", "y") == 1
    with lock(spark, f"{root}/_producer.lock"):
        assert run("producer", *inputs) == 5
    # The second run finds everything fresh.
    assert run("ingest", *inputs) == 0 and "skipped_manifest" in capsys.readouterr().out


def test_settings_are_strict():
    from lakestar.settings import KEYS, load

    text = "".join(f"[{s}]\n" + "".join(f"{k} = {'3' if t is int else '/x'}\n" for k, t in keys.items()) for s, keys in KEYS.items())
    secrets = {"LAKESTAR_WAREHOUSE_URL": "jdbc:x"}
    assert load(text, secrets).article_days == 3
    for bad, env in ((text + "[more]\na = 1\n", secrets), (text.replace("lake = /x\n", ""), secrets), (text, {}), (text.replace("article_days = 3", "article_days = -3"), secrets), (text.replace("article_days = 3", "article_days = x"), secrets)):
        with pytest.raises(ValueError):
            load(bad, env)


def test_asof_scan_is_the_join(spark):
    import random

    rng = random.Random(4)
    versions, facts = [], []
    for k in (1, 2, 3):
        cuts = sorted(rng.sample(range(0, 400_000, 500), 12))
        versions += [(k, f"v{i}", a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if i != 5]
    facts = [(i, rng.choice((1, 2, 3, 4, None)), rng.choice([v[2] for v in versions] + [rng.randrange(0, 450_000) for _ in range(60)])) for i in range(400)] + [(400, 1, None)]
    v = spark.createDataFrame(versions, "k int, name string, a long, b long").select("k", "name", F.timestamp_seconds("a").alias("effective_from"), F.timestamp_seconds("b").alias("effective_to"))
    f = spark.createDataFrame(facts, "id int, k int, t long").select("id", "k", F.timestamp_seconds("t").alias("t"))
    want = sorted(map(str, relational.asof_join(f, v, ["k"], "t").select("id", "k", "t", "name", "effective_from", "effective_to").collect()))
    for every in ("hour", "day", "month"):
        assert sorted(map(str, relational.asof_scan(f, v, ["k"], "t", every=every).select("id", "k", "t", "name", "effective_from", "effective_to").collect())) == want


def test_files_are_created_once(spark, tmp_path):
    f = Files(spark, str(tmp_path))
    f.create(f"{tmp_path}/x", "é")
    assert f.read(f"{tmp_path}/x") == "é"
    with pytest.raises(Exception):
        f.create(f"{tmp_path}/x", "y")


def test_empty_table_reads_with_schema(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t").create("id int, v string")
    assert t.read().columns == ["id", "v"] and t.read().agg(F.count("*")).first()[0] == 0


def test_an_embedded_warehouse_keeps_values_on_their_way_in_and_out(spark, tmp_path):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)
    rows = [(1, "plain", True, 1.5, at.date(), at), (2, "", False, -2e10, None, None), (3, None, None, None, None, at), (4, 'a "q", b\nnew\r\nline\rcr', True, 0.1, None, None), (5, "  pad  ", None, None, None, None), (6, 'é\\n\\"漢\t', None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, key string, b boolean, d double, day date, at timestamp")
    w = Warehouse(spark, f"jdbc:derby:{tmp_path}/values;create=true")
    w.execute(ddl("stage_t", df.schema, ["id"], w.stage_text))
    for _ in range(2):
        w.write(df, "stage_t")
    assert sorted(tuple(r) for r in w.read("stage_t").collect()) == rows and w.count("stage_t") == 6


def test_publication_reaches_its_database_from_executors_of_their_own(sf_dir, tmp_path):
    code = f"""
import __spark_entry__
from lakestar.session import build_session
spark = build_session("cluster", "local-cluster[1,1,1024]", {{"spark.checkpoint.dir": "file://{tmp_path}/shared", "spark.sql.shuffle.partitions": "2"}})
rows = __spark_entry__.queries()["r107_publication"](spark, "{sf_dir}").collect()
assert len(rows) == 2 and all(r.live == r.pinned > 0 and r.runs == "failed,success" for r in rows), rows
"""
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
