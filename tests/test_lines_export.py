"""Lines keep their files' order however files are cut, and journals become one ordered file each."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestar.sources import export, health, landing, lines


@pytest.fixture
def ranges(spark):
    """Files are read in ranges of 64 kB, several to a task, in an order that isn't the files'."""
    keys = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.files.minPartitionNum": "3"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def test_numbers_and_ends_of_several_files(ranges, tmp_path):
    spark, rng, text = ranges, random.Random(2), []
    for i, size in enumerate((90_000, 400_000, 30, 250_000)):
        rows, n = [], 0
        while n < size:
            rows.append(f"{i}:{len(rows)}:" + "x" * rng.randrange(0, 300))
            n += len(rows[-1]) + 1
        (tmp_path / f"part-{i}.txt").write_text(("﻿" if i == 1 else "") + "\n".join(rows) + "\n")
        text.append(rows)
    whole = [r for rows in text for r in rows]
    found = lines.read_lines(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 5
    assert [r.value for r in found.orderBy("place").collect()] == whole
    assert [(r.n, r.value) for r in lines.numbered(found, "n", whole=True).orderBy("n").collect()] == list(enumerate(whole, 1))
    each = {(r.place.file[-5], r.line_no): r.value for r in lines.numbered(found).collect()}
    assert each == {(str(i), k): v for i, rows in enumerate(text) for k, v in enumerate(rows, 1)}
    assert found.agg(F.max_by("value", "place"), F.min_by("value", "place")).first()[:] == (whole[-1], whole[0])


def test_last_event_of_a_long_log(ranges, tmp_path):
    log = tmp_path / "run-9" / "log"
    log.parent.mkdir()
    event = lambda i: json.dumps({"event": health.COMPLETE, "run_id": f"r{i}", "timestamp": "2026-01-01T00:00:00Z", "bronze_written": i})
    log.write_text("\n".join(event(i) if i % 100 == 0 else "Traceback " + "y" * 200 for i in range(3001)) + "\n{broken\n")
    assert log.stat().st_size > 8 * 65536
    assert health.run_row(ranges, str(log), "p", 0, "2026-02-01").first().run_id == "r3000"
    log.write_text("no event\n")
    lost = health.run_row(ranges, str(log), "p", 1, "2000-01-01").first()
    assert lost.status == "incomplete" and lost.run_id == "incomplete-run-9" and lost.finished_at.year >= 2024  # the file's time, not the push's


def test_newest_line_wins_over_ranges(ranges, tmp_path):
    for day, part in (("2026-01-01", "a"), ("2026-01-02", "a"), ("2026-01-02", "b")):
        folder = tmp_path / f"ingest_date={day}"
        folder.mkdir(exist_ok=True)
        (folder / f"part-{part}.jsonl").write_text("\n".join(json.dumps({"url_hash": f"h{i % 50}", "v": f"{day}{part}{i}", "pad": "z" * 90}) for i in range(2000)))
    rows = ranges.read.schema("url_hash string, v string").option("recursiveFileLookup", "true").json(str(tmp_path)).select("*", F.regexp_extract("_metadata.file_path", "ingest_date=([^/]+)", 1).alias("ingest_date"), F.lit("r").alias("run_id"), lines.place().alias("line_no"))
    assert {r.v for r in landing.latest_lines(rows, "url_hash").collect()} == {f"2026-01-02b{i}" for i in range(1950, 2000)}


def test_tasks_go_by_address_and_place(ranges, tmp_path):
    rows = [f"p,https://x.test/{i % 700}{'/' if i % 3 else '#f'},{'yes' if i % 5 else 'no'},note {i} {'w' * 60}" for i in range(4000)] + ["q,nowhere,true,", "q,https://x.test/1,maybe,"]
    (tmp_path / "t.csv").write_text("publisher,url,enabled,note\n" + "\n".join(rows) + "\n")
    assert (tmp_path / "t.csv").stat().st_size > 4 * 65536
    want = {}
    for i in range(4000):
        if i % 5:
            want.setdefault(i % 700, i)
    got = landing.read_tasks(ranges, str(tmp_path / "t.csv"), "p")
    assert {int(r.note.split()[1]) for r in got.collect()} == set(want.values())
    counts = landing.task_counts(landing.tasks_with_flags(ranges, str(tmp_path / "t.csv"), "p")).first()
    assert (counts.input_total, counts.disabled, counts.tasks, counts.dup_in_file) == (4000, 800, len(want), 3200 - len(want))
    with pytest.raises(PySparkException, match="not an address|bad flag"):
        landing.read_tasks(ranges, str(tmp_path / "t.csv"), "q").collect()


def test_migration_keeps_count_and_order(ranges, tmp_path, monkeypatch):
    urls = [f"https://x.test/{'bookSeries' if i % 7 == 0 else 'journal'}/{(i * 7919) % 5000}" for i in range(6000)]
    (tmp_path / "urls.txt").write_text("﻿" + "\r\n".join(f"  {u}" + "\r\n" * (i % 2) for i, u in enumerate(urls)))
    assert landing.migrate_urls(ranges, str(tmp_path / "urls.txt"), str(tmp_path / "list"), "p") == 6000
    parts = sorted((tmp_path / "list").glob("part-*.csv"))
    read = [line.split(",") for part in parts for line in part.read_text().splitlines()[1:]]
    assert [r[1] for r in read] == urls and {tuple(r[0::2]) for r in read} == {("p", "true")} and [r[3] == "bookseries" for r in read] == ["bookSeries" in u for u in urls]
    assert all(part.read_text().startswith("publisher,url,enabled,note\n") for part in parts)
    # A list that isn't in the text's order is refused.
    whole = landing.url_lines
    monkeypatch.setattr(landing, "url_lines", lambda *a: whole(*a).withColumn("ordinal", F.col("ordinal").withField("at", -F.col("ordinal.at"))))
    monkeypatch.setattr(landing.lines, "numbered", (lambda real, seen: lambda rows, *a, **k: real(rows.withColumn("place", F.col("place").withField("at", -F.col("place.at"))) if not seen.append(1) and len(seen) == 1 else rows, *a, **k))(lines.numbered, []))
    with pytest.raises(RuntimeError, match="changed the order"):
        landing.migrate_urls(ranges, str(tmp_path / "urls.txt"), str(tmp_path / "list"), "p")


ARTICLE = "journal_url string, journal_title string, url_hash string, text string, n int"


def test_a_file_per_journal_in_order(spark, tmp_path):
    rng = random.Random(1)
    titles = {f"https://x/j{i}": t for i, t in enumerate(("Plain", " A: B/C*?  of “D” ", "under__score\tand\x01control", "___", "é" + "x" * 200, "100% = sure"))}
    rows = [(u, t, f"h{rng.randrange(10**9):09d}", 'quote " and \n line, é', i if i % 3 else None) for i in range(40) for u, t in titles.items()]
    done = export.write_documents(spark.createDataFrame(rows, ARTICLE).repartition(7), str(tmp_path), "journal_url", "journal_title", "url_hash")
    slugs = {"https://x/j0": "Plain", "https://x/j1": "A_B_C_of_“D”", "https://x/j2": "under_score_and_control", "https://x/j3": "untitled", "https://x/j4": "é" + "x" * 149, "https://x/j5": "100%_=_sure"}
    assert {(r.slug, r.articles) for r in done.collect()} == {(s, 40) for s in slugs.values()}
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(slugs.values())
    for u, s in slugs.items():
        want = sorted((r for r in rows if r[0] == u), key=lambda r: r[2])
        assert [p.name for p in (tmp_path / s).glob("*.json")] == [f"{s}.json"]
        document = json.loads((tmp_path / s / f"{s}.json").read_text())
        assert list(document) == ["articles"] and [(a["url_hash"], a["text"], a["n"]) for a in document["articles"]] == [r[2:] for r in want]
    back = export.read_documents(spark, str(tmp_path), "url_hash string, text string, n int").collect()
    assert {(r.slug, r.position, r.article.url_hash, r.article.n) for r in back} == {(slugs[u], k, r[2], r[4]) for u in slugs for k, r in enumerate(sorted((r for r in rows if r[0] == u), key=lambda r: r[2]), 1)}
    # Written again: the file of that journal is replaced, the others stay.
    export.write_documents(spark.createDataFrame(rows[:1], ARTICLE), str(tmp_path), "journal_url", "journal_title", "url_hash")
    assert len(json.loads((tmp_path / "Plain/Plain.json").read_text())["articles"]) == 1 and len(list(tmp_path.iterdir())) == 6


def test_journals_that_have_no_one_name(spark, tmp_path):
    write = lambda rows: export.write_documents(spark.createDataFrame(rows, ARTICLE), str(tmp_path), "journal_url", "journal_title", "url_hash")
    with pytest.raises(ValueError, match="several titles"):
        write([("u", "A", "1", "", 1), ("u", "B", "2", "", 1)])
    with pytest.raises(ValueError, match="journals of one name"):
        write([("u", "A b", "1", "", 1), ("v", "A_b", "2", "", 1)])
    with pytest.raises(PySparkException, match="an article without journal_url"):
        write([(None, "A", "1", "", 1)])
    assert write([]).collect() == [] and not list(tmp_path.glob("*/*.json"))


def test_a_journal_larger_than_a_task_keeps(spark, tmp_path):
    """One journal of more bytes than a sort keeps in memory is spilled and streamed; no row holds it."""
    spark.conf.set("spark.sql.windowExec.buffer.in.memory.threshold", "16")
    spark.conf.set("spark.sql.windowExec.buffer.spill.threshold", "10000")
    try:
        rows = spark.range(60_000).select(F.lit("u").alias("journal_url"), F.lit("Big").alias("journal_title"), F.lpad(F.hex(F.xxhash64("id")), 16, "0").alias("url_hash"), F.repeat(F.lit("text "), 60).alias("text"), F.lit(1).alias("n"))
        assert export.write_documents(rows, str(tmp_path), "journal_url", "journal_title", "url_hash").first().articles == 60_000
    finally:
        spark.conf.unset("spark.sql.windowExec.buffer.in.memory.threshold")
        spark.conf.unset("spark.sql.windowExec.buffer.spill.threshold")
    back = export.read_documents(spark, str(tmp_path), "url_hash string").select("position", "article.url_hash")
    assert back.count() == 60_000 and back.join(back.selectExpr("position + 1 as position", "url_hash as before"), "position").where("before >= url_hash").isEmpty()
