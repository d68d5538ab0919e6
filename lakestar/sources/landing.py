"""Landing zone: JSON Lines, run logs, task lists, markers and blobs as DataFrames."""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.functions import urls
from lakestar.operators import relational
from lakestar.sources import export, lines
from lakestar.sources.files import Files


def scan_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines below ``path`` by a fixed schema (a bad line fails), with source_file and the path's ingest_date."""
    if not Files(spark, path).exists(path):
        raise FileNotFoundError(path)
    rows = spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)
    if not len(rows._jdf.inputFiles()):  # names aren't fetched one by one
        raise FileNotFoundError(f"no files below {path}")
    file = F.col("_metadata.file_path")
    return rows.withColumns({"source_file": file, "ingest_date": F.regexp_extract(file, r"ingest_date=([^/]+)", 1).try_cast("date")})


def violations(rows: DataFrame, rules: dict[str, Column], sample: list[str], samples: int = 5) -> DataFrame:
    """rule, n (rows that break it) and samples (JSON of ``sample`` columns) of each rule that is broken, in one pass.

    Samples are the ``samples`` least by their JSON, so the same ones however rows lie. Each task keeps a count and that many
    samples for each rule, and only these are shuffled; good rows stay in the JVM.
    """
    names = list(rules)
    broken = F.array_compact(F.array(*(F.when(F.coalesce(rules[name], F.lit(False)), F.lit(i)) for i, name in enumerate(names))))
    bad = rows.select(broken.alias("broken"), F.to_json(F.struct(*sample), {"ignoreNullFields": "false"}).alias("sample")).where(F.size("broken") > 0)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, kept = Counter(), defaultdict(list)
        for batch in batches:
            broken, found = batch.column("broken"), batch.column("sample")
            rule, row = broken.flatten(), pc.list_parent_indices(broken)
            for i in pc.unique(rule).to_pylist():
                mine = found.take(row.filter(pc.equal(rule, i)))
                n[i] += len(mine)
                kept[i] = sorted([*kept[i], *mine.take(pc.select_k_unstable(mine, samples, [("", "ascending")])).to_pylist()], key=str.encode)[:samples]
        yield pa.RecordBatch.from_pylist([{"i": i, "n": n[i] if not j else 0, "sample": text} for i in n for j, text in enumerate(kept[i])], schema=pa.schema([("i", pa.int32()), ("n", pa.int64()), ("sample", pa.string())]))

    parts = bad.mapInArrow(least, "i int, n long, sample string")
    w = Window.partitionBy("i").orderBy("sample")
    parts = parts.select("i", "sample", F.sum("n").over(Window.partitionBy("i")).alias("n"), F.row_number().over(w).alias("_rn")).where(F.col("_rn") <= samples)
    told = parts.groupBy("i").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("sample")).alias("samples"))
    return told.select(F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("rule"), "n", "samples")


def check_batch(rows: DataFrame, keys: list[str], ts: str, publisher: str | None = None, samples: int = 5) -> int:
    """Raises ValueError on bad dates, times, publishers and keys, with counts and samples of each, and on keys held twice; returns the row count.

    Rows are counted and checked in one pass.
    """
    blank = reduce(lambda a, b: a | b, (F.trim(F.coalesce(F.col(k), F.lit(""))) == "" for k in keys))
    rules = {"ingest_date": F.col("ingest_date").isNull(), ts: F.col(ts).try_cast("timestamp").isNull(), "empty key": blank}
    if publisher is not None:
        rules["publisher"] = ~F.col("publisher").eqNullSafe(F.lit(publisher))
    seen = Observation()
    shown = list(dict.fromkeys(c for c in (*keys, ts, "ingest_date", "publisher", "source_file") if c in rows.columns))
    wrong = {r.rule: (r.n, r.samples) for r in violations(rows.observe(seen, F.count(F.lit(1)).alias("n")), rules, shown, samples).collect()}
    n = seen.get["n"]
    if not n:
        raise FileNotFoundError("the landing zone has no rows")
    if wrong:
        raise ValueError("bad rows: " + "; ".join(f"{rule}: {wrong[rule][0]}, such as {', '.join(wrong[rule][1])}" for rule in rules if rule in wrong))
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).limit(samples).collect()
    if twice:
        raise ValueError(f"keys held twice: {[r.asDict() for r in twice]}")
    return n


def missing_blobs(rows: DataFrame, spark: SparkSession, path: str, key: Column) -> DataFrame:
    """Rows whose blob isn't below ``path``; only names are read."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("_name"))
    return rows.withColumn("_name", key).join(names, "_name", "left_anti").drop("_name")


def last_event(log: DataFrame, event: str, schema: str, order: str = "line_no") -> DataFrame:
    """The last object of an NDJSON log (columns value and ``order``: a number or a place) with this event; broken lines and a BOM are tolerated."""
    text = F.regexp_replace("value", "^﻿", "")
    parsed = log.select(F.col(order).alias("_order"), F.from_json(text, schema, {"mode": "PERMISSIVE"}).alias("e")).where(F.col("e.event") == event)
    return parsed.agg(F.max_by("e", "_order").alias("e")).where("e is not null").select("e.*")


def pending(markers: DataFrame, suffix: str = ".processed") -> DataFrame:
    """Markers (key) without a sibling of that suffix, in order."""
    done = markers.where(F.col("key").endswith(suffix)).select(F.expr(f"substring(key, 1, length(key) - {len(suffix)})").alias("key"))
    return markers.where(~F.col("key").endswith(suffix)).join(done, "key", "left_anti").orderBy("key")


def error_events(log: DataFrame, schema: str = "run_id string, url string, exception string") -> DataFrame:
    """line_no, event and rendered text of the error lines of an NDJSON log (columns line_no, value), with the fields of ``schema``."""
    parsed = log.select("line_no", F.from_json("value", f"event string, level string, {schema}", {"mode": "PERMISSIVE"}).alias("e")).where("e.level in ('error', 'critical')").select("line_no", "e.*")
    fields = [f for f in parsed.columns if f not in ("line_no", "event", "level", "exception")]
    told = [F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{f}="), F.col(f).cast("string"))) for f in fields]
    return parsed.withColumn("rendered", F.concat_ws(" | ", F.coalesce("event", F.lit("error")), *told, *(["exception"] if "exception" in parsed.columns else [])))


def tasks_with_flags(spark: SparkSession, path: str, publisher: str | None = None, aliases: dict[str, str] | None = None, drop_query: str | None = None) -> DataFrame:
    """All rows of a task list (publisher, url, enabled, note), or one publisher's, with ordinal, normalised_url, url_hash and ``first``.

    ``first``: whether an enabled row is the first of its address, by its place in the files (``ordinal``), however these are
    read. A missing column raises, and so does a bad flag or an enabled row's url that isn't an address.
    """
    rows = spark.read.option("header", "true").csv(path)
    lacking = {"publisher", "url", "enabled"} - set(rows.columns)
    if lacking:
        raise ValueError(f"missing columns {sorted(lacking)}")
    rows = rows.select("*", lines.place().alias("ordinal")).withColumns({"publisher": F.trim("publisher"), "url": F.trim("url")})
    # Only rows that are asked for may raise; a filter alone doesn't say when it is applied.
    wanted = F.col("publisher").eqNullSafe(publisher) if publisher else F.lit(True)
    flag = F.lower(F.trim("enabled"))
    enabled = F.when(~wanted, False).when(flag.isin("true", "1", "yes", "y"), True).when(flag.isin("false", "0", "no", "n"), False).otherwise(F.raise_error(F.concat(F.lit("bad flag "), F.coalesce(flag, F.lit("null")))).cast("boolean"))
    rows = rows.withColumn("enabled", enabled).where(wanted).withColumn("normalised_url", F.when(F.col("enabled"), urls.normalize_url(F.col("url"), aliases, drop_query, strict=True)))
    rows = rows.withColumn("url_hash", urls.url_hash(F.col("normalised_url")))
    # The first place of each address is a partial aggregate. Rows without an address would all meet in one task: each has a
    # key of its own place in the join, which no address has.
    first = rows.where("enabled").groupBy(F.col("publisher").alias("_by"), F.col("url_hash").alias("_key")).agg(F.min("ordinal").alias("_first"))
    keyed = rows.withColumn("_key", F.coalesce("url_hash", F.xxhash64("ordinal").cast("string")))
    found = keyed.join(first, (F.col("publisher") == F.col("_by")) & (keyed["_key"] == first["_key"]), "left")
    return found.select(*rows.columns, F.coalesce(F.col("enabled") & (F.col("ordinal") == F.col("_first")), F.lit(False)).alias("first"))


def read_tasks(spark: SparkSession, path: str, publisher: str | None = None, **identity) -> DataFrame:
    """Enabled tasks, each address once: its first row."""
    return tasks_with_flags(spark, path, publisher, **identity).where("first").drop("first")


def task_counts(rows: DataFrame) -> DataFrame:
    """One row: how many rows a task list (with flags) has, are disabled, repeat a url, and remain."""
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    return rows.agg(F.count("*").alias("input_total"), count(~F.col("enabled"), "disabled"), count(F.col("enabled") & ~F.col("first"), "dup_in_file"), count(F.col("first"), "tasks"))


def url_lines(spark: SparkSession, path: str, publisher: str) -> DataFrame:
    """A text file of addresses as task rows, with repeats and their place: blank lines and a BOM go, book series are noted."""
    found = lines.read_lines(spark, path).select(F.col("place").alias("ordinal"), F.trim(F.regexp_replace("value", "[\ufeff\r]", "")).alias("url")).where("url <> ''")
    return found.select(F.lit(publisher).alias("publisher"), "url", F.lit(True).alias("enabled"), F.when(F.lower("url").contains("/bookseries/"), "bookseries").otherwise("").alias("note"), "ordinal")


def migrate_urls(spark: SparkSession, source: str, destination: str, publisher: str) -> int:
    """Writes the addresses of a text file as a task list, in their order, reads it again and returns how many there are.

    The list is a folder of parts whose names follow the order. Rows that were lost, changed or moved raise.
    """
    rows = url_lines(spark, source, publisher)
    ordered = rows.repartitionByRange("ordinal").sortWithinPartitions("ordinal")
    ordered.select("publisher", "url", F.col("enabled").cast("string").alias("enabled"), "note").write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(destination)
    back = spark.read.option("header", "true").csv(destination).select(lines.place().alias("place"), F.col("url").alias("_url"))
    there = lines.numbered(rows.select(F.col("ordinal").alias("place"), "url"), "n", whole=True).select("n", "url")
    here = lines.numbered(back, "n", whole=True).select("n", "_url")
    same = there.join(here, "n", "full_outer").agg(F.count("url").alias("read"), F.count("_url").alias("written"), F.count_if(~F.col("url").eqNullSafe(F.col("_url"))).alias("wrong")).first()
    if same.read != same.written:
        raise RuntimeError(f"the migration lost rows: {same.read} addresses in, {same.written} out")
    if same.wrong:
        raise RuntimeError(f"the migration changed the order or the text of {same.wrong} addresses")
    return same.read


def plan_uploads(local: DataFrame, remote: DataFrame) -> DataFrame:
    """key, size, md5 of local files with an action: empty (skipped), new, unchanged (size and hash agree) or replaced."""
    r = remote.select("key", F.col("size").alias("_size"), F.col("md5").alias("_md5"))
    action = F.when(F.col("size") == 0, "empty").when(F.col("_size").isNull(), "new").when((F.col("size") == F.col("_size")) & F.col("md5").eqNullSafe(F.col("_md5")), "unchanged").otherwise("replaced")
    return local.join(r, "key", "left").withColumn("action", action).drop("_size", "_md5")


def upload_counts(plan: DataFrame) -> DataFrame:
    """One row of counters of an upload plan; ``balanced``: every file has one action."""
    count = lambda *actions: F.count(F.when(F.col("action").isin(*actions), 1))
    size = F.when(F.col("action").isin("new", "replaced"), F.col("size")).otherwise(0)
    row = plan.agg(F.count("*").alias("files_seen"), count("new").alias("uploaded"), count("unchanged").alias("unchanged"), count("replaced").alias("replaced"), count("empty").alias("empty_skipped"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("bytes_uploaded"))
    return row.withColumn("balanced", F.col("uploaded") + F.col("unchanged") + F.col("replaced") + F.col("empty_skipped") == F.col("files_seen"))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """key (below ``root``), size and md5 of all files; the executors read them."""
    schema = "key string, size long, md5 string"
    if not Files(spark, root).exists(root):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inside = F.expr(f"substring(path, locate('{root.split('://')[-1].rstrip('/')}/', path) + {len(root.split('://')[-1].rstrip('/')) + 1})")
    read = files.select(inside.alias("key"), F.col("length").alias("size"), F.md5("content").alias("md5"))
    # Spark passes over empty files.
    base = root.split("://")[-1].rstrip("/") + "/"
    empty = [(path.split(base, 1)[1], 0, None) for path, size in Files(spark, root).tree(root) if not size and not path.endswith("/_SUCCESS") and not path.rpartition("/")[2].startswith(".")]
    return read.where("size > 0").union(spark.createDataFrame(empty, schema))


def land(spark: SparkSession, local: str, remote: str, publisher: str, now: str) -> tuple[dict, str | None]:
    """Mirrors new and changed files below ``local``/``publisher`` to ``remote``, then writes a marker if anything changed.

    The marker is written last, so whoever sees it finds all files. Returns the counters and the marker's path.
    """
    if not publisher or publisher in (".", "..") or "/" in publisher or "\\" in publisher:
        raise ValueError(f"bad publisher {publisher!r}")
    source, target, files = f"{local.rstrip('/')}/{publisher}", f"{remote.rstrip('/')}/{publisher}", Files(spark, remote)
    here = listing(spark, source)
    if here.isEmpty():
        raise FileNotFoundError(f"no files below {source}")
    plan = plan_uploads(here, listing(spark, target)).persist()
    try:
        counts = upload_counts(plan).first().asDict()
        if not counts.pop("balanced"):
            raise RuntimeError(f"counters don't balance: {counts}")
        changed = plan.where("action in ('new', 'replaced')").select("key")
        files.copy_all(source, target, (row.key for row in changed.toLocalIterator()))
    finally:
        plan.unpersist()
    if not counts["uploaded"] + counts["replaced"]:
        return counts, None
    marker = f"{remote.rstrip('/')}/_markers/{publisher}/{re.sub('[^0-9TZ]', '', now)}.json"
    files.create(marker, json.dumps({"publisher": publisher, "landed_at": now} | counts, sort_keys=True))
    return counts, marker


def write_jsonl(rows: DataFrame, root: str, flush: int = 200) -> None:
    """Appends rows (with publisher and ingest_date) as JSON Lines below <root>/<publisher>/ingest_date=<day>, ``flush`` lines a file at most."""
    for publisher in [r.publisher for r in rows.select("publisher").distinct().collect()]:
        mine = rows.where(F.col("publisher") == publisher)
        out = mine.select(F.col("ingest_date").alias("_day"), *[c for c in rows.columns if c != "ingest_date"])
        out.withColumnRenamed("_day", "ingest_date").write.mode("append").partitionBy("ingest_date").option("maxRecordsPerFile", flush).option("ignoreNullFields", "false").json(f"{root.rstrip('/')}/{publisher}")


def latest_lines(rows: DataFrame, key: str, order: tuple[str, ...] = ("ingest_date", "run_id", "line_no")) -> DataFrame:
    """The newest row of each key over all landed parts; in a part the later line."""
    return relational.latest_per_key(rows, [key], [F.desc(c) for c in order])


def exported(rows: DataFrame, manifest: DataFrame, group: str = "journal_url", key: str = "url_hash", order: tuple[str, ...] = ("ingest_date", "run_id", "line_no")) -> DataFrame:
    """The newest rows whose manifest status is ok and that have a journal, without the columns that told which is newest."""
    ok = manifest.where("status = 'ok'").select(key)
    latest = latest_lines(rows, key, order).join(ok, key, "left_semi").where(F.col(group).isNotNull() & (F.col(group) != ""))
    return latest.select(group, key, *[c for c in rows.columns if c not in (group, key, *order)])


def export_journals(rows: DataFrame, manifest: DataFrame, root: str, group: str = "journal_url", title: str = "journal_title", key: str = "url_hash", order: tuple[str, ...] = ("ingest_date", "run_id", "line_no"), columns: list[str] | None = None) -> DataFrame:
    """One JSON file per journal below ``root`` of the newest rows whose manifest status is ok, in key order; slug and articles of each."""
    return export.write_documents(exported(rows, manifest, group, key, order), root, group, title, key, columns)
