"""Scrape health: runs from logs, status and journal snapshots of the manifest, pushed to versioned tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.gates import OUTCOMES
from lakestar.sources import landing, lines
from lakestar.sources.files import Files
from lakestar.sources.publish import Warehouse, added_ddl, column, ddl, text_literal
from lakestar.sources.table import VersionedTable, upsert

COMPLETE = "ingestion_run_complete"
COUNTERS = ("articles_discovered", *OUTCOMES)
RUN = "run_id string, publisher string, finished_at timestamp, ingest_exit_code int, status string, " + ", ".join(f"{c} long" for c in COUNTERS) + ", pushed_at timestamp"


@dataclass(frozen=True)
class Pushed:
    runs: int
    status_rows: int
    journal_rows: int


def run_row(spark: SparkSession, path: str | None, publisher: str, exit_code: int | None, now: str) -> DataFrame:
    """The row of one run's log: its last completion event, or an incomplete run named after the log's folder."""
    stamp = F.lit(now).cast("timestamp")
    log, ended = spark.createDataFrame([], "place int, value string"), stamp
    files = Files(spark, path) if path else None
    if files and files.exists(path):
        log = lines.read_lines(spark, path)
        # The last write is the closest record of when an incomplete run ended.
        ended = F.timestamp_millis(F.lit(files.modified(path)).cast("long"))
    event = landing.last_event(log, COMPLETE, "event string, run_id string, timestamp string, " + ", ".join(f"{c} long" for c in COUNTERS), "place")
    folder = path.rstrip("/").split("/")[-2] if path and "/" in path.rstrip("/") else "unknown"
    one = spark.range(1).join(event, how="left")
    done = F.col("event").isNotNull()
    return one.select(
        F.when(done, F.coalesce("run_id", F.raise_error(F.lit("a completion event without run_id")))).otherwise(F.lit(f"incomplete-{folder}")).alias("run_id"), F.lit(publisher).alias("publisher"),
        F.when(done, F.coalesce(F.col("timestamp").try_cast("timestamp"), stamp)).otherwise(ended).alias("finished_at"), F.lit(exit_code).cast("int").alias("ingest_exit_code"), F.when(done, "complete").otherwise("incomplete").alias("status"),
        *COUNTERS, stamp.alias("pushed_at"),
    )


def status_snapshot(manifest: DataFrame, now: str) -> DataFrame:
    """publisher, url_type, status with row count and oldest and newest last_seen_at."""
    found = manifest.groupBy("publisher", "url_type", "status").agg(F.count("*").alias("row_count"), F.min("last_seen_at").alias("oldest_last_seen_at"), F.max("last_seen_at").alias("newest_last_seen_at"))
    return found.withColumn("snapshot_at", F.lit(now).cast("timestamp"))


def journal_snapshot(manifest: DataFrame, now: str) -> DataFrame:
    """The manifest's journal rows."""
    return manifest.where("url_type = 'journal'").select("publisher", F.col("normalised_url").alias("journal_url"), "status", "last_seen_at", "last_changed_at", "last_http_status", "fetch_count", "last_run_id", F.lit(now).cast("timestamp").alias("snapshot_at"))


def push(tables: dict[str, VersionedTable], manifest: DataFrame, publisher: str, now: str, run: DataFrame | None = None) -> Pushed:
    """Upserts a run and replaces the publisher's snapshots. ``tables``: runs, status, journals."""
    mine = manifest.where(F.col("publisher") == publisher)
    status, journals = status_snapshot(mine, now), journal_snapshot(mine, now)
    quoted = publisher.replace("'", "''")
    if run is not None:
        changed = " or ".join(f"not (target.{c} <=> source.{c})" for c in run.columns if c != "run_id")
        tables["runs"].create(RUN).merge(run, ["run_id"], upsert(changed))
    for name, rows in (("status", status), ("journals", journals)):
        tables[name].create(rows.schema, ("publisher",)).replace_where(rows, f"publisher = '{quoted}'")
    count = lambda name: tables[name].read().where(F.col("publisher") == publisher).count()
    return Pushed(0 if run is None else 1, count("status"), count("journals"))


#: Keys of the health tables in a warehouse.
KEYS = {"scrape_runs": ["run_id"], "scrape_status": ["publisher", "url_type", "status"], "scrape_journals": ["publisher", "journal_url"]}


def push_warehouse(warehouse: Warehouse, manifest: DataFrame, publisher: str, now: str, run: DataFrame | None = None) -> Pushed:
    """Upserts a run and replaces the publisher's snapshots in a database, all three tables in one transaction.

    Rows are staged by the executors first. Inside the transaction the tables are locked against other pushes, made if
    absent, and get the columns (counters, say) that this push has and they lack; if anything fails nothing has happened.
    """
    mine = manifest.where(F.col("publisher") == publisher)
    rows = {"scrape_status": status_snapshot(mine, now), "scrape_journals": journal_snapshot(mine, now)}
    # Of a run that is pushed again the new row stays, of other publishers' snapshots all.
    old = dict.fromkeys(rows, f"{column('publisher')} = {text_literal(publisher)}")
    if run is not None:
        rows, old = {"scrape_runs": run} | rows, old | {"scrape_runs": f"{column('run_id')} IN (SELECT {column('run_id')} FROM stage_scrape_runs)"}
    values = {name: warehouse.stage(df, name, KEYS[name] if name == "scrape_runs" else []) for name, df in rows.items()}
    statements = []
    for name, df in rows.items():
        there = warehouse.columns(name) if warehouse.has(name) else None
        statements += [ddl(name, df.schema, KEYS[name])] if there is None else added_ddl(name, df.schema, there)
        statements.append(f"LOCK TABLE {name} IN EXCLUSIVE MODE")
    for name, df in rows.items():
        statements.append(f"DELETE FROM {name} WHERE {old[name]}")
        statements.append(f"INSERT INTO {name} ({', '.join(map(column, df.columns))}) SELECT {values[name]} FROM stage_{name}")
    with warehouse.transaction() as t:
        for sql in statements:
            t.execute(sql)
        counts = {name: t.value(f"SELECT COUNT(*) FROM stage_{name}") for name in rows}
    return Pushed(counts.get("scrape_runs", 0), counts["scrape_status"], counts["scrape_journals"])
