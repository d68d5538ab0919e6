"""Command line: ``python -m lakestar <command> --root <lake> [--publisher <name>]``.

init creates the lake's folders; ingest applies the gates to fetched pages (``--listing`` and ``--records``, JSON Lines) and
lands new records; land mirrors local files to the lake and leaves a marker; push-health records a run and the manifest's
health; producer does these three in a row. bronze, silver and gold build the layers, publish puts gold into a warehouse,
export writes a JSON document per journal, maintenance compacts and vacuums, smoke tries a table's writes and time travel.

Exit codes: 0 done, 1 failed, 2 refused; of producer: 5 another one runs, 3 no storage, 1 ingest, 2 land, 4 push failed.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakestar.plans import gold, ingest, lakehouse
from lakestar.session import build_session
from lakestar.sources import health, landing, lines, publish
from lakestar.sources.files import Files
from lakestar.sources.lock import LockHeld, lock
from lakestar.sources.table import VersionedTable

COMMANDS = ("init", "ingest", "land", "push-health", "producer", "bronze", "silver", "gold", "publish", "export", "maintenance", "smoke")
FOLDERS = ("landing", "bronze", "silver", "gold", "out")
QUERIES = {
    "articles by journal and class": "select j.journal_title, t.content_class, count(*) as n from fact_article f join dim_journal v on f.journal_sk = v.journal_sk join dim_journal j on j.publisher = v.publisher and j.journal_url = v.journal_url and j.is_current join dim_article_type t using (article_type_sk) group by all order by 1, 3 desc, 2",
    "scholarly articles by month": "select d.year, d.month, count(*) as n from fact_article f join dim_article_type t using (article_type_sk) join dim_date d on d.date_sk = f.pub_month_date_sk where t.is_scholarly group by all order by 1, 2",
    "top authors": "select a.display_name, round(sum(b.weight), 2) as weighted from bridge_article_author b join dim_author a using (author_sk) join fact_article f using (article_sk) join dim_article_type t using (article_type_sk) where t.is_scholarly and b.role = 'author' group by all order by 2 desc, 1 limit 10",
    "licence share": "select j.journal_title, round(100.0 * count(*) filter (where f.has_cc_license) / count(*), 2) as share from fact_article f join dim_journal v on f.journal_sk = v.journal_sk join dim_journal j on j.publisher = v.publisher and j.journal_url = v.journal_url and j.is_current group by all order by 2 desc, 1",
}


def smoke(spark: SparkSession, root: str) -> None:
    """Overwrite, append and time travel on a table of its own."""
    table = VersionedTable(spark, f"{root}/_smoke").create("id long")
    first = table.overwrite(spark.range(3))
    table.append(spark.range(2))
    if (table.read().count(), table.read(version=first).count()) != (5, 3):
        raise RuntimeError("the table doesn't hold what was written")
    table.files.delete(f"{root}/_smoke")


class Lake:
    """The tables of one root."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args, self.now = spark, args, datetime.now(timezone.utc).isoformat()
        self.gold = {n: self.table(f"gold/{n}") for n in gold.TABLES}

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.args.root}/{name}")

    def init(self) -> None:
        files = Files(self.spark, self.args.root)
        for name in FOLDERS:
            files.make(f"{self.args.root}/{name}")
        print(f"{self.args.root} ready")

    def ingest(self) -> None:
        a = self.args
        listing = self.spark.read.schema("url_hash string, normalised_url string, url_type string, ordinal long, doi string, payload_hash string, http_status int, result string").json(a.listing)
        records = self.spark.read.schema(lakehouse.LANDED + ", ordinal long").json(a.records)
        if a.limit is not None:
            print("coverage is truncated by --limit", file=sys.stderr)
        ingest.run_ingestion(listing, records, self.table("manifest"), a.local or f"{a.root}/local", a.publisher, a.run_id or f"run-{self.now}", self.now, a.refresh_days, a.force, a.limit).show(truncate=False)

    def land(self) -> None:
        counts, marker = landing.land(self.spark, self.args.local or f"{self.args.root}/local", f"{self.args.root}/landing", self.args.publisher, self.now)
        print(counts, marker or "no marker: nothing new")

    def push_health(self) -> None:
        a = self.args
        run = health.run_row(self.spark, a.run_log, a.publisher, a.exit_code, self.now) if a.run_log else None
        if a.warehouse:
            print(health.push_warehouse(publish.Warehouse(self.spark, a.warehouse), self.table("manifest").create(ingest.MANIFEST).read(), a.publisher, self.now, run))
            return
        print(health.push({n: self.table(f"ops/{n}") for n in ("runs", "status", "journals")}, self.table("manifest").create(ingest.MANIFEST).read(), a.publisher, self.now, run))

    def producer(self) -> int:
        if not Files(self.spark, self.args.root).exists(self.args.root):
            return 3
        try:
            with lock(self.spark, f"{self.args.root}/_producer.lock", "producer"):
                failed = {}
                for code, step in ((1, self.ingest), (2, self.land), (4, self.push_health)):
                    try:
                        step()
                    except Exception as e:
                        failed[code] = e
                        print(f"{step.__name__}: {e}", file=sys.stderr)
                return next(iter(failed), 0)
        except LockHeld as e:
            print(e, file=sys.stderr)
            return 5

    def bronze(self) -> None:
        print(lakehouse.load_bronze(self.spark, self.args.landing or f"{self.args.root}/landing/{self.args.publisher}", self.table("bronze"), self.args.publisher, self.now))

    def silver(self) -> None:
        print(lakehouse.build_silver(self.table("bronze"), self.table("silver"), self.table("quarantine"), self.table("dq_results"), self.now, self.now))
        if self.args.sample:
            self.table("silver").read().orderBy(F.desc("last_changed_at"), "url_hash").select("publisher", "url_hash", "english_title", "doi", "dq_flags").show(self.args.sample, truncate=60)

    def build_gold(self) -> None:
        for name, done in gold.build_gold(self.spark, self.table("silver").read(), self.gold).items():
            print(name, done)
        if self.args.queries:
            for name, table in self.gold.items():
                table.read().createOrReplaceTempView(name)
            for title, sql in QUERIES.items():
                print(title)
                self.spark.sql(sql).show(truncate=False)

    def publish(self) -> None:
        keys = {n: [k] for n, k in gold.KEYS.items()} | {"bridge_article_author": gold.BRIDGE_KEY}
        foreign = {n: {c: (d, gold.KEYS[d]) for c, d in fks.items()} for n, fks in gold.FOREIGN_KEYS.items()}
        print(publish.publish_logged(publish.Warehouse(self.spark, self.args.warehouse), self.gold, keys, self.table("publish_log"), self.args.force, self.args.dry_run, foreign))

    def export(self) -> None:
        rows = self.spark.read.schema(lakehouse.LANDED).json(f"{self.args.root}/landing/{self.args.publisher}")
        rows = rows.withColumns({"ingest_date": F.regexp_extract(F.col("_metadata.file_path"), r"ingest_date=([^/]+)", 1), "line_no": lines.place()})
        content = ("url_hash", "ingest_date", "run_id", "line_no", *lakehouse.TEXT_COLUMNS, *lakehouse.ROLE_COLUMNS)
        if self.args.journal_url:
            rows = rows.where(F.col("journal_url") == self.args.journal_url)
        done = landing.export_journals(rows.select(*content), self.table("manifest").read(), f"{self.args.root}/out/{self.args.publisher}")
        print(done.count(), "journals,", done.agg(F.sum("articles")).first()[0] or 0, "articles")

    def maintenance(self) -> int:
        hours = self.args.vacuum_hours
        if hours is not None and hours < 168:
            print("refused: files are kept for 168 hours at least", file=sys.stderr)
            return 2
        for t in (*(self.table(n) for n in ("bronze", "silver", "quarantine", "dq_results")), *self.gold.values()):
            if t.exists():
                print(t.root, t.detail() if self.args.dry_run else {"compacted": t.optimize(), "deleted": t.vacuum(hours) if hours else 0})
        return 0

    def smoke(self) -> None:
        smoke(self.spark, self.args.root)
        print("smoke ok")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lakestar", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--root", required=True)
    for name in ("publisher", "landing", "local", "listing", "records", "run-id", "run-log", "journal-url", "warehouse"):
        parser.add_argument(f"--{name}")
    for name, kind, default in (("limit", int, None), ("refresh-days", int, 90), ("exit-code", int, None), ("sample", int, 0), ("vacuum-hours", float, None)):
        parser.add_argument(f"--{name}", type=kind, default=default)
    for name in ("dry-run", "force", "queries"):
        parser.add_argument(f"--{name}", action="store_true")
    args = parser.parse_args(argv)
    needs = {"ingest": ("publisher", "listing", "records"), "producer": ("publisher", "listing", "records"), "land": ("publisher",), "push-health": ("publisher",), "bronze": ("publisher",), "export": ("publisher",), "publish": ("warehouse",)}
    lacking = [n for n in needs.get(args.command, ()) if not getattr(args, n)]
    if lacking or (args.limit is not None and args.limit < 1):
        parser.error(f"{args.command} needs --{', --'.join(lacking)}" if lacking else "--limit is 1 at least")
    lake = Lake(build_session(f"lakestar-{args.command}"), args)
    step = {"push-health": lake.push_health, "gold": lake.build_gold}.get(args.command) or getattr(lake, args.command)
    try:
        return step() or 0
    except Exception as e:
        print(f"{args.command}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
