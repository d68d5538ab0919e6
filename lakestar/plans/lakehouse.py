"""The article lakehouse as one example domain: bronze, silver and gold of a publisher's records.

Everything is built from the generic operators; only names and rules stand here. Each build validates before it writes
and checks its balance after.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.functions import dates, hashing, text
from lakestar.operators import quality, relational
from lakestar.plans.gold import TABLES, build_gold, check_gold  # noqa: F401
from lakestar.sources import landing
from lakestar.sources.table import MergeResult, VersionedTable, insert_only, self_healing

_CONTACT = "array<struct<name:string,affiliation:string,email:string>>"
_RUNS = "array<struct<text:string,bold:boolean,italic:boolean,superscript:boolean,subscript:boolean>>"
#: The landed record's columns.
TEXT_COLUMNS = (
    "journal_title", "journal_url", "volume", "issue", "issue_url", "issue_publication_month", "issue_publication_day", "issue_publication_year", "article_url", "article_publication_month",
    "article_publication_day", "article_publication_year", "start_page", "last_page", "article_id", "english_title", "foreign_title", "doi", "english_abstract", "non_english_abstract",
    "article_type", "author_keyword", "reference_count", "copyright_year", "license_type", "funding_status",
)
ROLE_COLUMNS = ("authors", "editors", "corporate_authors")
RICH_COLUMNS = ("english_title_rich", "foreign_title_rich", "english_abstract_rich", "non_english_abstract_rich")
PROVENANCE = ("run_id", "scraped_at", "publisher", "url_hash", "source_url", "payload_hash")
LANDED = ", ".join([f"{c} string" for c in TEXT_COLUMNS] + [f"{c} {_CONTACT}" for c in ROLE_COLUMNS] + [f"{c} {_RUNS}" for c in RICH_COLUMNS] + [f"{c} string" for c in PROVENANCE])
BRONZE = LANDED.replace("scraped_at string", "scraped_at timestamp") + ", ingest_date date, raw_html_key string, _source_file string, _loaded_at timestamp"
BRONZE_KEY = ["publisher", "url_hash", "run_id"]
SILVER_KEY = ["publisher", "url_hash"]

RULES = [
    quality.Rule("missing_article_url", "article_url is null", "quarantine"), quality.Rule("missing_journal_url", "journal_url is null", "quarantine"),
    quality.Rule("missing_title", "english_title is null and foreign_title is null", "quarantine"), quality.Rule("missing_doi", "doi is null"),
    quality.Rule("invalid_doi", "doi is not null and not doi_valid"), quality.Rule("no_authors", "author_count = 0"),
    quality.Rule("missing_abstract", "english_abstract is null and non_english_abstract is null"), quality.Rule("unparsed_pub_month", "article_pub.unparsed or issue_pub.unparsed"),
    quality.Rule("month_range", "article_pub.is_range or issue_pub.is_range"), quality.Rule("bad_reference_count", "raw_reference_count is not null and reference_count is null"),
    quality.Rule("bad_copyright_year", "raw_copyright_year is not null and copyright_year is null"), quality.Rule("bad_page_range", "try_cast(last_page as int) < try_cast(start_page as int)"),
]


@dataclass(frozen=True)
class SilverResult:
    rows: int
    quarantined: int
    merge: MergeResult


def load_bronze(spark: SparkSession, landing_path: str, table: VersionedTable, publisher: str, loaded_at: str, blobs: str | None = None) -> MergeResult:
    """Landed files into the append-only bronze table; records that are there already change nothing.

    ``blobs``: the folder of raw pages; records whose page isn't there are loaded, with a warning that tells how many.
    """
    if "/" in publisher or "\\" in publisher:
        raise ValueError("a publisher has no slashes")
    rows = landing.scan_jsonl(spark, landing_path, LANDED)
    n = landing.check_batch(rows, BRONZE_KEY, "scraped_at", publisher)
    stamp = F.lit(loaded_at).cast("timestamp")
    scraped = F.col("scraped_at").cast("timestamp")
    rows = rows.withColumns({"scraped_at": scraped, "raw_html_key": F.concat_ws("/", F.lit("raw_html"), "publisher", F.date_format(scraped, "yyyy-MM-dd"), F.concat("url_hash", F.lit(".html.gz"))), "_source_file": F.col("source_file"), "_loaded_at": stamp})
    if blobs is not None:
        lacking = landing.missing_blobs(rows.select("url_hash"), spark, blobs, F.concat("url_hash", F.lit(".html.gz"))).count()
        if lacking:
            warnings.warn(f"{lacking} records without a raw page", stacklevel=2)
    table.create(BRONZE, ("publisher", "ingest_date"), {"appendOnly": "true"})
    before = table.read().count()
    present = relational.already_present(rows, table.read(), BRONZE_KEY).count()
    done = table.merge(rows, BRONZE_KEY, insert_only())
    if done.inserted + present != n or table.read().count() != before + done.inserted:
        raise RuntimeError("bronze rows don't balance")
    if not done.skipped and table.read(version=done.version - 1).count() != before:
        raise RuntimeError("the version before doesn't hold the rows it held")
    return done


def candidates(bronze: DataFrame, run_year: int) -> DataFrame:
    """Typed and cleaned rows with quality columns, one per bronze version."""
    c = F.col
    plain = {n: text.clean(c(n)) for n in ("article_url", "source_url", "journal_url", "journal_title", "issue_url", "volume", "issue", "article_type", "start_page", "last_page", "payload_hash", "raw_html_key")}
    folded = {n: text.clean(c(n), collapse=True) for n in ("english_title", "foreign_title", "english_abstract", "non_english_abstract")}
    doi, valid = text.identifier(c("doi"))
    people = {r: text.contacts(c(r)) for r in ROLE_COLUMNS}
    rows = bronze.select(
        "publisher", "url_hash", "run_id", "scraped_at", "ingest_date", *(e.alias(n) for n, e in (plain | folded | people).items()),
        text.whole_number(text.clean(c("volume"))).alias("volume_num"), text.whole_number(text.clean(c("issue"))).alias("issue_num"), doi.alias("doi"), valid.alias("doi_valid"),
        text.slug(c("article_type")).alias("article_type_key"), text.tokens(c("author_keyword")).alias("keywords"),
        text.clean(c("reference_count")).alias("raw_reference_count"), text.integer(c("reference_count")).alias("reference_count"),
        text.clean(c("copyright_year")).alias("raw_copyright_year"), text.number_between(c("copyright_year"), 1900, run_year + 1).alias("copyright_year"),
        text.page_count(c("start_page"), c("last_page")).alias("page_count"), text.clean(c("license_type")).alias("license_url"), text.licence(c("license_type")).alias("license_code"),
        text.clean(c("funding_status")).alias("funding_statement"),
        *(dates.publication(c(f"{p}_publication_year"), c(f"{p}_publication_month"), c(f"{p}_publication_day")).alias(f"{p}_pub") for p in ("article", "issue")),
    )
    rows = rows.withColumns({"author_count": F.size("authors"), "has_cc_license": F.col("license_code").isNotNull()})
    return quality.apply(rows, RULES)


def build_silver(bronze: VersionedTable, silver: VersionedTable, quarantine: VersionedTable, dq: VersionedTable, run_id: str, now: str) -> SilverResult:
    """The current valid version of each record, the rows that failed a hard rule, and the counts of all rules."""
    versions = candidates(bronze.read(), int(now[:4])).persist()
    try:
        stats = versions.groupBy(*SILVER_KEY).agg(F.min("scraped_at").alias("first_seen_at"), F.count("*").cast("int").alias("version_count"))
        passing = versions.where(F.size("dq_reasons") == 0)
        latest = relational.latest_per_key(passing, SILVER_KEY, [F.desc("scraped_at"), F.desc("run_id")]).join(stats, SILVER_KEY)
        pub = [F.col(f"{p}_pub.{f}").alias(f"{p}_{'date_' if f == 'precision' else 'pub_'}{f}") for p in ("article", "issue") for f in ("year", "month", "day", "month_start", "precision")]
        drop = ("article_pub", "issue_pub", "raw_reference_count", "raw_copyright_year", "dq_reasons")
        rows = latest.select("*", *pub).drop(*drop).withColumnsRenamed({"scraped_at": "last_changed_at", "run_id": "latest_run_id"})
        business = rows.columns
        rows = rows.withColumn("_row_hash", hashing.row_hash(*business)).withColumn("_silver_updated_at", F.lit(now).cast("timestamp"))
        failed = versions.where(F.size("dq_reasons") > 0).select("publisher", "url_hash", "run_id", "article_url", "journal_url", "scraped_at", "ingest_date", "dq_reasons", F.lit(now).cast("timestamp").alias("quarantined_at"))
        done = silver.create(rows.schema, ("publisher",)).merge(rows, SILVER_KEY, self_healing(business))
        held = quarantine.create(failed.schema, ("publisher",)).merge(failed, BRONZE_KEY, insert_only())
        hard = quality.rule_counts(versions, [r for r in RULES if r.severity == "quarantine"])
        soft = quality.rule_counts(latest, [r for r in RULES if r.severity == "flag"])
        events = hard.union(soft).select(F.lit(run_id).alias("dq_run_id"), "rule", "severity", "failed", "total", F.lit(now).cast("timestamp").alias("run_at"))
        dq.create(events.schema, properties={"appendOnly": "true"}).append(events, files=1)
        after = silver.read()
        n, keys = after.count(), passing.select(*SILVER_KEY).distinct().count()
        if n != keys:
            raise RuntimeError(f"silver has {n} rows for {keys} valid keys")
        if not after.where(~F.col("_row_hash").eqNullSafe(hashing.row_hash(*business))).isEmpty():
            raise RuntimeError("silver has rows with a stale hash")
        uncovered = relational.not_present(versions, silver.read(), keys=SILVER_KEY)
        if not relational.not_present(uncovered, quarantine.read(), keys=BRONZE_KEY).isEmpty():
            raise RuntimeError("bronze rows in neither silver nor quarantine")
        return SilverResult(n, held.inserted, done)
    finally:
        versions.unpersist()
