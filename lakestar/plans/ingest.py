"""One ingestion run over pages that were fetched elsewhere: gates, landed records, manifest, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators import gates
from lakestar.sources import landing
from lakestar.sources.table import Clause, VersionedTable

MANIFEST = (
    "url_hash string, normalised_url string, publisher string, url_type string, doi string, payload_hash string, first_seen_at timestamp, last_seen_at timestamp, last_changed_at timestamp, "
    "fetch_count long, last_http_status int, last_run_id string, status string"
)
#: Columns that the gates and the manifest need beside the record's.
LISTING = ("url_hash", "normalised_url", "url_type", "ordinal", "doi", "payload_hash", "http_status", "result")


def upsert_manifest(manifest: VersionedTable, staged: DataFrame) -> None:
    """Staged values win; doi, payload hash and change time only if not null; counts add up; first_seen_at stays."""
    rows = landing.latest_lines(staged, "url_hash", ("ordinal",)).drop("ordinal")
    always = ("normalised_url", "publisher", "url_type", "last_seen_at", "last_http_status", "last_run_id", "status")
    values = {c: f"source.{c}" for c in always} | {c: f"coalesce(source.{c}, target.{c})" for c in ("doi", "payload_hash", "last_changed_at")} | {"fetch_count": "target.fetch_count + source.fetch_count"}
    manifest.create(MANIFEST).merge(rows, ["url_hash"], [Clause("update", "matched", "true", values), Clause("insert", "not_matched")])


def run_ingestion(listing: DataFrame, records: DataFrame, manifest: VersionedTable, landing_root: str, publisher: str, run_id: str, now: str, refresh_days: int = 90, force: bool = False, limit: int | None = None) -> DataFrame:
    """outcome, n of one run. ``listing``: LISTING columns; ``records``: landed columns by (url_hash, ordinal), for pages that were read.

    Bronze is written before the manifest claims it. The eight outcomes sum to the rows listed, or it raises.
    """
    if limit is not None:
        listing = listing.orderBy("ordinal").limit(limit)
    known = manifest.create(MANIFEST).read()
    stamp = F.lit(now).cast("timestamp")
    judged = gates.outcomes(listing.select(*LISTING), known, stamp, refresh_days, force).persist()
    try:
        counted = gates.counters(judged)
        gates.balance(counted, judged.count())
        written = judged.where("outcome = 'bronze_written'").select("url_hash", "ordinal")
        rows = records.join(written, ["url_hash", "ordinal"], "left_semi").drop("ordinal").withColumns({"run_id": F.lit(run_id), "scraped_at": F.lit(now), "publisher": F.lit(publisher), "ingest_date": F.date_format(stamp, "yyyy-MM-dd")})
        staged = gates.manifest_rows(judged, known, publisher, run_id, stamp)
        gates.commit_batch(lambda: landing.write_jsonl(rows, landing_root), lambda: upsert_manifest(manifest, staged))
        return listing.sparkSession.createDataFrame(counted.collect(), counted.schema)
    finally:
        judged.unpersist()
