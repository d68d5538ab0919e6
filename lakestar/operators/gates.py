"""Ingestion gates: duplicate identities, refresh policy, unchanged payloads, and the manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.operators.relational import first_arrival

OUTCOMES = ("dup_in_run_url", "skipped_manifest", "fetch_failed", "blocked_gave_up", "parse_failed", "dup_in_run_doi", "unchanged_payload", "bronze_written")


def refresh(status: Column, last_seen: Column, now: Column, refresh_days: Column | int, force: Column | bool = False) -> Column:
    """struct(fetch, reason) for a manifest row (null status: unknown url).

    Exactly ``refresh_days`` old is stale, by whole seconds of the clock; 0 days is always fetched; anything that didn't end well is retried.
    """
    days = F.lit(refresh_days) if isinstance(refresh_days, int) else refresh_days
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(last_seen.cast("timestamp"))
    reason = (
        F.when(F.lit(force) if isinstance(force, bool) else force, "force_refetch").when(status.isNull(), "new_url").when(status == "blocked", "retry_blocked")
        .when(status != "ok", F.concat(F.lit("retry_"), status)).when(days == 0, "always_fetch").when(age >= days * 86400, "stale").otherwise("skipped_manifest")
    )
    return F.struct((reason != "skipped_manifest").alias("fetch"), reason.alias("reason"))


def outcomes(listing: DataFrame, manifest: DataFrame, now: Column, refresh_days: int, force: bool = False) -> DataFrame:
    """Adds ``outcome``, one of OUTCOMES, to listing rows (url_hash, ordinal, doi, payload_hash, result).

    ``result`` is what the fetch and the parser gave: ok, failed, blocked or parse_error. Gates apply in order, and a
    row stopped by one gate doesn't count in the next.
    """
    known = manifest.select("url_hash", F.col("status").alias("_status"), F.col("last_seen_at").alias("_seen"), F.col("payload_hash").alias("_payload"))
    rows = listing.join(known, "url_hash", "left").withColumn("_first", first_arrival(listing, ["url_hash"], "ordinal"))
    rows = built(rows, now, refresh_days, force)
    # The first arrival of each doi among the rows that were built, by partial aggregation: rows without one meet nowhere.
    first = rows.where("_built and doi is not null").groupBy("doi").agg(F.min("ordinal").alias("_least"))
    rows = rows.withColumn("_doi", F.when(F.col("_built"), F.col("doi"))).join(first.withColumnRenamed("doi", "_doi"), "_doi", "left").drop("_doi")
    return judged(rows, F.coalesce(F.col("ordinal") > F.col("_least"), F.lit(False))).drop("_least")


def built(rows: DataFrame, now: Column, refresh_days: int, force: bool = False) -> DataFrame:
    """Adds whether a row (with _first and the manifest's _status and _seen) is fetched, and whether its page was read."""
    rows = rows.withColumn("_fetch", refresh(F.col("_status"), F.col("_seen"), now, refresh_days, force)["fetch"])
    return rows.withColumn("_built", F.col("_first") & F.col("_fetch") & (F.col("result") == "ok"))


def judged(rows: DataFrame, again: Column) -> DataFrame:
    """Adds the outcome of ``built`` rows; ``again``: whether an earlier one had the row's doi."""
    outcome = (
        F.when(~F.col("_first"), "dup_in_run_url").when(~F.col("_fetch"), "skipped_manifest").when(F.col("result") == "failed", "fetch_failed").when(F.col("result") == "blocked", "blocked_gave_up")
        .when(F.col("result") == "parse_error", "parse_failed").when(again, "dup_in_run_doi").when(F.col("payload_hash").eqNullSafe(F.col("_payload")) & F.col("payload_hash").isNotNull(), "unchanged_payload").otherwise("bronze_written")
    )
    return rows.withColumn("outcome", outcome).drop("_status", "_seen", "_payload", "_first", "_fetch", "_built")


def counters(rows: DataFrame) -> DataFrame:
    """outcome, n of all buckets, those without rows too; they sum to the rows listed."""
    every = rows.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, OUTCOMES))).alias("outcome"))
    return every.join(rows.groupBy("outcome").agg(F.count("*").alias("n")), "outcome", "left").select("outcome", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


#: The manifest status that an outcome leaves; outcomes that aren't here write nothing.
STATUS = {"fetch_failed": "failed", "blocked_gave_up": "blocked", "parse_failed": "parse_error", "dup_in_run_doi": "ok", "unchanged_payload": "ok", "bronze_written": "ok"}


def manifest_rows(judged: DataFrame, manifest: DataFrame, publisher: str, run_id: str, now: Column) -> DataFrame:
    """Staged manifest rows of judged listing rows (url_hash, normalised_url, url_type, ordinal, doi, payload_hash, http_status, outcome).

    first_seen_at is the manifest's where it has the url; only what was written counts as changed, and a payload hash is
    only claimed by what is in bronze.
    """
    known = manifest.select("url_hash", F.col("first_seen_at").alias("_seen"))
    status = F.element_at(F.create_map(*(F.lit(x) for kv in STATUS.items() for x in kv)), F.col("outcome"))
    rows = judged.withColumn("status", status).where("status is not null").join(known, "url_hash", "left")
    ok = F.col("status") == "ok"
    return rows.select(
        "url_hash", "normalised_url", F.lit(publisher).alias("publisher"), "url_type", F.when(ok, F.col("doi")).alias("doi"), F.when(F.col("outcome").isin("bronze_written", "unchanged_payload"), F.col("payload_hash")).alias("payload_hash"),
        F.coalesce("_seen", now).alias("first_seen_at"), now.alias("last_seen_at"), F.when(F.col("outcome") == "bronze_written", now).alias("last_changed_at"), F.lit(1).cast("long").alias("fetch_count"),
        F.col("http_status").alias("last_http_status"), F.lit(run_id).alias("last_run_id"), "status", "ordinal",
    )


def commit_batch(flush_bronze: Callable[[], None], claim: Callable[[], None]) -> None:
    """Bronze first, the manifest's claim only after: a crash between them leaves rows to fetch again, and loses none."""
    flush_bronze()
    claim()


def balance(counted: DataFrame, discovered: int) -> None:
    """Raises unless the outcome buckets (outcome, n) sum to the rows discovered."""
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total != discovered:
        raise RuntimeError(f"outcomes sum to {total}, not {discovered}")


def manifest_upsert(manifest: DataFrame, staged: DataFrame) -> DataFrame:
    """The manifest after a batch: staged values win, doi, payload hash and change time only if not null; counts add up; first_seen_at stays."""
    last = Window.partitionBy("url_hash").orderBy(F.desc("ordinal"))
    staged = staged.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn", "ordinal")
    old = manifest.select(*(F.col(c).alias(f"_o_{c}") for c in manifest.columns))
    joined = staged.join(old, F.col("url_hash") == F.col("_o_url_hash"), "full_outer")
    keep, add, first = ("doi", "payload_hash", "last_changed_at"), ("fetch_count",), ("first_seen_at",)
    is_staged = F.col("url_hash").isNotNull()

    def column(c: str) -> Column:
        if c in keep or c == "url_hash":
            out = F.coalesce(c, f"_o_{c}")
        elif c in add:
            out = F.coalesce(c, F.lit(0)) + F.coalesce(f"_o_{c}", F.lit(0))
        elif c in first:
            out = F.coalesce(f"_o_{c}", c)
        else:
            out = F.when(is_staged, F.col(c)).otherwise(F.col(f"_o_{c}"))
        return out.alias(c)

    return joined.select(*(column(c) for c in manifest.columns))
