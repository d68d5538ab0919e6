"""Listings judged as a stream have the outcomes they have as a whole, however they are cut."""

import random

import pytest
from pyspark.sql import functions as F

from lakestar.operators import gates
from lakestar.streaming import gates as streamed

LISTING = "url_hash string, ordinal long, doi string, payload_hash string, http_status int, result string"


@pytest.fixture
def stateful(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streamed.PROVIDER)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def listing(n, seed=3):
    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(40) if i % 3 else 0}", i, rng.choice((None, "d0", f"d{rng.randrange(30)}")), rng.choice((None, "p0", f"p{i % 9}")), rng.choice((None, 200)), rng.choice(("ok", "ok", "ok", "failed", "blocked", "parse_error"))) for i in range(n)]
    manifest = [(f"u{i}", rng.choice(("ok", "failed")), "p0" if i % 2 else f"p{i % 9}", 30 * (i % 5)) for i in range(0, 40, 3)]
    return rows, manifest


def run(spark, rows, manifest, cuts, tmp_path):
    source = f"{tmp_path}/in"
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        mine = rows[a:b]
        random.Random(part).shuffle(mine)
        spark.createDataFrame(mine, LISTING).coalesce(1).write.mode("append").json(f"{source}/{part:03d}")
    stream = spark.readStream.schema(LISTING).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).json(source)
    found = streamed.outcomes(stream, manifest, F.lit("2026-06-01").cast("timestamp"), 60)
    found.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/out").trigger(availableNow=True).start().awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("ordinal", "url_hash", "doi", "http_status", "outcome").collect())


def test_any_cut_gives_the_outcomes_of_the_whole(stateful, tmp_path):
    spark = stateful
    rows, known = listing(160)
    manifest = spark.createDataFrame(known, "url_hash string, status string, payload_hash string, days int").select("url_hash", "status", "payload_hash", F.expr("timestamp '2026-06-01' - make_interval(0, 0, 0, days)").alias("last_seen_at"))
    whole = gates.outcomes(spark.createDataFrame(rows, LISTING), manifest, F.lit("2026-06-01").cast("timestamp"), 60)
    want = sorted(tuple(r) for r in whole.select("ordinal", "url_hash", "doi", "http_status", "outcome").collect())
    assert {r[-1] for r in want} >= {"dup_in_run_url", "skipped_manifest", "bronze_written", "fetch_failed"}
    assert run(spark, rows, manifest, [], tmp_path / "one") == want
    assert run(spark, rows, manifest, [1, 40, 41, 120], tmp_path / "five") == want


def test_dois_and_their_first_row_over_batches(stateful, tmp_path):
    spark = stateful
    rows = [("a", 1, "d", "p", 200, "failed"), ("b", 2, "d", "p", 200, "ok"), ("c", 3, "d", "p", 200, "ok"), ("b", 4, "d", "p", 200, "ok"), ("e", 5, None, "p", 200, "ok"), ("f", 6, None, "p", 200, "ok")]
    none = spark.createDataFrame([], "url_hash string, status string, payload_hash string, last_seen_at timestamp")
    got = run(spark, rows, none, [2, 3], tmp_path)
    assert [r[-1] for r in got] == ["fetch_failed", "bronze_written", "dup_in_run_doi", "dup_in_run_url", "bronze_written", "bronze_written"]
