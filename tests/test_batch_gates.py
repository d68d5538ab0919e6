"""Landed batches are counted and checked in one pass, and say which rows are bad, the same ones each time."""

import pytest
from pyspark.sql import functions as F

from lakestar.sources import landing


def batch(spark, n=200, bad=()):
    rows = [(f"h{i:04d}", "p", "2026-01-01T00:00:00Z", "2026-01-01") for i in range(n)]
    for i, change in bad:
        rows[i] = tuple(change.get(k, v) for k, v in zip(("url_hash", "publisher", "scraped_at", "day"), rows[i], strict=True))
    df = spark.createDataFrame(rows, "url_hash string, publisher string, scraped_at string, day string")
    return df.withColumn("ingest_date", F.col("day").try_cast("date")).drop("day").repartition(7)


def test_a_good_batch_is_counted(spark):
    assert landing.check_batch(batch(spark), ["url_hash"], "scraped_at", "p") == 200
    with pytest.raises(FileNotFoundError):
        landing.check_batch(batch(spark).limit(0), ["url_hash"], "scraped_at", "p")


def test_bad_rows_are_told_with_the_least_samples(spark):
    bad = [(i, {"scraped_at": "soon"}) for i in range(150, 30, -3)] + [(7, {"publisher": None}), (8, {"publisher": "q"}), (9, {"url_hash": "  "}), (10, {"day": "never"})]
    told = []
    for parts in (1, 5):
        with pytest.raises(ValueError) as e:
            landing.check_batch(batch(spark, bad=bad).repartition(parts), ["url_hash"], "scraped_at", "p")
        told.append(str(e.value))
    assert told[0] == told[1]
    assert "scraped_at: 40, such as" in told[0] and told[0].count('"scraped_at":"soon"') == 5 and '"url_hash":"h0033"' in told[0] and "h0150" not in told[0]
    assert "publisher: 2" in told[0] and "empty key: 1" in told[0] and "ingest_date: 1" in told[0] and '"publisher":null' in told[0]


def test_samples_are_bounded_and_rows_may_break_several_rules(spark):
    df = spark.range(10_000).repartition(9)
    found = {r.rule: (r.n, r.samples) for r in landing.violations(df, {"even": F.col("id") % 2 == 0, "all": F.lit(True), "none": F.col("id") < 0, "null": F.lit(None).cast("boolean")}, ["id"], 3).collect()}
    least = lambda ids: sorted(f'{{"id":{i}}}' for i in ids)[:3]
    assert found == {"even": (5000, least(range(0, 10_000, 2))), "all": (10_000, least(range(10_000)))}
    one = spark.createDataFrame([(1,)] * 4, "id int")
    assert landing.violations(one, {"r": F.lit(True)}, ["id"], 3).first()[:] == ("r", 4, ['{"id":1}'] * 3)
    assert landing.violations(one.limit(0), {"r": F.lit(True)}, ["id"]).collect() == []


def test_keys_held_twice_are_the_least(spark):
    df = batch(spark, 20).unionByName(batch(spark, 9))
    with pytest.raises(ValueError, match="keys held twice.*h0000.*h0004") as e:
        landing.check_batch(df, ["url_hash"], "scraped_at", "p")
    assert "h0005" not in str(e.value)
