"""Joins, windows and key checks that the dataflows are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order`` (ties must be broken by it); Spark limits groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_with(df: DataFrame, keys: list[str], order: list[str], stats: dict[str, Column]) -> DataFrame:
    """The row of each key that is last in ``order`` (nulls first; ties must be broken by it), with aggregates over all of the key's rows.

    One shuffle, after partial aggregation: a hot key's rows are reduced where they are read.
    """
    rest = [c for c in df.columns if c not in keys]
    found = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_latest"), *(c.alias(name) for name, c in stats.items()))
    return found.select(*keys, "_latest.*", *stats)


def with_history(df: DataFrame, keys: list[str], ts: str, order: list[str]) -> DataFrame:
    """The latest row of each key with first_seen_at and version_count over all of its rows."""
    return latest_with(df, keys, order, {"first_seen_at": F.min(ts), "version_count": F.count("*")})


def already_present(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    return batch.join(target.select(*keys), keys, "left_semi")


def not_present(batch: DataFrame, *targets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in none of the targets."""
    for target in targets:
        batch = batch.join(target.select(*keys), keys, "left_anti")
    return batch


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, foreign: str, key: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    return child.where(F.col(foreign).isNotNull()).join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")


def asof_join(facts: DataFrame, versions: DataFrame, keys: list[str], ts: str, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Left join of each fact to the version valid at ``ts``, ranges being half open.

    An equi-join on the keys with the range as residual: Spark picks broadcast or sort-merge by size, and splits skewed keys.
    """
    v = versions.withColumnsRenamed({k: f"_v_{k}" for k in keys})
    on = [F.col(k) == F.col(f"_v_{k}") for k in keys] + [F.col(ts) >= F.col(start), F.col(ts) < F.col(end)]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return facts.join(v, condition, "left").drop(*(f"_v_{k}" for k in keys))


def asof_scan(facts: DataFrame, versions: DataFrame, keys: list[str], ts: str, start: str = "effective_from", end: str = "effective_to", every: str = "day") -> DataFrame:
    """As ``asof_join``, for versions that don't overlap: linear in facts and versions, however many a key has.

    Facts and versions of a key are put in time order ``every`` day (or month, ...) by itself, so a hot key is as many
    groups as it has days; the last version before a day comes from one row per key and day. Facts with a null key or
    time have no version.
    """
    kept = [c for c in versions.columns if c not in keys]
    bucket = lambda c: F.date_trunc(every, F.col(c))
    v = versions.select(*keys, F.struct(*kept).alias("_v"), F.col(start).alias("_at"), bucket(start).alias("_b"))
    last = v.groupBy(*keys, "_b").agg(F.max_by("_v", F.struct("_at", f"_v.{end}")).alias("_last"))
    # Days of facts take their turn among the days that have versions; each gets what the days before it leave.
    days = facts.select(*keys, bucket(ts).alias("_b"), F.lit(None).cast(last.schema["_last"].dataType).alias("_last")).distinct()
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    carried = last.union(days).groupBy(*keys, "_b").agg(F.first("_last", ignorenulls=True).alias("_last")).withColumn("_before", before).drop("_last")
    own = [c for c in facts.columns if c not in keys]
    rows = facts.select(*keys, F.struct(*own).alias("_f"), F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), F.col(ts).alias("_at"), bucket(ts).alias("_b"))
    both = rows.union(v.select(*keys, F.lit(None).cast(rows.schema["_f"].dataType).alias("_f"), "_v", "_at", "_b"))
    order = Window.partitionBy(*keys, "_b").orderBy("_at", F.col("_f").isNotNull(), f"_v.{end}")
    found = both.withColumn("_here", F.last("_v", ignorenulls=True).over(order)).where("_f is not null")
    same = [found[k].eqNullSafe(carried[k]) for k in (*keys, "_b")]
    joined = found.join(carried, same, "left").select(*(found[k] for k in keys), "_f", F.coalesce("_here", "_before").alias("_v"))
    valid = F.when(F.col(f"_f.{ts}") < F.col(f"_v.{end}"), F.col("_v"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    joined = joined.withColumn("_v", F.when(known, valid))
    return joined.select(*(F.col(k) if k in keys else F.col(f"_f.{k}") for k in facts.columns), *(F.col(f"_v.{c}").alias(c) for c in kept))


def overlaps(versions: DataFrame, keys: list[str], start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Versions that begin before the one before them ends."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    return versions.withColumn("_before", F.lag(end).over(w)).where(F.col(start) < F.col("_before")).drop("_before")


def first_arrival(df: DataFrame, keys: list[str], ordinal: str) -> Column:
    """Whether a row is the first of its key by an explicit ordinal."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(ordinal)) == 1


def lookup(facts: DataFrame, dim: DataFrame, foreign: str, natural: str, surrogate: str, unknown: int = -1) -> DataFrame:
    """Adds the surrogate key of a dimension row, or the unknown member's."""
    found = dim.select(F.col(natural).alias(foreign), F.col(surrogate).alias("_sk"))
    return facts.join(found, foreign, "left").withColumn(surrogate, F.coalesce("_sk", F.lit(unknown))).drop("_sk")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` in as many partitions as a shuffle has, or the cluster cores if those are more.

    For steps that take long for each byte: a small file is one split, and what is done to its rows one task's work.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)
