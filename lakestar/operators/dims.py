"""Dimensional operators: date, type-1 and type-2 dimensions, role bridges, facts and star validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.functions.dates import HIGH_DATE, UNKNOWN_KEY
from lakestar.functions.text import name_key


def date_dim(spark: SparkSession, low: str = "2000-01-01", high: str = "2035-12-31") -> DataFrame:
    """One row per day and the unknown member -1."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"))).alias("date"))
    known = days.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_sk"), "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"), F.dayofmonth("date").alias("day"), F.dayofweek("date").alias("day_of_week"), F.weekofyear("date").alias("iso_week"), (F.dayofmonth("date") == 1).alias("is_month_start"),
    )
    return with_unknown(known, {"date_sk": UNKNOWN_KEY, "month_name": "Unknown", "is_month_start": False})


def with_unknown(dim: DataFrame, values: dict) -> DataFrame:
    """``dim`` and its unknown member; columns without a value are null."""
    return dim.unionByName(dim.sparkSession.range(1).select(*(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema)))


def scd2(df: DataFrame, keys: list[str], ts: str, attributes: list[str], order: list[Column] | None = None) -> DataFrame:
    """Versions (keys, attributes, effective_from, effective_to, is_current): runs of equal attributes, in time order."""
    w = Window.partitionBy(*keys).orderBy(*(order or [F.col(ts)]))
    changed = F.lit(False)
    for a in attributes:
        changed = changed | ~F.col(a).eqNullSafe(F.lag(a).over(w))
    # The place in time order is carried, so that changes at one time stamp end each other in the same order.
    starts = df.withColumns({"_new": changed | (F.row_number().over(w) == 1), "_place": F.row_number().over(w)}).where("_new").select(*keys, *attributes, F.col(ts).alias("effective_from"), "_place")
    after = F.lead("effective_from").over(Window.partitionBy(*keys).orderBy("_place"))
    return starts.withColumn("effective_to", after).drop("_place").withColumn("effective_to", F.coalesce("effective_to", F.lit(HIGH_DATE).cast("timestamp"))).withColumn("is_current", F.col("effective_to") == F.lit(HIGH_DATE).cast("timestamp"))


def scd2_changes(current: DataFrame, incoming: DataFrame, keys: list[str], attributes: list[str], ts: str, carried: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Staged rows of a type-2 merge: (match, keys, attributes, carried, effective_from).

    A changed key is staged twice: match=True ends its current version, match=False starts the next. A change that isn't
    later than the current version's start raises.
    """
    now = current.where("is_current").select(*(F.col(c).alias(f"_c_{c}") for c in (*keys, *attributes, "effective_from")))
    on = [F.col(k) == F.col(f"_c_{k}") for k in keys]
    joined = incoming.join(now, on, "left")
    is_new = F.col("_c_effective_from").isNull()
    changed = F.lit(False)
    for a in attributes:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"_c_{a}"))
    late = F.col(ts) <= F.col("_c_effective_from")
    start = F.when(late, F.raise_error(F.lit("change is not later than the current version")).cast("timestamp")).otherwise(F.col(ts))
    staged = joined.where(is_new | changed).withColumn("effective_from", start)
    sides = F.when(is_new, F.array(F.lit(False))).otherwise(F.array(F.lit(True), F.lit(False)))
    return staged.select(F.explode(sides).alias("match"), *keys, *attributes, *carried, "effective_from")


def explode_roles(df: DataFrame, keys: list[str], roles: dict[str, str], name: str = "name") -> DataFrame:
    """One row per (key, role, position from 1) of arrays of structs, with the normalised name and the role's size.

    Entries whose normalised name is empty go before positions and sizes are counted.
    """
    stacked = F.array(*(F.struct(F.lit(role).alias("role"), F.filter(F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)), lambda x: name_key(x[name]).isNotNull()).alias("entries")) for role, c in roles.items()))
    rows = df.select(*keys, F.explode(stacked).alias("r")).select(*keys, "r.role", F.size("r.entries").alias("role_count"), F.posexplode("r.entries").alias("pos", "entry"))
    return rows.select(*keys, "role", (F.col("pos") + 1).alias("position"), "role_count", name_key(F.col(f"entry.{name}")).alias("name_key"), "entry")


def bridge(roles: DataFrame) -> DataFrame:
    """Each row of a role explosion weighs 1 / role_count."""
    return roles.withColumn("weight", F.lit(1.0).cast("double") / F.col("role_count"))


def expected_rows(df: DataFrame, arrays: tuple[str, ...]) -> DataFrame:
    """One row: how many rows exploding these arrays must give."""
    return df.agg(F.coalesce(F.sum(sum((F.greatest(F.size(F.col(c)), F.lit(0)) for c in arrays), F.lit(0))), F.lit(0)).cast("long").alias("expected"))


def weight_errors(rows: DataFrame, keys: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Groups whose weights don't sum to 1."""
    return rows.groupBy(*keys).agg(F.sum("weight").alias("total")).where(F.abs(F.col("total") - 1) > tolerance)


def validate(checks: dict[str, DataFrame]) -> DataFrame:
    """One row: how many rows each check's frame of violations has."""
    out = None
    for name, df in checks.items():
        n = df.agg(F.count("*").alias(name))
        out = n if out is None else out.join(F.broadcast(n))
    return out
