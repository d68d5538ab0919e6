"""Greedy covers: few rows that show every feature that any row has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def greedy_cover(df: DataFrame, key: str, features: str, ordinal: str) -> list:
    """Keys of rows chosen one by one: each adds the most features not covered yet; then more features, then the first ordinal.

    Rows with equal features are alike but for the first, so what comes to the driver is one row per distinct feature set:
    as many as sets of the fixed features occur, not as many as rows.
    """
    sets = df.select(F.array_sort(F.array_distinct(features)).alias("f"), F.struct(ordinal, key).alias("at")).groupBy("f").agg(F.min("at").alias("at"))
    left = [(set(r.f), r.at[0], r.at[1]) for r in sets.collect()]
    uncovered, chosen = set().union(*(f for f, _, _ in left)) if left else set(), []
    while uncovered:
        best = max(left, key=lambda x: (len(uncovered & x[0]), len(x[0]), -x[1]))
        chosen.append(best[2])
        uncovered -= best[0]
        left.remove(best)
    return chosen
