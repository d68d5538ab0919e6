"""Files that arrive, merged into a versioned table in micro-batches: exactly once by idempotent merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakestar.sources.table import Clause, VersionedTable


def merge_stream(stream: DataFrame, table: VersionedTable, keys: list[str], clauses: list[Clause], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    """Processes all that is available, then stops. A replayed batch changes nothing."""

    def batch(df: DataFrame, _: int) -> None:
        table.merge(prepare(df), keys, clauses)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def parquet_stream(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Parquet files below ``path`` that match ``pattern``, with the schema of what is there."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(path).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)
