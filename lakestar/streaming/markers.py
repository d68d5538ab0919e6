"""Landings processed by their markers: a stream of marker files, each batch built into the lake and acknowledged last.

A marker says that all files of a landing are there. Spark's checkpoint knows which markers a batch has, so a batch that
was stopped is run again with the same ones; what it builds must be idempotent, as merges are. The marker's ``.processed``
sibling is written when the build has ended, and a marker that has one is passed over, whatever the checkpoint knows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.sources import landing
from lakestar.sources.files import Files

SUFFIX = ".processed"


def marker_stream(spark: SparkSession, root: str, schema: str = "publisher string, landed_at string", per_batch: int | None = None) -> DataFrame:
    """key (the marker's path) and fields of the markers below <root>/_markers, as they come; ``per_batch`` at most at a time."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader
    return reader.json(f"{root.rstrip('/')}/_markers").select(F.col("_metadata.file_path").alias("key"), "*")


def process_markers(spark: SparkSession, root: str, build: Callable[[DataFrame], dict | None], checkpoint: str, schema: str = "publisher string, landed_at string", per_batch: int | None = None, now: str = "") -> int:
    """Runs ``build`` over the pending markers that are there, batch by batch, and acknowledges them; returns how many.

    ``build`` gets a batch's pending markers (key and fields); what it returns is written into the acknowledgement. If it
    raises, the batch isn't acknowledged and comes again the next time.
    """
    folder, done = f"{root.rstrip('/')}/_markers", 0
    files = Files(spark, root)
    if not files.exists(folder):
        return 0

    def batch(df: DataFrame, number: int) -> None:
        nonlocal done
        mine = df.sparkSession
        # One name a landing; names of siblings, not their contents.
        siblings = mine.createDataFrame([(_local(p),) for p, _ in files.tree(folder) if p.endswith(SUFFIX)], "key string")
        markers = df.withColumn("path", F.col("key")).withColumn("key", F.regexp_replace(F.url_decode(F.replace("key", F.lit("+"), F.lit("%2B"))), "^[A-Za-z0-9+.-]+:/+", "/"))
        todo = landing.pending(markers.select("key").union(siblings), SUFFIX)
        markers = markers.join(todo, "key", "left_semi").persist()
        try:
            keys = [r.key for r in markers.select("key").orderBy("key").collect()]
            if keys:
                told = build(markers.drop("path")) or {}
                for key in keys:
                    files.create(f"{_scheme(folder)}{key}{SUFFIX}", json.dumps({"processed_at": now, "batch": number} | told, sort_keys=True), overwrite=True)
                done += len(keys)
        finally:
            markers.unpersist()

    stream = marker_stream(spark, root, schema, per_batch)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return done


def _local(path: str) -> str:
    """A path without its scheme and empty host."""
    from urllib.parse import urlsplit

    return "/" + path.split(":", 1)[1].lstrip("/") if urlsplit(path).scheme else path


def _scheme(path: str) -> str:
    return path.split(":", 1)[0] + "://" if "://" in path or path.startswith("file:") else ""
