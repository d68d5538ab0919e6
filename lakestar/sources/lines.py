"""Lines of text files in their true order: by file, byte range and place in the range, whatever tasks read them.

Spark cuts files into byte ranges and packs these into tasks by size, so ids given by tasks don't follow the files. A line's
place does: its file, the first byte of its range, and an id that rises along the range. Places sort as the lines do, and
``numbered`` turns them into line numbers by a count for each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def place() -> Column:
    """The place of a row just scanned from a line-wise source, as struct(file, block, at); files go by their paths.

    To be selected straight from the scan, before any other step.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """place and value of every line of the files at ``path``; a byte order mark at the beginning of a file goes."""
    return spark.read.text(path).select(place().alias("place"), F.regexp_replace("value", "^﻿", "").alias("value"))


def numbered(rows: DataFrame, name: str = "line_no", whole: bool = False) -> DataFrame:
    """``rows`` (with ``place``) plus their number from 1, in each file or, with ``whole``, over all files.

    Rows are numbered inside their byte range, which is no larger than a task reads; what lies before a range is summed
    over one count for each range of its file and one for each file.
    """
    file, block = F.col("place.file").alias("_file"), F.col("place.block").alias("_block")
    counts = rows.groupBy(file, block).agg(F.count("*").alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_file", "_block", before(Window.partitionBy("_file").orderBy("_block")).alias("_before"))
    if whole:
        files = counts.groupBy("_file").agg(F.sum("_n").alias("_n"))
        starts = starts.join(files.select("_file", before(Window.orderBy("_file")).alias("_files")), "_file").select("_file", "_block", (F.col("_before") + F.col("_files")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("place.at"))
    marked = rows.withColumns({"_file": F.col("place.file"), "_block": F.col("place.block")}).withColumn("_in", inside)
    return marked.join(starts, ["_file", "_block"]).withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_file", "_block", "_before", "_in")
