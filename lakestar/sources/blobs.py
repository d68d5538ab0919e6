"""Raw pages as gzip blobs with reproducible bytes, and ZIP bundles of them."""

from __future__ import annotations

import gzip
import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def compress(text: Column) -> Column:
    """gzip of a text's UTF-8 form, without a time stamp: equal texts have equal bytes."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else gzip.compress(t.encode(), mtime=0))

    return run(text)


def decompress(data: Column) -> Column:
    @F.pandas_udf("string")
    def run(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None else gzip.decompress(b).decode("utf-8", "replace"))

    return run(data)


def read(spark: SparkSession, path: str) -> DataFrame:
    """key (name without endings) and text of the gzip blobs below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html.gz").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.html\.gz$", 1).alias("key"), decompress(F.col("content")).alias("text"))


def bundle(rows: DataFrame, group: str, key: str, data: str) -> DataFrame:
    """One ZIP per group (its rows sorted by key, fixed times): group, n, archive. A group's blobs must fit a task."""
    kind = rows.schema[group].dataType.simpleString()

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            for k, d in pdf.sort_values(key)[[key, data]].itertuples(index=False):
                z.writestr(zipfile.ZipInfo(str(k), (1980, 1, 1, 0, 0, 0)), d)
        return pd.DataFrame({group: [pdf[group].iloc[0]], "n": [len(pdf)], "archive": [out.getvalue()]})

    return rows.select(group, key, data).groupBy(group).applyInPandas(pack, f"{group} {kind}, n long, archive binary")
