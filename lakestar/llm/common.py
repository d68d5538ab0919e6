"""What the training-data operators share: shared-folder tables, hold-out folds and byte views of Arrow columns."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.session import shared_folder
from lakestar.sources.files import Files


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cleared(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of queries that are done: it does when the driver's objects of them are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*written: DataFrame) -> None:
    """Deletes the files of materialized tables that nothing will read again: what was made of them must be written."""
    for df in written:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            Files(df.sparkSession, folder).delete(folder)


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` with one more column that tells its rows apart, whenever it is read, and that column's name.

    Rows of Parquet files have a place of their own: the number of the file and of the row in it. Others are written first.
    """
    row = "row"
    while row in {c.lower() for c in df.columns}:
        row += "_"
    return _placed(df, row) or materialize(df.withColumn(row, F.monotonically_increasing_id()), name), row


#: Rows of one file that a row's number has room for, and files whose names are broadcast at most.
_ROWS, _FILES = 1 << 42, 1 << 16


def _placed(df: DataFrame, row: str) -> DataFrame | None:
    """``df`` with its rows' places in the Parquet files they are read from; None where it is made of anything but one scan."""
    files = sorted(df.inputFiles())
    if not files or len(files) > _FILES:
        return None
    try:
        here = df.select(*map(_named, df.columns), F.col("_metadata.row_index").alias(row), _decoded("_metadata.file_path").alias(f"{row}_file"))
    except AnalysisException:  # no scan of rows that have places
        return None
    # One row a file, no more than _FILES: Spark doesn't know the size of rows that the driver makes, and would deal out the
    # texts by file otherwise.
    numbers = df.sparkSession.createDataFrame(list(enumerate(files)), f"{row}_number long, path string").select(f"{row}_number", _decoded("path").alias(f"{row}_path"))
    here = here.join(F.broadcast(numbers), here[f"{row}_file"] == numbers[f"{row}_path"], "left")
    number = F.coalesce(f"{row}_number", F.raise_error(F.concat(F.lit("a file that wasn't listed: "), f"{row}_file")).cast("long"))
    return here.select(*map(_named, df.columns), (number * _ROWS + F.col(row)).alias(row))


def _decoded(path: str) -> Column:
    """A file's URI in one form: Spark encodes more or fewer of its characters, and writes an empty host or not, in different places."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^([A-Za-z0-9+.-]+):///", "$1:/")


def packed(docs: DataFrame, *used: str, into: str = "_columns_of_the_input") -> DataFrame:
    """The columns ``used`` and all others in one struct (``into``), so that an operator's own columns clash with none of them."""
    rest = [c for c in docs.columns if c not in used]
    return docs.select(*used, *([F.struct(*map(_named, rest)).alias(into)] if rest else []))


def unpacked(df: DataFrame, columns: list[str], *used: str, into: str = "_columns_of_the_input") -> DataFrame:
    """``columns`` in that order: those ``used`` as they are now, the others as they were packed, whatever else was added."""
    return df.select(*(_named(c) if c in used else F.col(into).getField(c).alias(c) for c in columns))


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; every operator selects the columns it needs, so the scan reads only these."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def extended(schema: T.StructType, **columns: str | T.DataType) -> T.StructType:
    """A copy of ``schema`` with more columns."""
    out = T.StructType(list(schema.fields))
    for name, kind in columns.items():
        out.add(name, kind)
    return out


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def pieces(column: pa.Array, size: int = 1 << 21, rows: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole consecutive texts as (first row, offsets from 0, bytes), about ``size`` bytes or ``rows`` rows at a time; nulls are empty.

    One text larger than ``size`` is a piece of its own: texts are never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_string_view(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, first + rows, len(column))
        yield first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sends Python workers ``rows`` texts at a time, unless the session says how many: Spark's 10,000 are sized for short rows.

    A batch is held by the JVM and the worker at once, in both directions. Results don't depend on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))


def release() -> None:
    """Gives freed memory back to the system: Python workers are used again, and would hold it in later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix64(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit name for the pair (a, b)."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += b if isinstance(b, np.ndarray) else np.uint64(b)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_names(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of all words (runs between white space, A-Z lower-cased), in order, and how many each text has.

    A word's name sums a mix of each byte with its place in the word, so equal words have equal names anywhere.
    """
    rows = len(offsets) - 1
    data = _LOWER[data]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    place = (np.arange(len(data)) - starts[np.maximum(np.cumsum(first) - 1, 0)]).astype(np.uint64)
    part = mix64((data.astype(np.uint64) + np.uint64(1)) | (place << np.uint64(9)), 0x51ED270B)
    part[~inside] = 0
    name = mix64(np.add.reduceat(part, starts), np.add.reduceat(inside.astype(np.uint64), starts))
    return name, np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=rows)


class HashTable:
    """uint64 keys to float64 values in open addressing; lookups are vectorised."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, np.nan)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = np.isnan(self.values[slot[left]])
            at, first = np.unique(slot[left[free]], return_index=True)
            placed = left[free][first]
            self.keys[at], self.values[at] = keys[placed], values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values; nan for keys that aren't there."""
        slot = self._slot(keys)
        out = self.values[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & ~np.isnan(out))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            out[wrong] = self.values[slot[wrong]]
            wrong = wrong[(self.keys[slot[wrong]] != keys[wrong]) & ~np.isnan(out[wrong])]
        return out
