"""Row hashes, surrogate keys and table fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_hash(*columns: str) -> Column:
    """sha256 of the row's JSON, with its nulls."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def surrogate_key(*columns: str) -> Column:
    """Deterministic 64-bit key of a natural key, which must not hold nulls (they are skipped by the hash)."""
    return F.xxhash64(*columns)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that is equal for equal multisets of rows, in any order: count, sum and xor of row hashes.

    Aggregates partially, so a table of any size needs no sort and no single large task.
    """
    h = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    return df.select(h.alias("h")).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("sum"), F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")).alias("xor"))


def portable_fingerprint(df: DataFrame) -> DataFrame:
    """As ``fingerprint``, but from sha256 of the rows' joined text columns (its first 60 bits), which any engine has."""
    h = F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in df.columns)), 256)
    short = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
    return df.select(short.alias("h")).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("total"), F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")).alias("parity"))


#: Provenance and derived fields that a payload hash leaves out, beside all fields ending in _rich.
NOT_PAYLOAD = ("run_id", "scraped_at", "source_url", "english_title_rich", "foreign_title_rich", "english_abstract_rich")


def _ordered(c: Column, kind: T.DataType) -> Column:
    """A value whose objects have their keys in order, all the way down."""
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(_ordered(c.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name))))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _ordered(x, kind.elementType)) if isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)) else c
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(F.transform_values(c, lambda _, v: _ordered(v, kind.valueType)))))
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        raise TypeError(f"{kind.simpleString()} has no one text to be hashed by")
    return c


def canonical_json(record: Column, kind: T.StructType) -> Column:
    """JSON of a struct: sorted keys, no blanks, letters as they are, nulls kept, control characters by lower-case numbers."""
    text = F.to_json(_ordered(record, kind), {"ignoreNullFields": "false"})
    # Spark numbers control characters in upper case; a backslash that is itself escaped begins no number.
    lower = reduce(lambda x, c: F.regexp_replace(x, rf"(?<!\\)((?:\\\\)*\\u00[01]){c}", f"$1{c.lower()}"), "ABCDEF", text)
    return F.when(text.rlike(r"\\u00[01][A-F]"), lower).otherwise(text)


def payload_hash(rows: DataFrame, record: Column) -> Column:
    """sha256 of a struct's canonical JSON without provenance and rich text; ``rows``: what it is a column of, for its type."""
    kind = rows.select(record.alias("record")).schema["record"].dataType
    kept = [f for f in kind.fields if f.name not in NOT_PAYLOAD and not f.name.endswith("_rich")]
    content = F.struct(*(record.getField(f.name).alias(f.name) for f in kept))
    return F.when(record.isNotNull(), F.sha2(canonical_json(content, T.StructType(kept)).cast("binary"), 256))
