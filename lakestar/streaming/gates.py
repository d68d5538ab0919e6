"""The ingestion gates over a stream of listings: what was seen is kept as state by url and by doi, so any cut into batches judges alike.

Rows must come in the order of their ordinals from batch to batch; inside a batch they may lie as they like. State is an
ordinal for each key and goes after ``window``, when the refresh window lets an address be fetched again. The state store
must be one with column families: set ``spark.sql.streaming.stateStore.providerClass`` to ``PROVIDER``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakestar.operators import gates

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows whose key isn't asked for are dealt over so many keys.
SPREAD = 1024


class FirstOfKey(StatefulProcessor):
    """Tells the first row of each key, by ordinal, from those that come after it, in this batch or a later one.

    One row at a time is held, the first one so far, however many a key has. Rows that aren't ``asked`` come through
    unmarked and leave no state.
    """

    def __init__(self, fields: list[str], name: str, window: int | None):
        self.fields, self.name, self.window = fields, name, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType().add("ordinal", "long"), self.window)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, held = None, None
        for row in rows:
            if not row["_asked"]:
                yield self._marked(row, False)
                continue
            if known is None:
                known = self.seen.exists()
            if known or held is not None and row["ordinal"] >= held["ordinal"]:
                yield self._marked(row, True)
            else:
                if held is not None:
                    yield self._marked(held, True)
                held = row
        if held is not None:
            self.seen.update((held["ordinal"],))
            yield self._marked(held, False)

    def _marked(self, row: Row, again: bool) -> Row:
        return Row(**{f: row[f] for f in self.fields}, **{self.name: again})

    def close(self) -> None:
        pass


def again(rows: DataFrame, key: str, asked: Column, name: str, window: int | None = None) -> DataFrame:
    """``rows`` of a stream (with ordinal) plus ``name``: whether an earlier row that was ``asked`` had its key."""
    fields = rows.columns
    spread = F.when(asked, F.lit(-1)).otherwise(F.pmod(F.xxhash64("ordinal"), F.lit(SPREAD)).cast("int"))
    keyed = rows.withColumns({"_asked": F.coalesce(asked, F.lit(False)), "_key": F.when(asked, F.col(key)), "_spread": spread})
    out = T.StructType([*rows.schema.fields, T.StructField(name, T.BooleanType())])
    return keyed.groupBy("_key", "_spread").transformWithState(FirstOfKey(fields, name, window), out, "Append", "ProcessingTime" if window else "None")


def outcomes(listing: DataFrame, manifest: DataFrame, now: Column, refresh_days: int, force: bool = False, window: int | None = None) -> DataFrame:
    """As ``operators.gates.outcomes``, for a stream of listing rows against the manifest as it was when a batch began.

    ``window``: milliseconds for which an address and a doi are remembered; forever without.
    """
    known = manifest.select("url_hash", F.col("status").alias("_status"), F.col("last_seen_at").alias("_seen"), F.col("payload_hash").alias("_payload"))
    rows = again(listing.join(known, "url_hash", "left"), "url_hash", F.lit(True), "_again_url", window)
    rows = gates.built(rows.withColumn("_first", ~F.col("_again_url")).drop("_again_url"), now, refresh_days, force)
    rows = again(rows, "doi", F.col("_built") & F.col("doi").isNotNull(), "_again_doi", window)
    return gates.judged(rows, F.col("_again_doi")).drop("_again_doi")
