"""Exact substring deduplication by anchor (winnowing) matching over hashed ranks.

Positions of all texts are ranked by what begins there, at growing lengths: 1, 2, 4, ... 128 and 200 bytes. A rank is
a 64-bit name, made from the pair of ranks at p and p + length, so a task doubles its own texts' ranks without a shuffle;
Spark sorts and reranks nothing at growing lengths. It groups the anchors below, in three rounds.

Not every position has to be shuffled. Of each 200-byte string the smallest 32-byte rank within (the leftmost of equal
ones) is its anchor, so equal strings have equal anchors at equal distances; about one position in 85 is an anchor, and
each stands for the run of string starts that chose it. Round one drops anchors whose 32-byte rank is unique. Round two
ranks each anchor by the whole context of its run: if that occurs again, so does every string in it. Round three ranks
the single strings of what is left, anchors with several contexts, against the other contexts of the same anchor.

Defined results: a null text counts as empty, texts under the length have no string and stay whole. Copies of a text
are handled once; every copy gets the result. Rows repeated under one doc_id are rows each; doc_id may be of any type, and
null. A very long text is ranked as a whole, in memory of some 30 times its size. An empty table gives no rows, and other
columns are ignored, whatever their names. What decides is told by two names of 64 bits: a string by its anchor's rank and
its own, a context and a text alike; two different ones share both with a chance of 2^-128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import cleared, extended, materialize, mix64, pieces

LENGTH = 200
ANCHOR = 32
#: Contexts of one anchor that a task compares; anchors with more are compared string by string in a shuffle.
GROUP = 2_000
#: Bits of a place in an anchor's sort key, the same for every piece: equal strings must choose equal anchors anywhere.
PLACE = 31
#: Texts named in a broadcast at most; past that a join takes its place.
NAMED = 2_000_000


def ranks(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Ranks at ``anchor`` (a power of two) and ``length`` bytes, by doubling; entry p names what begins at p."""
    rank, h, at_anchor = mix64(data.astype(np.uint64) + np.uint64(1), 0x2545F491), 1, None
    while 2 * h <= length:
        if h == anchor:
            at_anchor = rank
        if len(rank) <= h:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        rank, h = mix64(rank[:-h], rank[h:]), 2 * h
    at_anchor = rank if h == anchor else at_anchor
    rest = length - h
    if len(rank) <= rest:
        return at_anchor, np.zeros(0, np.uint64)
    return at_anchor, mix64(rank[: len(rank) - rest], rank[rest:]) if rest else rank


def runs(offsets: np.ndarray, data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """For each anchor of the texts: row, first and last start of its run (in the text), rank of the anchor, rank of the context."""
    none = tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    near, far = ranks(data, length, anchor)
    if not len(far):
        return none
    width = length - anchor + 1
    key = near >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(near), dtype=np.uint64)
    full = -(-len(key) // width) * width
    blocks = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(key)] = key
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = np.minimum(back[: len(far)], ahead[width - 1 : width - 1 + len(far)]) & np.uint64((1 << PLACE) - 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(far)]
    start = np.flatnonzero(np.arange(len(far)) + length <= offsets[owner + 1])
    if not len(start):
        return none
    chosen, owner = chosen[start].astype(np.int64), owner[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    s0, s1, place, row = start[first], start[last], chosen[first], owner[first]
    shape = ((s1 - s0) << 20 | (place - s0)).astype(np.uint64)
    return row, s0 - offsets[row], s1 - offsets[row], near[place], mix64(mix64(far[s0], far[s1]), shape)


def _names(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Two names (signed longs) of each whole text."""
    raw = b"".join(xxhash.xxh3_128_digest(data[a:b].tobytes(), seed=int(b - a)) for a, b in zip(offsets[:-1], offsets[1:], strict=True))
    return np.frombuffer(raw, np.int64).reshape(-1, 2)


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in pieces(batch.column("text"), 1 << 20, 4096):
                row, s0, s1, rank, context = runs(offsets, data, length)
                if len(row):
                    name = _names(offsets, data)[row]
                    yield pa.RecordBatch.from_arrays([pa.array(rank.view(np.int64)), pa.array(context.view(np.int64)), pa.array(name[:, 0].copy()), pa.array(name[:, 1].copy()), pa.array(s0, pa.int32()), pa.array(s1, pa.int32())], names=["rank", "context", "t", "u", "s0", "s1"])

    return run


def _with_names(shared, wanted: bool):
    """Adds ``t`` and ``u``; with a set of names t, keeps the rows that are in it (or, not wanted, that aren't)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            both = np.concatenate([_names(o, d) for _, o, d in pieces(texts, rows=4096)]) if len(texts) else np.zeros((0, 2), np.int64)
            name = both[:, 0].copy()
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(name), pa.array(both[:, 1].copy())], names=[*batch.schema.names, "t", "u"])
            if shared is not None:
                known = shared.value
                inside = np.zeros(len(name), bool)
                if len(known):
                    inside = known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name
                out = out.filter(pa.array(inside == wanted))
            yield out

    return run


def _contexts(length: int):
    """The bytes of the contexts asked of each text: (rank, n, big, t, u, s0, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, t, u, asked in zip(*(batch.column(c).to_pylist() for c in ("text", "t", "u", "asked")), strict=True):
                data = (text or "").encode()
                yield pa.RecordBatch.from_pylist([{"rank": x["rank"], "n": x["n"], "big": x["big"], "t": t, "u": u, "s0": x["s0"], "data": data[x["s0"] : x["s1"] + length]} for x in asked], _CONTEXT)

    return run


_CONTEXT = pa.schema([("rank", pa.int64()), ("n", pa.int64()), ("big", pa.bool_()), ("t", pa.int64()), ("u", pa.int64()), ("s0", pa.int32()), ("data", pa.binary())])


def _strings(data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank, context and start within it of every string of some contexts."""
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    _, far = ranks(np.frombuffer(b"".join(data), np.uint8), length)
    owner = np.repeat(np.arange(len(data)), np.diff(offsets))[: len(far)]
    start = np.flatnonzero(np.arange(len(far)) + length <= offsets[owner + 1])
    return far[start], owner[start], start - offsets[owner[start]]


def _compare(length: int):
    """Ranges (t, b, e) of the contexts of an anchor whose strings occur in another of its contexts.

    Rows come sorted by rank; whole anchors are compared together, many at a time: a string of one anchor is none of another.
    """

    def ranges(rows: pa.Table) -> pa.RecordBatch:
        name, owner, start = _strings(rows.column("data").to_pylist(), length)
        t, u, s0, n, anchor = (rows.column(c).to_numpy() for c in ("t", "u", "s0", "n", "rank"))
        order = np.lexsort((anchor[owner], name))
        same = (name[order[1:]] == name[order[:-1]]) & (anchor[owner[order[1:]]] == anchor[owner[order[:-1]]])
        twice = np.zeros(len(name), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        again = np.flatnonzero(twice & (n[owner] == 1))
        owner, start = owner[again], start[again]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(owner))[: len(first)] - 1
        begin = s0[owner[first]].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(t[owner[first]]), pa.array(u[owner[first]]), pa.array(begin + start[first]), pa.array(begin + start[last] + length)], names=["t", "u", "b", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                held.append(batch.slice(at, 4096))
                if sum(b.num_rows for b in held) < 8192:
                    continue
                rows = pa.Table.from_batches(held)
                ranks_held = rows.column("rank").to_numpy()
                whole = int(np.searchsorted(ranks_held, ranks_held[-1]))
                if whole:
                    yield ranges(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield ranges(pa.Table.from_batches(held))

    return run


def _single_strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rank, owner, start = _strings(part.column("data").to_pylist(), length)
                t, u, s0, n, anchor = (part.column(c).to_numpy(zero_copy_only=False) for c in ("t", "u", "s0", "n", "rank"))
                yield pa.RecordBatch.from_arrays([pa.array(anchor[owner]), pa.array(rank.view(np.int64)), pa.array(t[owner]), pa.array(u[owner]), pa.array((s0[owner] + start).astype(np.int64)), pa.array(n[owner])], names=["rank", "string", "t", "u", "b", "n"])

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """t, u (names of a text), ranges (array of [b, e) byte ranges whose strings occur elsewhere too, perhaps overlapping)."""
    spark, text = docs.sparkSession, ["t", "u"]
    docs = docs.select("text").where(F.octet_length("text") >= length)
    anchors = materialize(docs.mapInArrow(_anchors(length), "rank long, context long, t long, u long, s0 int, s1 int"), "suffix-places")
    # Round one: 32-byte ranks that occur again.
    twice = anchors.groupBy("rank").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    # Written first, so that the join has plain shuffles on both sides and Spark can split a rank that very many places have.
    twice = materialize(twice.where("n > 1").select("rank", (F.col("low") != F.col("high")).alias("mixed")), "suffix-ranks")
    left = materialize(anchors.join(twice, "rank"), "suffix-anchors")
    cleared(spark)
    # Round two: contexts that occur again. Of each context one place is enough from here on.
    contexts = left.where("mixed").groupBy("rank", "context").agg(F.count("*").alias("n"), F.min(F.struct("t", "u", "s0", "s1")).alias("at"))
    contexts = materialize(contexts.select("rank", "context", "n", "at.t", "at.u", "at.s0", "at.s1"), "suffix-contexts")
    whole = left.where(~F.col("mixed")).select("t", "u", "s0", "s1").union(left.where("mixed").join(contexts.where("n > 1").select("rank", "context"), ["rank", "context"], "left_semi").select("t", "u", "s0", "s1"))
    whole = whole.select("t", "u", F.col("s0").cast("long").alias("b"), (F.col("s1") + length).cast("long").alias("e"))
    # Round three: the strings of contexts that occur once, against the other contexts of their anchor.
    sizes = contexts.groupBy("rank").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1")
    asked = contexts.join(sizes, "rank").select("t", "u", F.struct("rank", "n", (F.col("m") > GROUP).alias("big"), "s0", "s1").alias("x"))
    asked = materialize(asked.groupBy(*text).agg(F.collect_list("x").alias("asked")), "suffix-asked")
    named = _known(asked)
    # One copy of a text answers for all.
    texts = docs.mapInArrow(_with_names(named, True), "text string, t long, u long").groupBy(*text).agg(F.first("text").alias("text"))
    found = materialize(texts.join(asked, text).select("text", "t", "u", "asked").mapInArrow(_contexts(length), "rank long, n long, big boolean, t long, u long, s0 int, data binary"), "suffix-strings")
    cleared(spark)
    small = found.where(~F.col("big")).repartition("rank").sortWithinPartitions("rank").mapInArrow(_compare(length), "t long, u long, b long, e long")
    strings = found.where("big").mapInArrow(_single_strings(length), "rank long, string long, t long, u long, b long, n long")
    again = materialize(strings.groupBy("rank", "string").agg(F.count("*").alias("m")).where("m > 1").select("rank", "string"), "suffix-again")
    large = strings.where("n = 1").join(again, ["rank", "string"], "left_semi").select("t", "u", "b", (F.col("b") + length).alias("e"))
    ranges = whole.union(small).union(large).distinct()
    return materialize(ranges.groupBy(*text).agg(F.collect_list(F.struct("b", "e")).alias("ranges")), "suffix-ranges")


def _known(keyed: DataFrame):
    """The sorted names ``t`` as a broadcast, if there are at most NAMED of them; else None."""
    if keyed.count() > NAMED:
        return None
    return keyed.sparkSession.sparkContext.broadcast(np.sort(keyed.select("t").toArrow().column("t").to_numpy()))


def union_of(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(ranges):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        ranges = batch.column("ranges").to_pylist() if "ranges" in batch.schema.names else [None] * batch.num_rows
        for text, found in zip(batch.column("text").to_pylist(), ranges, strict=True):
            data = (text or "").encode()
            spans = union_of([(x["b"], x["e"]) for x in found or ()])
            kept, at = hashlib.sha256(), 0
            for b, e in spans:
                kept.update(data[at:b])
                at = e
            kept.update(data[at:])
            rows.append((len(data), sum(e - b for b, e in spans), len(spans), kept.hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of (doc_id, text)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = repeated_ranges(docs, length)
    cleared(docs.sparkSession)
    out = extended(docs.select("doc_id").schema, n_bytes="long", n_removed="long", n_spans="long", kept_sha256="string")
    with_names = extended(docs.schema, t="long", u="long")
    named = _known(ranges)
    rows = docs.mapInArrow(_with_names(named, True), with_names)
    if named is None:
        return rows.join(ranges, ["t", "u"], "left").select("doc_id", "text", "ranges").mapInArrow(_digest, out)
    clean = docs.mapInArrow(_with_names(named, False), with_names).mapInArrow(_digest, out)
    return clean.union(rows.join(ranges, ["t", "u"], "left").select("doc_id", "text", "ranges").mapInArrow(_digest, out))
