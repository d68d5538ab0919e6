"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the normalised words of all benchmark items. Training words are streamed through it; at each word
the length of the longest match ending there is tracked, and spans whose match reaches the window length (or which are
a whole item shorter than that) are hit.

Defined results: null texts have no words. An item without words has no window. Items repeated under one item_id count
once; the windows of an item without an id are hit, but name no item. Equal windows of several items name all of them.
Repeated documents are rows each. A very long text is streamed whole; a very long item is one automaton. Empty tables give
no rows, or no hits. Columns that the scan adds replace those of the same name; ``remove`` keeps all of the input's. Benchmarks past ``max_words`` words or
``max_bytes`` bytes are taken in blocks, each with an automaton of its own, and the hits united: an automaton has at most
two states a word, so what is broadcast and held has a proven bound but for one item alone beyond it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.common import extended, materialize, packed, release, text_batches, unpacked

#: Bytes to words: A-Z fall to lower case; what is neither a letter, a digit nor beyond ASCII separates.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The normalised words of a text."""
    return text.encode("utf-8", "replace").translate(_WORDS).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word ids; states know which windows end in them.

    ``window``: a state's strings of that length or more hold a full window at their end. ``items_at`` maps the state
    that holds a window to the items that have it; ``shorter`` maps a state to the whole short items that are suffixes
    of its strings, as (words, items), shortest first.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for i, ws in items if ws]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self.items_at: dict[int, set[str]] = {}
        short: dict[int, tuple[int, set[str]]] = {}
        for item, ws in coded:
            if len(ws) >= window:
                for state, length in self._walk(ws):
                    if length >= window:
                        self.items_at.setdefault(self._holding(state, window), set()).update([item] if item is not None else [])
            else:
                state = self._holding(self._walk(ws)[-1][0], len(ws))
                short.setdefault(state, (len(ws), set()))[1].update([item] if item is not None else [])
        self.least = min([window, *(n for n, _ in short.values())]) if coded else 0
        #: For each state the ancestor that holds its suffix of ``window`` words, and the short items among its suffixes.
        self.full, self.shorter = [-1] * len(self.next), [()] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            if up >= 0:
                self.full[state] = self.full[up] if self.length[up] >= window else state if self.length[state] >= window else -1
                self.shorter[state] = self.shorter[up] + ((short[state],) if state in short else ())
        self.pairs = np.zeros(1 << 22, bool)
        for _, ws in coded:
            ids = np.array(ws, np.int64)
            self.pairs[self._pair(ids[:-1], ids[1:])] = True

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b * 7_919) & ((1 << 22) - 1)

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.next.append(onward)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        made = self._state(length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = made
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[made] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return made

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _walk(self, ids: Iterable[int]) -> list[tuple[int, int]]:
        """State and longest matching length after each word."""
        state, matched, out = 0, 0, []
        nxt, link, length = self.next, self.link, self.length
        for w in ids:
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            out.append((state, matched))
        return out

    def _holding(self, state: int, n: int) -> int:
        """The suffix-link ancestor whose strings include the suffix of ``n`` words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def match(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (start, end) of a stretch of word ids, and the items with occurring windows."""
        spans, items = [], set()
        for end, (state, matched) in enumerate(self._walk(ids.tolist()), 1):
            if matched >= self.window:
                spans.append((end - matched, end))
                items |= self.items_at.get(self.full[state], ())
            for n, owners in self.shorter[state]:
                if n <= matched:
                    spans.append((end - n, end))
                    items |= owners
        return spans, items

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs of known words, and known neighbours, long enough to hold a window: all that has to be streamed."""
        if not self.least or len(ids) < self.least:
            return []
        if self.least == 1:
            good, longer = ids >= 0, 0
        else:
            good, longer = (ids[:-1] >= 0) & (ids[1:] >= 0) & self.pairs[self._pair(ids[:-1], ids[1:])], 1
        edge = np.flatnonzero(np.diff(np.concatenate(([0], good.view(np.int8), [0]))))
        start, end = edge[::2], edge[1::2] + longer
        fit = end - start >= self.least
        return list(zip(start[fit].tolist(), end[fit].tolist(), strict=True))


def _blocks(benchmark: DataFrame, max_words: int, max_bytes: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Distinct items, in blocks of ``max_words`` words and ``max_bytes`` bytes at most (one larger item is a block)."""
    block, n, size = [], 0, 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct().toLocalIterator():
        ws = words(row.text)
        held = sum(map(len, ws))
        if block and (n + len(ws) > max_words or size + held > max_bytes):
            yield block
            block, n, size = [], 0, 0
        block.append((row.item_id, ws))
        n, size = n + len(ws), size + held
    yield block


def _with_last(blocks: Iterator[list]) -> Iterator[tuple[list, bool]]:
    """Each block and whether it is the last."""
    held = next(blocks)
    for block in blocks:
        yield held, False
        held = block
    yield held, True


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_words: int = 200_000, max_bytes: int = 4 << 20, max_coverage: float | None = None) -> DataFrame:
    """``docs`` plus n_words, spans (array of hit [start, end) word ranges, disjoint, in order) and items (sorted item ids).

    Columns of ``docs`` by these names are replaced. ``max_coverage``: rows of which more is hit go, and the spans are cut
    out of the text, in the pass that finds them.
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.drop("n_words", "spans", "items")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = extended(docs.schema, n_words="long", spans=T.ArrayType(span), items=T.ArrayType(T.StringType()))
    has_earlier = False
    for block, final in _with_last(_blocks(benchmark, max_words, max_bytes)):
        shared = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        if has_earlier:
            docs = materialize(docs, "decontam")

        def one(batches: Iterator[pa.RecordBatch], shared=shared, earlier=has_earlier, cut=max_coverage if final else None) -> Iterator[pa.RecordBatch]:
            release()  # what an earlier stage has left in this worker
            sam = shared.value
            get = sam.vocabulary.get
            for batch in batches:
                n_words, spans, items, texts, kept_rows = [], [], [], batch.column("text").to_pylist(), []
                for row, text in enumerate(texts):
                    ws = words(text)
                    n_words.append(len(ws))
                    ids = np.fromiter(map(get, ws, repeat(-1)), np.int64, len(ws))
                    hit, named = [], set()
                    for start, end in sam.stretches(ids):
                        found, owners = sam.match(ids[start:end])
                        hit += [(start + a, start + b) for a, b in found]
                        named |= owners
                    if earlier:
                        hit += [(x["start"], x["end"]) for x in batch.column("spans")[row].as_py()]
                        named |= set(batch.column("items")[row].as_py())
                    spans.append(_union(hit))
                    items.append(sorted(named))
                    if cut is not None and spans[-1]:
                        texts[row] = without_words(text, spans[-1])
                    if cut is None or sum(b - a for a, b in spans[-1]) <= n_words[-1] * cut:
                        kept_rows.append(row)
                kept = [c for c in batch.schema.names if c not in ("n_words", "spans", "items")]
                spans = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                whole = lambda c: pa.array(texts, pa.string()) if c == "text" and cut is not None else batch.column(c)
                out = pa.RecordBatch.from_arrays([*(whole(c) for c in kept), pa.array(n_words, pa.int64()), spans, pa.array(items, pa.list_(pa.string()))], names=[*kept, "n_words", "spans", "items"])
                yield out if len(kept_rows) == len(out) else out.take(pa.array(kept_rows, pa.int64()))

        docs = docs.mapInArrow(one, schema)
        has_earlier = True
    return docs


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, **options) -> DataFrame:
    """``docs`` without the hit spans; a document more than ``max_coverage`` of whose words are hit goes as a whole.

    The text around a removed span is kept as it is, so a document without hits keeps its text byte by byte. All other
    columns are kept, whatever their names.
    """
    whole, docs = docs.columns, packed(docs, "text")
    return unpacked(scan(docs, benchmark, window, max_coverage=max_coverage, **options), whole, "text")


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the word ranges ``spans`` (from the first byte of the first word to the last of the last)."""
    data = text.encode("utf-8", "replace")
    inside = np.frombuffer(data.translate(_WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the comma-joined sorted item ids), contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark, window, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]).cast("long"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
