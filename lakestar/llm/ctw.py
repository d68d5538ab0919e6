"""Language-model scores by context-tree weighting over bytes.

A text is the bytes of its UTF-8 form and one end symbol (0xFF, which UTF-8 never holds). A byte is decomposed into
eight binary decisions; each decision has a context tree over the preceding bytes, whose nodes hold how often 0 and 1
followed. Krichevsky-Trofimov estimates of all depths are mixed by the trees' weights, and a text's score is the log10
of the product of the mixed probabilities, so -score / log10(2) / bytes is its code length per byte.

The counts come from all training texts (n-grams of DEPTH + 1 bytes, which hold the counts of lower depths). Scores are
looked up for n-grams seen in training and computed from the trees for others. The model is used in blocks of about
``max_grams`` n-grams, dealt by the last two context bytes, each in a pass over the texts, so that what a task holds is
bounded whatever the corpus.

Beside it stands a unigram baseline over white-space tokens with add-one smoothing. Its vocabulary grows with the
corpus: at most ``FREQUENT`` tokens, the most frequent, are broadcast, and all others joined.

Defined results: a null text counts as empty: one end symbol, one end token. Rows without a doc_id belong to no fold:
they are scored, but not learnt from, and not held out. With nothing to learn from, every bit costs one bit. Repeated
rows are learnt from and scored each. A very long text is scored as a whole, in memory of some 60 times its size. An empty
table gives no rows, and other columns are ignored, whatever their names. There are no ties to decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.common import HashTable, extended, fold, materialize, pieces, release, word_names

DEPTH = 4
END = 255
FREQUENT = 1 << 18
#: Bytes of text that are scored at a time.
PIECE = 1 << 19
TOKEN, GRAM = 0, 1
#: The end token's name; words' names are mixed and don't take it but by a chance of 2^-64.
END_NAME = 1


def symbols(offsets: np.ndarray, data: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """n-gram code of every symbol (its ``depth`` preceding bytes, then itself) and the row it belongs to.

    Before a text's start stand end symbols.
    """
    rows, length = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(rows), length)
    padded = np.full(len(data) + rows * (depth + 1), END, np.uint64)
    padded[np.arange(len(data)) + owner * (depth + 1) + depth] = data
    code = np.zeros(len(padded) - depth, np.uint64)
    for back in range(depth, -1, -1):
        code |= padded[depth - back : len(padded) - back] << np.uint64(8 * back)
    # code[i] ends at padded[i + depth]; the padding before each text but the first ends at no symbol.
    real = np.ones(len(code), bool)
    real[((offsets[1:-1] + np.arange(1, rows) * (depth + 1))[:, None] + np.arange(-depth, 0)).ravel()] = False
    return code[real], np.repeat(np.arange(rows), length + 1)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after the recurrence has brought x beyond 8."""
    shift = sum(np.log(x + k) for k in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def nodes(codes: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted node keys (context of ``depth`` bytes << 8 | bits so far) with counts of 0 and 1."""
    mask = np.uint64((1 << 8 * depth) - 1)
    pair, inverse = np.unique((codes >> np.uint64(8) & mask) << np.uint64(8) | codes & np.uint64(255), return_inverse=True)
    counts = np.bincount(inverse, counts, len(pair))
    symbol, context = pair & np.uint64(255), pair >> np.uint64(8)
    parts = []
    for bit in range(8):  # nodes of different levels are different, so a level at a time is all that is held
        keys = context << np.uint64(8) | np.uint64(1 << bit) | symbol >> np.uint64(8 - bit)
        ones = (symbol >> np.uint64(7 - bit) & np.uint64(1)) * counts
        found, inverse = np.unique(keys, return_inverse=True)
        parts.append((found, np.bincount(inverse, counts - ones, len(found)), np.bincount(inverse, ones, len(found))))
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    return keys[order], *(np.concatenate([p[i] for p in parts])[order] for i in (1, 2))


class Trees:
    """Context trees of depths ``first`` and deeper over a block of n-grams; ``below`` has the sums of the next deeper trees' log weights."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depths: range, below: tuple[np.ndarray, np.ndarray] | None = None):
        self.keys: dict[int, np.ndarray] = {}
        self.one: dict[int, np.ndarray] = {}
        self.stop: dict[int, np.ndarray] = {}
        #: Keys at the next shallower depth, with the summed log weighted probabilities of their children here.
        self.above = below
        for depth in reversed(depths):
            keys, zeros, ones = nodes(codes, counts, depth)
            estimate = log_kt(zeros, ones)
            if self.above is None:
                weighted = estimate
            else:
                children = np.zeros(len(keys))
                at = np.searchsorted(keys, self.above[0])
                children[at] = self.above[1]
                weighted = np.logaddexp(estimate, children) - np.log(2)
            self.keys[depth], self.one[depth] = keys, (ones + 0.5) / (zeros + ones + 1)
            self.stop[depth] = np.ones(len(keys)) if self.above is None else np.exp(estimate - np.log(2) - weighted)
            if depth:
                parent = keys >> np.uint64(8) & np.uint64((1 << 8 * (depth - 1)) - 1)
                parent, inverse = np.unique(parent << np.uint64(8) | keys & np.uint64(255), return_inverse=True)
                self.above = parent, np.bincount(inverse, weighted, len(parent))

    def log10(self, codes: np.ndarray, top: Trees | None = None) -> np.ndarray:
        """log10 probability of each n-gram's last byte after the others, mixed over all depths."""
        symbol = codes & np.uint64(255)
        total = np.zeros(len(codes))
        for bit in range(8):
            prefix = np.uint64(1 << bit) | symbol >> np.uint64(8 - bit)
            one = np.full(len(codes), 0.5)
            for trees in (self, top):
                for depth in sorted(trees.keys, reverse=True) if trees else ():
                    keys = (codes >> np.uint64(8) & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8) | prefix
                    if len(trees.keys[depth]):
                        at = np.minimum(np.searchsorted(trees.keys[depth], keys), len(trees.keys[depth]) - 1)
                        stop = trees.stop[depth][at]
                        one = np.where(trees.keys[depth][at] == keys, stop * trees.one[depth][at] + (1 - stop) * one, 0.5)
            total += np.log10(np.where(symbol >> np.uint64(7 - bit) & np.uint64(1), one, 1 - one))
        return total


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of tokens and n-grams: (kind, key, n). What is held stays small: it is merged and handed on."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {TOKEN: [], GRAM: []}

    def hand_on(kind: int, most: int) -> Iterator[pa.RecordBatch]:
        if not held[kind]:
            return
        keys, inverse = np.unique(np.concatenate([k for k, _ in held[kind]]), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([c for _, c in held[kind]]), len(keys)).astype(np.int64)
        if len(keys) < most:
            held[kind] = [(keys, counts)]
            return
        held[kind] = []
        for at in range(0, len(keys), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[part]), kind), pa.int32()), pa.array(keys[part].view(np.int64)), pa.array(counts[part])], names=["kind", "key", "n"])

    for batch in batches:
        for _, offsets, data in pieces(batch.column("text"), PIECE, 4096):
            names, _ = word_names(offsets, data)
            names = np.append(names, np.full(len(offsets) - 1, END_NAME, np.uint64))
            held[TOKEN].append(np.unique(names, return_counts=True))
            held[GRAM].append(np.unique(symbols(offsets, data)[0], return_counts=True))
            if len(held[TOKEN]) >= 24:
                yield from hand_on(TOKEN, 750_000)
                yield from hand_on(GRAM, 750_000)
    yield from hand_on(TOKEN, 0)
    yield from hand_on(GRAM, 0)
    release()


def _arrays(df: DataFrame, *columns: str) -> list[np.ndarray]:
    found = df.select(*columns).toArrow()
    return [found.column(c).to_numpy() for c in columns]


def gather(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts over all training texts: tokens (key, n) and n-grams (key, n)."""
    counts = train.select("text").mapInArrow(_gather, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "ctw-counts")
    return tuple(counts.where(F.col("kind") == kind).select("key", "n") for kind in (TOKEN, GRAM))


def score_texts(rows: DataFrame, grams: DataFrame, max_grams: int = 4_000_000, then: tuple | None = None) -> DataFrame:
    """``rows`` (with text) plus score, in as many passes as the model has blocks.

    ``then``: (Arrow function, schema) applied in the last pass, in the same Python worker.
    """
    spark = rows.sparkSession
    blocks = max(1, -(-grams.count() // max_grams))
    # A block holds whole subtrees below contexts of two bytes; depths 0 and 1 have at most 65,536 contexts and symbols.
    context = F.shiftrightunsigned("key", 8).bitwiseAND(0xFFFF)
    block = lambda b: _arrays(grams.where(F.pmod(F.xxhash64(context), F.lit(blocks)) == b), "key", "n")
    short = _arrays(grams.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("n").alias("n")), "key", "n")
    below, first = [], None
    for b in range(blocks):
        keys, n = block(b)
        trees = Trees(keys.astype(np.uint64), n, range(2, DEPTH + 1))
        below.append(trees.above)
        first = (keys, trees) if blocks == 1 else None
    keys, inverse = np.unique(np.concatenate([k for k, _ in below]), return_inverse=True)
    below = keys, np.bincount(inverse, np.concatenate([s for _, s in below]), len(keys))
    top = Trees(short[0].astype(np.uint64), short[1], range(0, 2), below)
    if "score" not in rows.columns:
        rows = rows.withColumn("score", F.lit(0.0))
    of_block = np.zeros(1 << 16, np.int64)  # contexts that training hasn't seen go with block 0
    if blocks > 1:
        for r in grams.select(context.cast("int").alias("c"), F.pmod(F.xxhash64(context), F.lit(blocks)).alias("b")).distinct().collect():
            of_block[r.c] = r.b
    for b in range(blocks):
        if first:
            keys, trees = first
        else:
            keys, n = block(b)
            trees = Trees(keys.astype(np.uint64), n, range(2, DEPTH + 1))
        keys = keys.astype(np.uint64)
        shared = spark.sparkContext.broadcast((HashTable(keys, trees.log10(keys, top)), trees, top, of_block == b if blocks > 1 else None))
        run = _score(shared, rows.columns)
        if b + 1 < blocks:
            rows = materialize(rows.mapInArrow(run, rows.schema), "ctw-pass")
    if then is None:
        return rows.mapInArrow(run, rows.schema)
    after, schema = then
    return rows.mapInArrow(lambda batches, run=run: after(run(batches)), schema)


def _score(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        lookup, trees, top, mine = shared.value
        for batch in batches:
            out = batch.column("score").to_numpy(zero_copy_only=False).copy()
            for at, offsets, data in pieces(batch.column("text"), PIECE, 4096):
                codes, owner = symbols(offsets, data)
                if mine is not None:
                    here = mine[(codes >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)]
                    codes, owner = codes[here], owner[here]
                value = lookup.get(codes)
                missing = np.flatnonzero(np.isnan(value))
                if len(missing):
                    novel, inverse = np.unique(codes[missing], return_inverse=True)
                    value[missing] = trees.log10(novel, top)[inverse]
                out[at : at + len(offsets) - 1] += np.bincount(owner, value, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(out) if c == "score" else batch.column(c) for c in columns], names=columns)

    return run


def _base(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, total, vocabulary, end = shared.value
        scale = np.log10(total + vocabulary + 1)
        for batch in batches:
            columns = {c: [] for c in ("n_tokens", "n_known", "base_score")}
            lists, ends = [], [0]
            for _, offsets, data in pieces(batch.column("text"), PIECE, 4096):
                names, n = word_names(offsets, data)
                count = frequent.get(names)
                owner = np.repeat(np.arange(len(n)), n)
                known = ~np.isnan(count)
                columns["n_tokens"].append(n + 1)
                columns["n_known"].append(np.bincount(owner[known], minlength=len(n)) + (end > 0))
                columns["base_score"].append(np.bincount(owner[known], np.log10(count[known] + 1) - scale, len(n)) + np.log10(end + 1) - scale)
                lists.append(names[~known].view(np.int64))
                ends += (ends[-1] + np.cumsum(np.bincount(owner[~known], minlength=len(n)))).tolist()
            kept = [c for c in batch.schema.names if c != "text"]
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))
            made = [pa.array(np.concatenate(columns[c]) if columns[c] else np.zeros(0), pa.float64() if c == "base_score" else pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made, rare], names=[*kept, *columns, "rare"])

    return run


def score(docs: DataFrame, folds: int = 7, held: int = 2, max_grams: int = 4_000_000, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of (doc_id, text).

    Learns from the rows whose fold of ``folds`` is not ``held``.
    """
    spark = docs.sparkSession
    tokens, grams = gather(docs.where(fold("doc_id", folds) != held))
    sums = tokens.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("key") == END_NAME, F.col("n"))).alias("end")).first()
    total, vocabulary, end = sums.n or 0, sums.v, sums.end or 0
    # The least count of which no more than ``frequent`` tokens have that many: one row per distinct count.
    least, seen = None, 0
    for r in tokens.groupBy(F.least("n", F.lit(4096)).alias("n")).agg(F.count("*").alias("v")).orderBy(F.desc("n")).collect():
        seen += r.v
        if seen > frequent:
            break
        least = r.n
    common = _arrays(tokens.where(F.col("n") >= least), "key", "n") if least else [np.zeros(0, np.int64)] * 2
    shared = spark.sparkContext.broadcast((HashTable(common[0].view(np.uint64), common[1].astype(float)), total, vocabulary, end))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"n_bytes": F.octet_length("text").cast("long"), "score": F.lit(0.0)})
    schema = extended(rows.drop("text").schema, n_tokens="long", n_known="long", base_score="double", rare=T.ArrayType(T.LongType()))
    scored = materialize(score_texts(rows, grams, max_grams, (_base(shared), schema)), "ctw-scores")
    asked = scored.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
    found = asked.join(tokens.where(F.col("n") < least) if least else tokens, "key", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    each = F.col("times") * (F.log10(F.col("c") + 1) - float(np.log10(total + vocabulary + 1)))
    found = found.groupBy("row").agg(F.sum(each).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"))
    zero = F.lit(0)
    return scored.drop("rare").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", (-F.col("score") / float(np.log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
