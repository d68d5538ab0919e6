"""N-gram Jaccard join: documents whose sets of word n-grams are similar, by blocked products of the sparse incidence matrix.

A document's row of the incidence matrix holds the 64-bit names of its distinct n-grams; documents with equal rows are
one class from the start. All bounds come from row sizes alone, so no link is lost. A link at ``threshold`` needs
need(n) = ceil(threshold * n / 100) common columns of a row of n, so at most n - need(n) of its columns are not common:

* Rows are thinned by the columns of smallest name: of the first n - need(n) + l columns of two linked rows at least l are
  common. A row with fewer columns that another row has among its own first ones is in no link.
* Of the rows left, all columns are counted, and a row with fewer than need(n) columns that another row has goes.
* The product is taken over each row's first n - need(n) + 1 columns, rare ones first: linked rows meet in one of these.
  A column is multiplied block by block: its first few rows (1, 8, 64, ... in each round) with all others. Pairs that are
  connected already are discarded, and pairs of sizes that can't link: each has only so many columns that others have,
  before and after this one, and a distance from the row it was first multiplied with. The others' overlaps are counted
  over all columns. Rows once multiplied leave the column, and so does a column whose rows are all connected.

So a group of near copies, of any size, costs its first rows' products and not all its pairs. Rows that share rare
columns and stay unconnected are multiplied pair by pair, which an exact join can't avoid; each round's pairs are rows of a
join that Spark splits where a column is frequent.

Defined results: a text with fewer words than n is one n-gram; without words (or null) it has size 0, no link, and is
its own component. Rows without a doc_id are linked like others, but lend no id: a component of only such rows has a
null id. Rows repeated under one doc_id are rows each. A very long text is one row of as many columns; only the columns
of one document are ever gathered. An empty table has no components. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.common import cleared, discard, extended, materialize, mix64, numbered, pieces, release, text_batches, word_names

#: Rows of a column that are multiplied with all others in the first round, and by how much they grow from round to round.
#: Few at first: most rows of a group of near copies link to one of its first rows, and are spared the others.
BLOCK, GROWTH = 1, 8
#: Columns before one that are looked at for an earlier one in common.
BEFORE = 12
#: Buckets of text names that are broadcast, whatever the corpus: some MB.
BUCKETS = 1 << 19


def shingles(offsets: np.ndarray, data: np.ndarray, n: int) -> list[np.ndarray]:
    """For each text the sorted names (uint64) of its distinct word n-grams; an n-gram's name chains those of its words."""
    rows = len(offsets) - 1
    name, n_words = word_names(offsets, data)
    if not len(name):
        return [np.zeros(0, np.uint64)] * rows
    gram = name.copy()
    for k in range(1, min(n, len(gram))):
        gram[: len(gram) - k] = mix64(gram[: len(gram) - k], name[k:])
    ends = np.cumsum(n_words)
    out = []
    for row in range(rows):
        a, b = ends[row] - n_words[row], ends[row]
        if b - a >= n:
            out.append(np.unique(gram[a : b - n + 1]))
        elif b > a:
            whole = name[a : a + 1].copy()
            for k in range(a + 1, b):
                whole = mix64(whole, name[k : k + 1])
            out.append(mix64(whole, int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed(n, threshold: int):
    """The least overlap of a row of n columns with any row that it links to; of numbers or of a Column."""
    if isinstance(n, Column):
        return F.ceil(n * threshold / 100)
    return -(-threshold * n // 100)


def _more(n):
    """Columns beyond the shortest prefix that the first filter looks at: the more, the more must be common."""
    if isinstance(n, Column):
        return F.floor(n / 16) + 1
    return n // 16 + 1


def _set_names(grams: np.ndarray) -> tuple[int, int]:
    """Two names for the whole set."""
    a = np.bitwise_xor.reduce(mix64(grams, 0x1234567)) if len(grams) else np.uint64(0)
    b = np.add.reduce(mix64(grams, 0x89ABCDE)) if len(grams) else np.uint64(0)
    both = mix64(np.array([a, b], np.uint64), np.array([b, a ^ np.uint64(len(grams))], np.uint64)).view(np.int64)
    return int(both[0]), int(both[1])


def _sets(n: int, threshold: int | None):
    """Arrow function: adds n_shingles, the set's names s1 and s2, and ``grams``: the first columns by name, or all (no threshold)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what an earlier stage has left in this worker
        for batch in batches:
            for first, offsets, data in pieces(batch.column("text"), 1 << 18):
                rows = shingles(offsets, data, n)
                part = batch.slice(first, len(rows))
                names = [c for c in part.schema.names if c != "text"]
                arrays = [part.column(c) for c in names]
                both = [_set_names(r) for r in rows]
                arrays += [pa.array([len(r) for r in rows], pa.int64()), pa.array([a for a, _ in both], pa.int64()), pa.array([b for _, b in both], pa.int64())]
                cut = rows if threshold is None else [r[: len(r) - needed(len(r), threshold) + _more(len(r))] for r in rows]
                flat = np.concatenate(cut).view(np.int64) if cut else np.zeros(0, np.int64)
                arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(r) for r in cut]))), pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_shingles", "s1", "s2", "grams"])
            release()

    return run


def _connected(edges: DataFrame, name: str) -> DataFrame:
    """node, label (smallest node) of an undirected graph (a, b): large-star and small-star rounds until nothing moves.

    Each round works by aggregated minima, which are written before they are joined: so the join has plain shuffles on
    both sides, and Spark can split a node that very many edges have.
    """
    sign = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    before = sign(edges)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), name)
        discard(edges, least)
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), name)
        discard(large, least)
        # Both sides hold distinct edges (larger, smaller): equal sums and counts of names mean nothing moved.
        after = sign(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = after


def _live(docs: DataFrame, sets: DataFrame, rows: DataFrame, n: int, threshold: int) -> DataFrame:
    """The rows that may be in a link: sid, n, grams (the columns that others have too, rare ones first) and how many of these are multiplied.

    ``rows`` is deleted when it has been read.
    """
    # Columns among the first ones of different sets, and how many of them each row has. Written first, so that the join
    # has plain shuffles on both sides and Spark can split a column that very many rows have.
    first = rows.where("n_shingles > 1").select("row", "s1", F.explode("grams").alias("g"))
    twice = first.groupBy("g").agg(F.min("s1").alias("low"), F.max("s1").alias("high")).where("low <> high").select("g")
    twice = materialize(twice, "jaccard-columns")
    cleared(docs.sparkSession)
    hits = first.select("row", "g").join(twice, "g", "left_semi").groupBy(F.col("row").alias("sid")).agg(F.count("*").alias("hits"))
    hits = materialize(hits, "jaccard-hits")
    discard(rows)
    cleared(docs.sparkSession)
    hits = sets.join(hits, "sid").where(F.col("hits") >= _more(needed(F.col("n_shingles"), threshold)))
    alive = materialize(hits.select("sid", "n_shingles", "s1", "s2", "t1", "of"), "jaccard-alive")
    # All columns of these, from one document of each: its id is part of the key, so that copies of a text don't meet.
    # Texts whose name falls in no bucket that a wanted one falls in needn't be shuffled; there are BUCKETS at most to broadcast.
    bucket = F.pmod("t1", F.lit(BUCKETS)).cast("int").alias("bucket")
    texts = docs.select("text", F.xxhash64("text").alias("t1"), F.xxhash64("doc_id").alias("of")).withColumn("bucket", bucket)
    texts = texts.join(F.broadcast(alive.select(bucket).distinct()), "bucket", "left_semi").join(alive.select("t1", "of"), ["t1", "of"], "left_semi")
    texts = texts.groupBy("t1", "of").agg(F.first("text").alias("text")).select("text")
    schema = extended(T.StructType(), n_shingles="long", s1="long", s2="long", grams=T.ArrayType(T.LongType()))
    full = texts.mapInArrow(_sets(n, None), schema).join(alive.drop("t1", "of"), ["n_shingles", "s1", "s2"])
    full = materialize(full.select("sid", F.col("n_shingles").alias("n"), "grams"), "jaccard-sets")
    cleared(docs.sparkSession)
    entries = full.select("sid", "n", F.explode("grams").alias("g"))
    df = materialize(entries.groupBy("g").agg(F.count("*").alias("df")).where("df > 1"), "jaccard-counts")
    cleared(docs.sparkSession)
    shared = entries.join(df, "g").groupBy("sid").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "g"))).alias("x"))
    shared = shared.where(F.size("x") >= needed(F.col("n"), threshold))
    # Columns that no other row has come first in the order, so only the rest of the prefix is multiplied.
    live = materialize(shared.select("sid", "n", F.col("x.g").alias("grams"), (F.size("x") - needed(F.col("n"), threshold) + 1).cast("int").alias("prefix")), "jaccard-live")
    discard(full, df)
    cleared(docs.sparkSession)
    return live


def _labels(live: DataFrame, threshold: int) -> DataFrame:
    """node, label of the components of all links among ``live``."""
    # ``c``: columns of the row that other rows have too; ``p``: how many of these come before g; ``before``: the last ones.
    placed = F.expr(f"transform(sequence(0, prefix - 1), i -> struct(i as p, grams[i] as g, slice(grams, greatest(i - {BEFORE - 1}, 1), least(i, {BEFORE})) as before))")
    entries = live.select("sid", "n", F.size("grams").alias("c"), F.explode(placed).alias("x")).select("sid", "n", "c", "x.p", "x.g", "x.before")
    own = F.col("sid")
    entries = entries.withColumns({"label": own, "pivot": own, "far": F.lit(0.0)})
    labels, block, spent = None, BLOCK, []
    while True:
        # Columns that still join rows of different components.
        entries = materialize(entries, "jaccard-entries")
        discard(*spent)
        whole = entries
        apart = entries.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("g")
        apart = materialize(apart, "jaccard-apart")
        entries = materialize(entries.join(apart, "g", "left_semi"), "jaccard-entries")
        discard(whole, apart)
        spent = [entries]
        if entries.isEmpty():
            discard(entries, live)
            none = live.sparkSession.createDataFrame([], "node long, label long")
            return none if labels is None else labels
        place = F.row_number().over(Window.partitionBy("g").orderBy("sid"))
        names = {"sid": "h", "n": "nh", "c": "ch", "p": "ph", "label": "other", "pivot": "pivot_h", "far": "far_h", "before": "before_h"}
        hubs = materialize(entries.withColumn("place", place).where(F.col("place") <= block).drop("place").withColumnsRenamed(names), "jaccard-hubs")
        # Two rows that share a column before this one meet, or have met, in that one: a pair is made once, not for each column.
        fits = (F.col("sid") > F.col("h")) & (F.col("label") != F.col("other")) & ~F.arrays_overlap("before", "before_h")
        if labels is not None:
            # What two rows with g in these places can have in common at most, against what their sizes ask.
            most = F.least("p", "ph") + 1 + F.least(F.col("c") - F.col("p"), F.col("ch") - F.col("ph")) - 1
            fits &= (100 + threshold) * most >= threshold * (F.col("n") + F.col("nh"))
            # 1 - Jaccard is a metric: rows whose distances from one row differ by more than a link's are no link.
            fits &= (F.col("pivot") != F.col("pivot_h")) | (F.abs(F.col("far") - F.col("far_h")) <= 1 - threshold / 100 + 1e-9)
        pairs = entries.join(hubs, "g").where(fits).select("h", "nh", "sid", "n").distinct()
        drawn = materialize(pairs, "jaccard-pairs")
        pairs = drawn.join(live.select("sid", F.col("grams").alias("mine")), "sid")
        pairs = pairs.join(live.select(F.col("sid").alias("h"), F.col("grams").alias("theirs")), "h")
        both = F.size(F.array_intersect("mine", "theirs"))
        tested = materialize(pairs.select("h", "sid", "n", "nh", both.alias("both")), "jaccard-tested")
        discard(drawn)
        spent += [hubs, tested]
        links = tested.where(100 * F.col("both") >= threshold * (F.col("n") + F.col("nh") - F.col("both"))).select(F.col("sid").alias("a"), F.col("h").alias("b"))
        entries = entries.join(hubs.select("g", F.col("h").alias("sid")), ["g", "sid"], "left_anti")
        if labels is None:
            # The first round's distances: each row's from the least row that it was multiplied with.
            far = F.lit(1.0) - F.col("both") / (F.col("n") + F.col("nh") - F.col("both"))
            pivots = tested.groupBy("sid").agg(F.min(F.struct(F.col("h"), far.alias("far"))).alias("at"))
            pivots = materialize(pivots.select(F.col("sid").alias("of"), F.col("at.h").alias("pivot"), F.col("at.far").alias("far")), "jaccard-pivots")
            spent.append(pivots)
            entries = entries.drop("pivot", "far").join(pivots, F.col("sid") == F.col("of"), "left").drop("of")
            entries = entries.withColumns({"far": F.coalesce("far", F.lit(0.0)), "pivot": F.coalesce("pivot", own)})
        if labels is None or not links.isEmpty():
            known = links if labels is None else links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
            labels = _connected(known, "jaccard-components")
            entries = entries.drop("label").join(labels, F.col("sid") == F.col("node"), "left").drop("node").withColumn("label", F.coalesce("label", own))
        block *= GROWTH
        cleared(live.sparkSession)


def _classes(docs: DataFrame, n: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, n_shingles, s1, s2) and, for each distinct set (n_shingles, s1, s2), its component ``class`` and least doc_id."""
    text_batches(docs.sparkSession)
    rows = docs.select("row", "doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64("doc_id").alias("of"))
    schema = extended(rows.drop("text").schema, n_shingles="long", s1="long", s2="long", grams=T.ArrayType(T.LongType()))
    wide = materialize(rows.mapInArrow(_sets(n, threshold), schema), "jaccard-prefixes")
    rows = materialize(wide.drop("grams"), "jaccard-rows")
    sets = rows.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min(F.struct("row", "t1", "of")).alias("at"), F.min("doc_id").alias("least"))
    sets = materialize(sets.select("n_shingles", "s1", "s2", "least", F.col("at.row").alias("sid"), "at.t1", "at.of"), "jaccard-classes")
    labels = _labels(_live(docs, sets, wide, n, threshold), threshold)
    classes = sets.join(labels, F.col("sid") == F.col("node"), "left").select("n_shingles", "s1", "s2", "least", F.coalesce("label", "sid").alias("class"))
    return rows.drop("t1", "of"), materialize(classes, "jaccard-classes")


def components(docs: DataFrame, n: int = 5, threshold: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked, itself included) of every row of (doc_id, text)."""
    rows, classes = _classes(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), n, threshold)
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = materialize(classes.join(least, "class").select("n_shingles", "s1", "s2", "component_id"), "jaccard-ids")
    out = rows.join(named, ["n_shingles", "s1", "s2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, threshold: int = 75) -> DataFrame:
    """``docs`` without all but one row of each component: the one of smallest doc_id (null ids last), or the first of equal ids.

    Rows are told apart by themselves, not by doc_id: ids may repeat or lack. Rows without words stay.
    """
    docs, row = numbered(docs, "jaccard-docs")
    rows, classes = _classes(docs.select(F.col(row).alias("row"), "doc_id", "text"), n, threshold)
    member = materialize(rows.where("n_shingles > 0").join(classes.drop("least"), ["n_shingles", "s1", "s2"]).select("row", "doc_id", "class"), "jaccard-members")
    stays = member.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    gone = member.select("row").join(stays.select("row"), "row", "left_anti")
    return docs.join(gone, docs[row] == gone["row"], "left_anti").drop(row)
