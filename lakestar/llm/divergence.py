"""Source divergence audit: how far the sources of a language lie apart, and which terms set a source off from its language.

Each language keeps the terms in at least ``min_docs`` of its documents. A group (language and source) gives each of them
p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), so p depends on the count and two numbers of the group alone, and a term
that two groups both lack adds the same f to their divergence. So only terms that one of them has are visited: the
divergence is V times the f of the two baselines, plus what each visited term differs by (``pairs``).

The terms of a group are ranked by radix selection (``largest``): rounds of distributed histograms over the bits of the
values find each group's kth value, and among the terms equal to it a histogram over one UTF-8 byte a round, at the first
byte in which they differ, finds the last term that is taken. No group's terms ever meet in one task.

Defined results: null text, lang and source are ''. A group without terms has its pairs, each V times a constant, and no
term rows; with V = 0 all pairs are 0. A language of one source has no pairs. Repeated rows count each, and as documents
each. Ties go to the UTF-8 smaller item. A very long text is read whole, in slices cut between words. Empty tables give
no rows; columns besides text, lang and source are ignored. Arithmetic is in whole numbers: decimals for p, whose products
pass 64 bits, longs for f, as p never passes SCALE + 1.
"""

from __future__ import annotations

import os.path
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.common import materialize

SCALE = 1_000_000_000
#: Bits of the largest f: f(p, q) is less than max(p, q), which is at most SCALE + 1.
BITS = 30
#: A-Z fall to lower case; what is neither a letter nor beyond ASCII separates.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GROUP = ["lang", "source"]


def _terms(text: str, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The terms of a text, in slices of about ``size`` bytes that are cut between terms."""
    data, at = text.encode("utf-8", "replace").translate(_TERMS), 0
    while len(data) - at > size:
        cut = data.find(b" ", at + size)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split()


def term_counts(docs: DataFrame, held: int = 150_000) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents), in parts: a task sums up to ``held`` terms before it sends them.

    Each group is there with a null term once a task at least.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter] = defaultdict(Counter)
        d: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def flush() -> pa.RecordBatch:
            rows = [(*group, term, k, d[group][term]) for group, found in n.items() for term, k in found.items()] + [(*group, None, 0, 0) for group in n]
            n.clear()
            d.clear()
            lang, source, term, k, docs = zip(*rows, strict=True) if rows else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(k, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "d"])

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                seen: set[bytes] = set()
                for words in _terms(text):
                    n[lang, source].update(words)
                    seen.update(words)
                d[lang, source].update(seen)
            if sum(map(len, n.values())) > held:
                yield flush()
        yield flush()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text")).mapInArrow(count, "lang string, source string, term string, n long, d long")


def kept_terms(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """lang, source, term, n of the kept terms that a group has, with lang_n (the language's count) and head (once a term).

    Each group is there once more with a null term. All sums are made where one shuffle has dealt the terms to.
    """
    parts = term_counts(docs).repartition("lang", "term")
    whole = Window.partitionBy("lang", "term")
    rows = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    rows = rows.select("*", F.sum("n").over(whole).alias("lang_n"), F.sum("d").over(whole).alias("lang_d"), (F.row_number().over(whole.orderBy("source")) == 1).alias("head"))
    return rows.where((F.col("lang_d") >= min_docs) | F.col("term").isNull()).select("lang", "source", "term", "n", "lang_n", (F.col("head") & F.col("term").isNotNull()).alias("head"))


def _p(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 terms)), 1 without terms."""
    count, total, terms = (F.col(c) if isinstance(c, str) else c for c in (count, total, terms))
    divisor = (total + 2 * terms).cast("decimal(38,0)")
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(20,0)") * (count + 2).cast("decimal(18,0)"), divisor)
    return F.when(terms > 0, whole + 1).otherwise(F.lit(1)).cast("long")


def _f(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups(kept: DataFrame) -> DataFrame:
    """lang, source, place (of the source in its language), sources, total (N), terms (V), lang_total, lang_rows, base (p of no occurrence)."""
    mine, whole = kept.groupBy(*_GROUP).agg(F.sum("n").alias("total"), F.count_if("head").alias("heads"), F.count("term").alias("rows")), Window.partitionBy("lang")
    mine = mine.select(
        *_GROUP, "total", (F.row_number().over(whole.orderBy("source")) - 1).alias("place"), F.count("*").over(whole).alias("sources"),
        F.sum("heads").over(whole).alias("terms"), F.sum("total").over(whole).alias("lang_total"), F.sum("rows").over(whole).alias("lang_rows"),
    )
    return mine.withColumn("base", _p(F.lit(0), "total", "terms"))


def _pair_sums(tile: int):
    """Sums over one block of terms, for each two sources of a tile, of f less the f of both baselines."""

    def sums(block: pa.Table) -> pa.Table:
        place, p, base = (block.column(c).to_numpy() for c in ("place", "p", "base"))
        # A group's row without a term brings its baseline; it is in every block.
        real = block.column("term").is_valid().to_numpy()
        places, column = np.unique(place, return_inverse=True)
        bases = np.zeros(len(places), np.int64)
        bases[column] = base
        low, high, lang = block.column("low")[0].as_py(), block.column("high")[0].as_py(), block.column("lang")[0].as_py()
        row, terms = pd.factorize(block.column("term").filter(pa.array(real)).to_pandas())
        column, p = column[real], p[real]
        order = np.argsort(row, kind="stable")
        row, column, p = row[order], column[order], p[order]
        total = np.zeros((len(places), len(places)), np.int64)
        alone = (bases[:, None] - bases[None, :]) ** 2 // (bases[:, None] + bases[None, :])
        for first in range(0, len(terms), 2048):
            a, b = np.searchsorted(row, [first, first + 2048])
            seen = np.tile(bases[:, None], (1, min(2048, len(terms) - first)))
            seen[column[a:b], row[a:b] - first] = p[a:b]
            has = np.zeros(seen.shape, bool)
            has[column[a:b], row[a:b] - first] = True
            for i in range(len(places) - 1):
                q = seen[i + 1 :]
                found = (seen[i] - q) ** 2 // (seen[i] + q) - alone[i, i + 1 :, None]
                total[i, i + 1 :] += np.where(has[i] | has[i + 1 :], found, 0).sum(axis=1)
        i, j = np.triu_indices(len(places), 1)
        mine = (places[i] // tile == low) & (places[j] // tile == high)  # pairs inside a tile's halves have a tile of their own
        i, j = i[mine], j[mine]
        return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "low": pa.array(places[i], pa.int32()), "high": pa.array(places[j], pa.int32()), "more": pa.array(total[i, j], pa.int64())})

    return sums


def pairs(kept: DataFrame, known: DataFrame, tile: int = 64, block_rows: int = 16_384) -> DataFrame:
    """lang, source, item (another source of the language), value: the divergence of every two sources, in both orders.

    Sources are dealt into blocks of ``tile``, terms into buckets such that a bucket has about ``block_rows`` rows of two
    blocks of sources; each such part is a sparse matrix of its own, summed in numpy. A row goes to as many parts as its
    language has blocks of sources. Only sums leave the parts, never a row for each two sources that share a term.
    """
    blocks = F.ceil(F.col("sources") / tile).cast("int")
    rows = kept.join(known, _GROUP).select("lang", "term", "place", "base", _p("n", "total", "terms").alias("p"), blocks.alias("blocks"), (1 + F.floor(F.col("lang_rows") * 2 / F.greatest(blocks, F.lit(2)) / block_rows)).cast("int").alias("buckets"))
    mine = F.floor(F.col("place") / tile).cast("int")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = F.sequence(F.lit(0), F.col("buckets") - 1)
    one = F.array(F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int"))
    rows = rows.select("lang", "term", "place", "base", "p", F.least(mine, "other").alias("low"), F.greatest(mine, "other").alias("high"), F.explode(F.when(F.col("term").isNull(), every).otherwise(one)).alias("bucket"))
    sums = rows.groupBy("lang", "low", "high", "bucket").applyInArrow(_pair_sums(tile), "lang string, low int, high int, more long")
    sums = sums.groupBy("lang", "low", "high").agg(F.sum("more").alias("more"))
    one, two = (known.select("lang", F.col("source").alias(s), F.col("place").alias(f"{s}_place"), F.col("base").alias(f"{s}_base"), *more) for s, more in (("source", ["terms"]), ("item", [])))
    # Every two sources of a language are rows of the result.
    both = one.join(two, "lang").where("source <> item").select("*", F.least("source_place", "item_place").alias("low"), F.greatest("source_place", "item_place").alias("high"))
    value = F.coalesce("more", F.lit(0)) + F.col("terms") * _f("source_base", "item_base")
    return both.join(sums, ["lang", "low", "high"], "left").select(*_GROUP, "item", value.cast("long").alias("value"))


@F.pandas_udf(T.IntegerType())
def _common_bytes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Bytes that two strings begin with alike."""
    return pd.Series([len(os.path.commonprefix([x.encode("utf-8", "replace"), y.encode("utf-8", "replace")])) for x, y in zip(a, b, strict=True)], dtype="int32")


def _crossing(histogram: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of each group's bins, in order, the one in which the running count reaches ``left``, or the last; left: what it is short of before."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    rest = F.col("left") - F.coalesce(upto, F.lit(0))
    last = F.lead("bin").over(Window.partitionBy(*keys).orderBy(order)).isNull()
    return histogram.withColumn("rest", rest).withColumn("last", last).where((F.col("rest") > 0) & ((F.col("rest") <= F.col("n")) | F.col("last"))).select(*keys, "bin", "n", F.col("rest").alias("left"))


def largest(rows: DataFrame, keys: list[str], value: str, item: str, k: int, bits: int = BITS, digit: int = 10) -> DataFrame:
    """Of each group the k rows (written ``rows``) of largest value, equal ones by UTF-8 smaller item; values from 0, below 2^bits.

    A round is a histogram of at most 2^digit bins a group over the rows that share the bits found so far. Then the
    items equal to the kth value are told apart, a byte a round, at the first byte where those left differ.
    """
    found = None
    for shift in range(bits - digit, -digit, -digit):
        shift = max(shift, 0)
        here = F.shiftright(F.col(value), shift)
        if found is None:
            bins = rows.groupBy(*keys, here.alias("bin")).agg(F.count("*").alias("n")).withColumn("left", F.lit(k).cast("long"))
        else:
            # Null-safe keys aren't needed: keys are never null here.
            bins = rows.join(found, keys).where(F.shiftright(F.col(value), width) == F.col("prefix")).groupBy(*keys, "left", here.alias("bin")).agg(F.count("*").alias("n"))
        found = materialize(_crossing(bins, keys, F.desc("bin")).select(*keys, F.col("bin").alias("prefix"), "n", "left"), "radix")
        width = shift
    at = rows.join(found, keys)
    out = [at.where((F.col(value) > F.col("prefix")) | (F.col(value) == F.col("prefix")) & (F.col("n") <= F.col("left"))).select(*rows.columns)]
    tied = materialize(at.where((F.col(value) == F.col("prefix")) & (F.col("n") > F.col("left"))).select(*rows.columns, "left"), "radix-ties")
    while not tied.isEmpty():
        ends = tied.groupBy(*keys).agg(F.min(item).alias("first"), F.max(item).alias("final"), F.count("*").alias("n"))
        # Equal items to the end are one item in several rows: any of them will do.
        depth = tied.join(ends.select(*keys, "n", (F.col("first") == F.col("final")).alias("alike"), _common_bytes("first", "final").alias("depth")), keys)
        byte = F.hex(F.expr(f"substring(cast(`{item}` as binary), depth + 1, 1)"))
        depth = materialize(depth.select(*rows.columns, "left", "alike", byte.alias("bin")), "radix-bytes")
        same = Window.partitionBy(*keys).orderBy(item)
        out.append(depth.where("alike").withColumn("n", F.row_number().over(same)).where("n <= left").select(*rows.columns))
        apart = depth.where("not alike")
        ends = _crossing(apart.groupBy(*keys, "left", "bin").agg(F.count("*").alias("n")), keys, F.asc("bin")).select(*keys, F.col("bin").alias("edge"), F.col("n").alias("edge_n"), F.col("left").alias("edge_left"))
        apart = apart.join(ends, keys)
        whole = F.col("edge_n") <= F.col("edge_left")
        out.append(apart.where((F.col("bin") < F.col("edge")) | (F.col("bin") == F.col("edge")) & whole).select(*rows.columns))
        tied = materialize(apart.where((F.col("bin") == F.col("edge")) & ~whole).select(*rows.columns, F.col("edge_left").alias("left")), "radix-ties")
    return reduce(DataFrame.unionByName, out)


def telling_terms(kept: DataFrame, known: DataFrame, k: int = 10) -> DataFrame:
    """lang, source, item, value: of each group the k terms it uses more than its language that add most to their divergence."""
    rows = kept.where("term is not null and n > 0").join(known, _GROUP)
    rows = rows.select(*_GROUP, F.col("term").alias("item"), _p("n", "total", "terms").alias("p"), _p("lang_n", "lang_total", "terms").alias("q")).where("p > q").select(*_GROUP, "item", _f("p", "q").alias("value"))
    return largest(materialize(rows, "divergence-terms"), _GROUP, "value", "item", k)


def audit(docs: DataFrame, min_docs: int = 10, k: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: of each group its divergence from each other source (pair) and k telling terms (term)."""
    kept = materialize(kept_terms(docs, min_docs), "divergence-kept")
    known = materialize(groups(kept), "divergence-groups")
    ranked = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    pair = materialize(pairs(kept, known).select(*_GROUP, F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank")), "divergence-pairs")
    term = telling_terms(kept, known, k).select(*_GROUP, F.lit("term").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return pair.unionByName(term)
