"""Exact top-k search by exhaustive term-at-a-time accumulation.

Components are quantised to floor(scale * x). A task turns its candidates into postings (for each term, the candidates
with a weight other than 0, and the weights); sparse query rows scatter their weighted postings into dense score arrays;
partition selection keeps the k best of each block, and the merged selections give the answer.

Defined results: vectors that are null or hold null or non-finite components take no part, as query or as candidate.
A shorter vector has no weight in the terms it lacks. Candidates are all rows with another vec_id than the query's; ties
go to the smaller vec_id, and rows repeated under one vec_id are candidates each. A query repeated under one vec_id is
asked once (the smallest vector that takes part). Scores past 64 bits saturate. Null vec_ids are no queries and no candidates.
Very long vectors are terms as others; a task holds 1024 candidates at a time. Empty tables give no rows, and other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import materialize

_LONG = (1 << 63) - 1


def quantise(vectors: list[list[float] | None], scale: float = 256) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their floor(scale * x) as int64 (object where that could overflow), padded with 0."""
    fit = [i for i, v in enumerate(vectors) if v is not None and None not in v and np.isfinite(np.asarray(v, np.float64)).all()]
    width = max((len(vectors[i]) for i in fit), default=0)
    x = np.zeros((len(fit), width))
    for row, i in enumerate(fit):
        x[row, : len(vectors[i])] = vectors[i]
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * x)
    scaled = np.clip(scaled, -np.finfo(float).max, np.finfo(float).max)
    big = scaled.size and np.abs(scaled).max() >= 1 << 28
    return np.array(fit, int), np.array([[int(c) for c in r] for r in scaled], object).reshape(scaled.shape) if big else scaled.astype(np.int64)


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores (queries x candidates), term at a time over the candidates' postings."""
    kind = np.int64 if queries.dtype == candidates.dtype == np.int64 else object
    scores = np.zeros((len(queries), len(candidates)), kind)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        asking = np.flatnonzero(queries[:, term])
        posting = np.flatnonzero(candidates[:, term])
        if len(asking) == len(queries) and len(posting) == len(candidates):
            scores += queries[:, term, None] * candidates[None, :, term]
        elif len(asking) and len(posting):
            scores[np.ix_(asking, posting)] += queries[asking, term, None] * candidates[None, posting, term]
    return scores


def select(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query: (query row, candidate row, score); ties to the smaller id."""
    rows, cols, kept = [], [], []
    for q in range(len(scores)):
        s = scores[q]
        others = np.flatnonzero(ids != query_ids[q])
        if len(others) > k:
            s_others = s[others]
            floor = np.partition(s_others, len(others) - k)[len(others) - k]
            others = others[s_others >= floor]
        best = others[np.lexsort((ids[others], -s[others]))[:k]]
        rows += [q] * len(best)
        cols += best.tolist()
        kept += s[best].tolist()
    return np.array(rows, int), np.array(cols, int), np.clip(np.array(kept, object), -_LONG - 1, _LONG)


def search(candidates: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256, block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. Both sides are rows (vec_id, embedding).

    Queries are answered in blocks of about ``block`` rows; a block is what is broadcast (at most some MB, whatever
    the data), and with several blocks each one's answer is kept in the shared folder before the next is asked.
    """
    spark = candidates.sparkSession
    candidates = candidates.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null")
    queries = queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    # As quantise() does with candidates: an invalid row must not be the one that its vec_id is asked by.
    queries = queries.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = max(1, -(-queries.count() // block))
    found = []
    for b in range(blocks):
        asked = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()
        fit, matrix = quantise([r.embedding for r in asked], scale)
        shared = spark.sparkContext.broadcast((np.array([r.vec_id for r in asked], np.int64)[fit], matrix))
        answer = candidates.mapInArrow(_partial(shared, k, scale), "query_id long, vec_id long, score long")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        answer = answer.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found.append(materialize(answer, "topk") if blocks > 1 else answer)
    return reduce(DataFrame.union, found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _partial(shared, k: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fit, matrix = quantise(part.column("embedding").to_pylist(), scale)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False)[fit]
                if len(ids) and len(query_ids):
                    for first in range(0, len(query_ids), 1024):
                        q, c, s = select(accumulate(queries[first : first + 1024], matrix), query_ids[first : first + 1024], ids, k)
                        held.append((q + first, ids[c], s))
            if len(held) > 32:
                held = [_merge(held, k)]
        if held:
            q, ids, s = _merge(held, k)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(ids), pa.array([int(x) for x in s], pa.int64())], names=["query_id", "vec_id", "score"])

    return run


def _merge(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q, ids, s = (np.concatenate([h[i] for h in held]) for i in range(3))
    order = np.lexsort((ids, -s.astype(object) if s.dtype == object and any(abs(x) > 1 << 62 for x in s) else -s.astype(np.int64), q))
    q, ids, s = q[order], ids[order], s[order]
    start = np.searchsorted(q, q, "left")
    kept = np.arange(len(q)) - start < k
    return q[kept], ids[kept], s[kept]


def neighbours(embeddings: DataFrame, every: Column | int = 50, k: int = 5) -> DataFrame:
    """Rows whose vec_id is divisible by ``every`` against all rows."""
    rows = embeddings.select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % every == 0), k)
