"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte 1- to 3-grams; each language has several centroids found by
spherical k-means, and a text takes the language of the centroid with the highest cosine. A text whose distance
(1 - cosine) from every centroid is beyond the radius for its length is rejected.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; ties go to the first
language by code point; with nothing to learn from, every text is ``und``. Repeated rows are predicted alike.
Only ``text`` and ``lang`` are learnt from; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import extended, fold, pieces, release, text_batches

#: Hashed n-gram features; a fixed size, so that the model is too.
FEATURES = 1 << 13
ORDERS = (1, 2, 3)
#: Lengths are told apart by powers of two of the number of letters, for the radius.
LENGTHS = 24
#: Bytes and rows of text that are counted at a time.
PIECE, ROWS, SLICE = 1 << 18, 64, 512
#: Texts of each language in the sample, however many languages there are.
LEAST = 20

_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class CentroidModel:
    """``centroids``: FEATURES x (languages * k), unit columns; ``radius``: the largest distance by length class."""

    languages: list[str]
    owner: np.ndarray
    idf: np.ndarray
    centroids: np.ndarray
    radius: np.ndarray


def counts(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term counts (rows x FEATURES) of whole texts, and the number of letters' bytes of each."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    data = _KEEP[data]
    space = data == 32
    doubled = np.zeros(len(data), bool)
    doubled[1:] = space[1:] & space[:-1] & (owner[1:] == owner[:-1])
    letters = np.bincount(owner[~space], minlength=n)
    data, owner = data[~doubled].astype(np.uint32), owner[~doubled]
    out = np.zeros(n * FEATURES, np.float32)
    code = data.copy()
    for order in ORDERS:
        if order > 1:
            if len(data) < order:
                break
            code = (code[:-1] << np.uint32(8)) | data[order - 1 :]
        same = owner[: len(code)] == owner[order - 1 :]
        bucket = ((code + np.uint32(order << 28)) * np.uint32(2654435761)) >> np.uint32(32 - 13)
        out += np.bincount((owner[: len(code)] * FEATURES + bucket)[same], minlength=n * FEATURES)
    return out.reshape(n, FEATURES), letters


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows; a row without terms stays zero."""
    x = np.log1p(found) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _length_class(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(int), LENGTHS - 1)


def _has_letter(text: str | None) -> bool:
    return text is not None and (any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text)))


def _lowered(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``pieces`` of the lower-cased texts, lowered SLICE rows at a time; what was freed goes back to the system."""
    for at in range(0, len(texts), SLICE):
        for first, offsets, data in pieces(pc.utf8_lower(texts.slice(at, SLICE)), PIECE, ROWS):
            yield at + first, offsets, data
    release()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    df, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for _, offsets, data in _lowered(batch.column("text")):
            found, _ = counts(offsets, data)
            df += (found > 0).sum(axis=0)
            n += len(found)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], names=["bucket", "n"])


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts from rows far from each other, the first nearest the mean, so reruns agree."""
    mean = x.mean(axis=0)
    chosen = [int(np.argmax(x @ mean))]
    best = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        # The median of the worst tenth: an outlier must not found a cluster.
        order = np.argsort(best, kind="stable")
        chosen.append(int(order[len(order) // 20]))
        best = np.maximum(best, x @ x[chosen[-1]])
    centroids = x[chosen]
    for _ in range(rounds):
        near = np.argmax(x @ centroids.T, axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else centroids[j] for j in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts of each text with a letter, as bytes of the terms (uint16) and of their counts (float32)."""
    for batch in batches:
        texts = batch.column("text")
        for first, offsets, data in _lowered(texts):
            found, letters = counts(offsets, data)
            rows = [i for i in range(len(letters)) if _has_letter(texts[first + i].as_py())]
            terms = [np.flatnonzero(found[i]) for i in rows]
            part = batch.slice(first, len(letters)).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("place"), pa.array(letters[rows], pa.int32()), pa.array([t.astype(np.uint16).tobytes() for t in terms], pa.binary()), pa.array([found[i][t].tobytes() for i, t in zip(rows, terms, strict=True)], pa.binary())], names=["lang", "place", "letters", "terms", "counts"])


def fit(train: DataFrame, k: int = 4, sample_per_language: int = 600, sample_total: int = 2400, quantile: float = 0.002, slack: float = 1.5) -> CentroidModel:
    """Learns from rows (doc_id, text, lang) with non-null text and lang.

    Document frequencies come from all rows. The centroids are fitted to a sample of at most ``sample_per_language``
    distinct texts of each language, ``sample_total`` in all (the documented bounds, but LEAST of each language; texts are
    chosen by a hash). Every language is learnt. ``radius`` is the distance which all but ``quantile`` of the sample of that length keep
    to, times ``slack``.
    """
    text_batches(train.sparkSession)
    train = train.select("text", "lang").where("text is not null and lang is not null")
    spread = train.select("text").mapInArrow(_document_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = {r.bucket: r.n for r in spread}
    total = df.pop(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([df.get(i, 0) for i in range(FEATURES)]))).astype(np.float32) + np.float32(1)
    per = {r.lang: r.n for r in train.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    if not per:
        return CentroidModel([], np.zeros(0, int), idf, np.zeros((FEATURES, 0), np.float32), np.full(LENGTHS, 2.0))
    sample_per_language = min(sample_per_language, max(LEAST, sample_total // len(per)))
    # Rows are thinned by a hash of their text at twice the rate that is needed; then each text counts once, and each
    # language is cut at its bound. What comes to the driver is sparse vectors of FEATURES terms at most, not texts.
    rates = train.sparkSession.createDataFrame([(lang, min(1 << 40, (2 * sample_per_language << 40) // max(n, 1))) for lang, n in per.items()], "lang string, rate long")
    place = F.xxhash64("text")
    rows = train.join(F.broadcast(rates), "lang").where(F.pmod(place, F.lit(1 << 40)) < F.col("rate"))
    rows = rows.select("lang", place.alias("place"), "text").mapInArrow(_sparse, "lang string, place long, letters int, terms binary, counts binary")
    rows = rows.dropDuplicates(["lang", "place"])
    rows = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("lang").orderBy("place"))).where(F.col("_rn") <= sample_per_language).drop("_rn").collect()
    rows.sort(key=lambda r: (r.lang, r.place))
    languages, owner, found, kept = sorted({r.lang for r in rows}), [], [], []
    for lang in languages:
        mine = [r for r in rows if r.lang == lang]
        dense = np.zeros((len(mine), FEATURES), np.float32)
        for i, r in enumerate(mine):
            dense[i, np.frombuffer(r.terms, np.uint16)] = np.frombuffer(r.counts, np.float32)
        x = vectors(dense, idf)
        found.append(_spherical_kmeans(x, k))
        owner += [languages.index(lang)] * len(found[-1])
        kept.append((x, np.array([r.letters for r in mine])))
    if not found:
        return CentroidModel([], np.zeros(0, int), idf, np.zeros((FEATURES, 0), np.float32), np.full(LENGTHS, 2.0))
    centroids = np.concatenate(found).T.astype(np.float32)
    far = np.concatenate([1 - (x @ centroids).max(axis=1) for x, _ in kept])
    length = np.concatenate([_length_class(n) for _, n in kept])
    radius = np.full(LENGTHS, 2.0)
    for j in range(LENGTHS):
        if (length == j).sum() >= 20:
            radius[j] = np.quantile(far[length == j], 1 - quantile) * slack
    # Shorter texts lie further away: never a smaller radius than that of longer ones.
    radius = np.maximum.accumulate(np.where(radius == 2.0, -1, radius)[::-1])[::-1]
    known = np.flatnonzero(radius > 0)
    if len(known):
        radius[: known[0]] = 2.0
        radius[known[-1] + 1 :] = radius[known[-1]]
    # Where the sample has no texts as short, nothing is known to reject them by.
    return CentroidModel(languages, np.array(owner), idf, centroids, np.where(radius <= 0, 2.0, radius))


def identify(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``docs`` (any columns, among them ``text``) plus lang_pred, score (cosine, 0 to 1), distance and rejected."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = [("lang_pred", pa.string()), ("score", pa.float64()), ("distance", pa.float64()), ("rejected", pa.bool_())]
    clash = [c for c in docs.columns if c in dict(extra)]
    docs = docs.drop(*clash)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what an earlier stage has left in this worker
        m = shared.value
        for batch in batches:
            texts = batch.column("text")
            best, lang, letters = np.zeros(len(texts)), np.zeros(len(texts), int), np.zeros(len(texts), int)
            if m.languages:
                for first, offsets, data in _lowered(texts):
                    found, n = counts(offsets, data)
                    cosine = vectors(found, m.idf) @ m.centroids
                    rows = slice(first, first + len(n))
                    best[rows], lang[rows], letters[rows] = cosine.max(axis=1), m.owner[cosine.argmax(axis=1)], n
            best = np.clip(best, 0, 1)
            und = np.array([not m.languages or not _has_letter(t) for t in texts.to_pylist()], bool)
            best[und] = 0
            rejected = und | (1 - best > m.radius[_length_class(letters)])
            names = [None if u else m.languages[j] for u, j in zip(und, lang, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x or "und" for x in names], pa.string()), pa.array(best), pa.array(1 - best), pa.array(rejected)],
                names=[*batch.schema.names, *(n for n, _ in extra)],
            )

    schema = extended(docs.schema, lang_pred="string", score="double", distance="double", rejected="boolean")
    return docs.mapInArrow(predict, schema)


def detect_languages(docs: DataFrame, folds: int = 5, **options) -> DataFrame:
    """Learns from all folds of ``docs`` but 0 and predicts every row: doc_id, held_out, lang_pred, score, distance, rejected.

    A row without a doc_id belongs to no fold: it is predicted, but not learnt from, and not held out.
    """
    model = fit(docs.where(fold("doc_id", folds) != 0).select("text", "lang"), **options)
    rows = docs.select("doc_id", "text", F.coalesce(fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"))
    return identify(rows, model).drop("text")
