"""Quality classifier: neighbours vote among labelled latent-semantic vectors.

Terms of a text are its byte trigrams, hashed, and terms that name its shape: tenths of repeated neighbouring words, of
words in repeated three-word windows, of symbols, of capitals and of distinct words, and the length class. Log counts
times inverse document frequency, at length 1, are projected by the singular vectors of the labelled sample. The sample's
vectors, a few thousand of RANK numbers, are broadcast; every document's cosines with all of them are computed in blocks,
and the NEIGHBOURS nearest vote with the SHARPNESS-th power of their cosine. score is the weighted share of label 1.

Learning uses at most `per_class` ids of either label, drawn from the labels by a hash. Null and empty texts score 0, as does everything if there is
nothing to learn from. Ties between neighbours go to the one that comes first in the sample. Repeated rows are scored
each; a null doc_id is held out; a doc_id with several labels is learned once for each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, fold, held_out, id_and_text, slices, small_batches, stored, text_bytes, words_of
from .quality_rules import SYMBOL, repeated_windows
from .sampling import labelled_sample

GRAMS = 1 << 12
SHAPES = 6
TENTHS = 11
TERMS = GRAMS + SHAPES * TENTHS
#: Count of a shape term: as heavy as a frequent trigram.
SHAPE_COUNT = 400.0
RANK = 64
PER_CLASS = 1500
NEIGHBOURS = 15
SHARPNESS = 8
BLOCK = 256


class Model(NamedTuple):
    idf: np.ndarray
    axes: np.ndarray  # TERMS x rank
    vectors: np.ndarray  # rank x sample
    labels: np.ndarray


def term_counts(texts: pa.Array) -> np.ndarray:
    """A row of term counts for each text."""
    w, raw, off = words_of(texts)
    n = len(off) - 1
    out = np.zeros((n, TERMS), np.float32)
    words = np.diff(w.first)
    size = np.maximum(words, 1)
    doc = w.doc()
    same = np.zeros(len(w.codes), bool)
    same[1:] = (w.codes[1:] == w.codes[:-1]) & (doc[1:] == doc[:-1])
    distinct = np.bincount(np.unique(doc * max(len(w.unique), 1) + w.codes) // max(len(w.unique), 1), minlength=n)
    upto = lambda mark: np.concatenate([[0], np.cumsum(mark)])
    inside = lambda mark: upto(mark)[off[1:]] - upto(mark)[off[:-1]]
    chars = np.maximum(inside(~SPACE[raw]), 1)
    shares = [np.bincount(doc[same], minlength=n) / size, repeated_windows(w.codes, w.first, max(len(w.unique), 1)) / size, 4 * inside(SYMBOL[raw] | (raw == 33)) / chars, inside((raw >= 65) & (raw <= 90)) / chars, distinct / size]
    for k, x in enumerate(shares):
        out[np.arange(n), GRAMS + k * TENTHS + np.minimum(10 * x, TENTHS - 1).astype(int)] = SHAPE_COUNT
    out[np.arange(n), GRAMS + 5 * TENTHS + np.minimum(np.log2(size), TENTHS - 1).astype(int)] = SHAPE_COUNT / 8
    wide = raw.astype(np.uint32)
    gram = ((wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]) * np.uint32(2654435761) >> np.uint32(20) if len(raw) > 2 else np.zeros(0, np.uint32)
    for i in range(n):
        if off[i + 1] - off[i] > 2:
            out[i, :GRAMS] = np.bincount(gram[off[i] : off[i + 1] - 2], minlength=GRAMS)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def count_rows(sample: DataFrame) -> DataFrame:
    """(label, counts) of each sampled text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "text"):
            rows = [x.tobytes() for x in term_counts(s.column(0)).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([s.column(1), pa.array(rows, pa.binary())], names=["label", "counts"])

    return sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(run, "label int, counts binary")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, rank: int = RANK) -> Model | None:
    """Learns from labelled rows whose fold is not 0. At most 2 * per_class rows of 17 KB come to the driver."""
    small_batches(docs.sparkSession)
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").cast("string").alias("text"), F.col("quality").alias("label")).distinct().filter(fold("text") != 0)
    # the sample is drawn from the labels, so that only its few ids meet the texts
    chosen = stored(labelled_sample(marks, F.col("label"), F.col("text"), per_class))
    own = id_and_text(docs).join(F.broadcast(chosen.select(F.col("text").cast("long").alias("doc_id"), "label")), "doc_id").filter("text <> ''")
    own = own.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # rows that repeat an id count once
    rows = sorted((bytes(r["counts"]), r["label"]) for r in count_rows(own).collect())
    if not rows:
        return None
    counts = np.stack([np.frombuffer(r[0], np.float32) for r in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    x = weighted(counts, idf)
    rank = min(rank, *x.shape)
    # singular vectors by the smaller Gram matrix
    values, left = np.linalg.eigh((x @ x.T).astype(float))
    axes = (x.T @ left[:, ::-1][:, :rank] / np.sqrt(np.maximum(values[::-1][:rank], 1e-9))).astype(np.float32)
    return Model(idf, axes, np.ascontiguousarray(_unit(x @ axes).T), np.array([r[1] for r in rows], np.float32))


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """The places of the k largest in each row; of equal ones at the edge the first."""
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    edge = np.take_along_axis(cosine, near, 1).min(1)
    for row in np.flatnonzero((cosine >= edge[:, None]).sum(1) > k):
        near[row] = np.argsort(-cosine[row], kind="stable")[:k]
    return near


def score(docs: DataFrame, model: Model | None, neighbours: int = NEIGHBOURS, cut: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for s in slices(batches, "text"):
            raw, off = text_bytes(s.column(1))
            out = np.zeros(s.num_rows)
            for first in range(0, s.num_rows if m is not None else 0, BLOCK):
                part = s.slice(first, BLOCK)
                cosine = _unit(weighted(term_counts(part.column(1)), m.idf) @ m.axes) @ m.vectors
                near = nearest(cosine, min(neighbours, cosine.shape[1]))
                vote = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** SHARPNESS + 1e-12
                out[first : first + part.num_rows] = (vote * m.labels[near]).sum(1) / vote.sum(1)
            out[np.diff(off) == 0] = 0
            out = np.clip(out, 0, 1)
            yield pa.RecordBatch.from_arrays([s.column(0), pa.array(out), pa.array((out >= cut).astype(np.int32))], names=["doc_id", "score", "predicted"])

    scored = id_and_text(docs, doc_id, text).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
