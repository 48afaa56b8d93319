"""Language identification with string kernels.

A text is the set of its byte n-grams of orders 1 to 3, hashed (blended spectrum, presence), after A-Z are lower-cased
and every run of other ASCII bytes becomes one space. The kernel of two texts is the size of the sets' intersection over
the geometric mean of their sizes. A Nystroem map over landmark texts turns it into features, on which one ridge
regression per language is fitted (+1 for the language, -1 for the rest). All texts are scored in blocks: presence
matrix times landmarks times coefficients. The prediction is the language with the largest output r; score is
(r + 1) / 2, held within 0 and 1.

Learning uses at most `per_language` texts of each language; landmarks are an even share of these. Null texts and texts
without a letter get `und` and score 0, as does every text if nothing could be learned. Ties go to the language that
sorts first. Repeated rows are judged each; a null doc_id is held out; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, slices, small_batches, text_bytes
from .sampling import labelled_sample

SLOTS = 1 << 14
PER_LANGUAGE = 500
LANDMARKS = 128
BLOCK = 64
#: Lower case for A-Z, a space for the other ASCII bytes.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[:128] = 32
FOLDED[97:123] = np.arange(97, 123)
FOLDED[65:91] = np.arange(97, 123)
MULTIPLIERS = (2654435761, 2246822519, 3266489917)


class Model(NamedTuple):
    languages: list[str]
    landmarks: np.ndarray  # SLOTS x m, columns of length 1
    coefficients: np.ndarray  # m x languages


def presence(b: np.ndarray) -> np.ndarray:
    """Which slots the n-grams of a text's bytes fall in."""
    b = FOLDED[b]
    if len(b) > 1:
        blank = b == 32
        b = b[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    out = np.zeros(SLOTS, bool)
    gram = b.astype(np.uint32)
    for n, m in enumerate(MULTIPLIERS):
        if n:
            gram = (gram[:-1] << np.uint32(8)) | b[n:]
        out[(gram * np.uint32(m)) >> np.uint32(18)] = True
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence_rows(sample: DataFrame) -> DataFrame:
    """(label, bits): the presence of each text's n-grams, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "text"):
            raw, off = text_bytes(s.column(0))
            bits = [np.packbits(presence(raw[off[i] : off[i + 1]])).tobytes() for i in range(s.num_rows)]
            yield pa.RecordBatch.from_arrays([s.column(1), pa.array(bits, pa.binary())], names=["label", "bits"])

    return sample.select("text", "label").mapInArrow(run, "label string, bits binary")


def unit_rows(bits: list[bytes]) -> np.ndarray:
    """Packed presences as rows of length 1: 64 KB each, so few at a time."""
    x = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8)).reshape(len(bits), SLOTS).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = 1e-2) -> Model | None:
    """Learns from the rows of docs whose fold is not 0. At most per_language rows of 2 KB come to the driver for each language."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs.filter(fold("doc_id") != 0), F.col("lang"), F.col("doc_id"), per_language)
    rows = sorted((r["label"], bytes(r["bits"])) for r in presence_rows(sample).collect())
    if not rows:
        return None
    names = sorted({r[0] for r in rows})
    y = np.array([[1.0 if r[0] == name else -1.0 for name in names] for r in rows])
    share = max(1, landmarks // len(names))
    chosen = np.concatenate([np.flatnonzero(y[:, k] > 0)[np.linspace(0, (y[:, k] > 0).sum() - 1, min(share, int((y[:, k] > 0).sum()))).astype(int)] for k in range(len(names))])
    land = unit_rows([rows[i][1] for i in chosen])
    values, vectors = np.linalg.eigh((land @ land.T).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.concatenate([unit_rows([r[1] for r in rows[i : i + BLOCK]]) @ land.T for i in range(0, len(rows), BLOCK)]) @ root
    w = np.linalg.solve(phi.T @ phi + ridge * len(rows) / 100 * np.eye(phi.shape[1]), phi.T @ y)
    return Model(names, np.ascontiguousarray(land.T), (root @ w).astype(np.float32))


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of docs: the columns named in `keep` (doc_id if none are), lang_pred and score."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    keep = [doc_id] if keep is None else keep
    df = docs.select(F.col(text).cast("string").alias("__text"), *keep)
    schema = df.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for s in slices(batches, "__text"):
            raw, off = text_bytes(s.column(0))
            texts = s.column(0).to_pylist()
            lang, score = np.full(s.num_rows, "und", object), np.zeros(s.num_rows)
            own = np.array([has_letter(t) for t in texts], bool)
            at = np.flatnonzero(own) if m is not None else np.zeros(0, int)
            for first in range(0, len(at), BLOCK):
                part = at[first : first + BLOCK]
                p = np.stack([presence(raw[off[i] : off[i + 1]]) for i in part]).astype(np.float32)
                k = (p @ m.landmarks) / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))
                r = k @ m.coefficients
                best = r.argmax(1)
                lang[part] = np.array(m.languages, object)[best]
                score[part] = np.clip((r[np.arange(len(part)), best] + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([*s.columns[1:], pa.array(lang, pa.string()), pa.array(score)], names=[*s.schema.names[1:], "lang_pred", "score"])

    return df.mapInArrow(run, schema)
