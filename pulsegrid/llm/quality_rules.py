"""Quality rules: counts of each text, and the log-likelihood ratio of its hashed word n-grams between two corpora.

Two multinomials over hashed word 1- and 2-grams: the trusted target (documents that `labels` marks as good) and the raw
corpus (all documents), both over whole texts and smoothed alike: each bucket of the raw corpus gets `smoothing` counts,
and each of the target the same times the target's share of the corpus, so that a bucket seen rarely has a ratio near 1. A
document's score is the sum of log(target / raw) over its n-grams, divided by their number; it is kept if the score reaches
the threshold and the base rules hold. The threshold is a constant at every size of the corpus.

Words are `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no words: all counts are 0, score 0, base_failed true. Repeated
rows are judged each; a null doc_id stays null and is never trusted; an empty table gives no rows; other columns are
ignored. Labels that repeat a doc_id count once, as good only if all of them say so. Without any trusted document the
ratio is 0 for every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, id_and_text, mix, slices, small_batches, small_side, stored, text_bytes, word_hashes, words_of

#: Hash buckets of the multinomials; both tables of counts are this long, whatever the corpus.
BUCKETS = 1 << 16
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Log-likelihood ratio per n-gram below which a document goes.
THRESHOLD = -0.06
SMOOTHING = 100.0
#: `[#*$%&|<>]`
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
FAR = np.uint64(0x9E3779B97F4A7C15)


def buckets(unique: pa.Array, codes: np.ndarray, first: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of all texts, words first within a text's own order, and the text of each."""
    h = word_hashes(unique)[codes] if len(codes) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    one = h % np.uint64(n_buckets)
    pair = doc[1:] == doc[:-1] if len(doc) else np.zeros(0, bool)
    two = mix(h[:-1] * FAR + h[1:])[pair] % np.uint64(n_buckets) if len(doc) else one
    return np.concatenate([one, two]).astype(np.int64), np.concatenate([doc, doc[:-1][pair]])


def ngram_counts(docs: DataFrame, n_buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target) over all documents; docs has text and a boolean `trusted`. Each task sums its own first."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
        for s in slices(batches, "text"):
            w, _, _ = words_of(s.column(0))
            b, doc = buckets(w.unique, w.codes, w.first, n_buckets)
            trusted = s.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            raw += np.bincount(b, minlength=n_buckets)
            target += np.bincount(b[trusted[doc]], minlength=n_buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, raw[at], target[at])], names=["bucket", "raw", "target"])

    parts = docs.select("text", "trusted").mapInArrow(run, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, n_buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log(target / raw) of every bucket. At most n_buckets rows come to the driver."""
    got = counts.toPandas()
    raw, target = np.zeros(n_buckets), np.zeros(n_buckets)
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    if not target.sum():
        return np.zeros(n_buckets)
    own = smoothing * target.sum() / raw.sum()
    return np.log((target + own) / (target.sum() + own * n_buckets)) - np.log((raw + smoothing) / (raw.sum() + smoothing * n_buckets))


def repeated_windows(codes: np.ndarray, first: np.ndarray, n_unique: int, n: int = 3) -> np.ndarray:
    """Of each text, how many words are in windows of n words that it holds twice or more, the first of them included. Exact: windows are ranked, not hashed."""
    total, size = len(codes), np.diff(first)
    covered = np.zeros(total + 1, np.int64)
    if total >= n:
        doc = np.repeat(np.arange(len(size)), size)
        start = np.flatnonzero(doc[: total - n + 1] == doc[n - 1 :])
        rank, base = codes[start], n_unique
        for k in range(1, n):
            key = rank * n_unique + codes[start + k]
            if base * n_unique >= 1 << 62:
                raise OverflowError("too many words in a slice")
            if k < n - 1:
                _, rank = np.unique(key, return_inverse=True)
                base = len(rank)
        bits = int(doc[-1]).bit_length() if len(doc) else 0
        if int(key.max(initial=0)).bit_length() + bits > 62:
            _, key = np.unique(key, return_inverse=True)
        key = doc[start] * (int(key.max(initial=0)) + 1) + key
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = start[twice]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + n, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return inside[first[1:]] - inside[first[:-1]]


def duplicate_lines(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Of each text, the \\n-split lines with a word that equal an earlier line of it."""
    n = len(off) - 1
    feed = np.flatnonzero(raw == 10)
    # an empty line at a text's end and an empty text begin where the next text does: one start is enough
    start = np.unique(np.concatenate([off[:-1], feed + 1]))
    start = start[start < len(raw)]
    doc = np.searchsorted(off[1:], start, side="right")
    end = np.minimum(np.append(start[1:], len(raw)), off[doc + 1])
    end = np.where((end > start) & (raw[np.maximum(end - 1, 0)] == 10), end - 1, end) if len(raw) else end
    words = np.concatenate([[0], np.cumsum(~SPACE[raw])])
    has = words[end] > words[start]
    start, end, doc = start[has], end[has], doc[has]
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    keep = np.cumsum(edge[:-1]) > 0
    data = np.ascontiguousarray(raw[keep])
    o = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(o), pa.py_buffer(data)]).dictionary_encode()
    key = doc * max(len(lines.dictionary), 1) + lines.indices.to_numpy(zero_copy_only=False)
    _, at = np.unique(key, return_index=True)
    return np.bincount(doc, minlength=n) - np.bincount(doc[at], minlength=n)


def score(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr and kept."""
    spark = docs.sparkSession
    small_batches(spark)
    shared, n_buckets = spark.sparkContext.broadcast(ratios), len(ratios)
    ints = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for s in slices(batches, "text"):
            w, raw, off = words_of(s.column(1))
            n = np.diff(w.first)
            chars = np.concatenate([[0], np.cumsum(((raw & 0xC0) != 0x80) & ~SPACE[raw])])
            marks = np.concatenate([[0], np.cumsum(SYMBOL[raw])])
            repeat = repeated_windows(w.codes, w.first, max(len(w.unique), 1))
            b, doc = buckets(w.unique, w.codes, w.first, n_buckets)
            llr = np.bincount(doc, weights=ratio[b], minlength=len(n)) / np.maximum(np.bincount(doc, minlength=len(n)), 1)
            failed = (n < min_words) | (100 * repeat > max_repeat_percent * n)
            cols = [n, chars[off[1:]] - chars[off[:-1]], marks[off[1:]] - marks[off[:-1]], duplicate_lines(raw, off), repeat]
            yield pa.RecordBatch.from_arrays([s.column(0), *(pa.array(x.astype(np.int64)) for x in cols), pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= threshold))], names=["doc_id", *ints, "base_failed", "llr", "kept"])

    return id_and_text(docs, doc_id, text).mapInArrow(run, "doc_id long, " + "".join(f"{c} long, " for c in ints) + "base_failed boolean, llr double, kept boolean")


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, trusted): a document that has labels is trusted if all of them say quality 1."""
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good"))
    return id_and_text(docs).join(small_side(stored(good.filter("good = 1"))), "doc_id", "left").select("text", F.col("good").isNotNull().alias("trusted"))
