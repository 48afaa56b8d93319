"""Best-fit packing of token sequences: documents become pieces, pieces share sequences under several capacities.

Two steps. `pieces` tokenizes whole documents where they lie and cuts only those longer than a sequence. `pack` deals
the pieces' few numbers (never their ids) into groups of about GROUP_PIECES and fills sequences group by group with a
vector best fit: pieces by falling length, each into the open sequence that, of those where every capacity holds,
leaves the least weighted residual norm ("norm") or has the largest weighted dot product of residual and need ("dot").
A group ends with at most one badly filled sequence, so the loss is about one in GROUP_PIECES / 3.

Nulls and empty texts are documents of one end token; repeated rows are packed like others; a null doc_id stays null;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, small_batches, stored

GROUP_PIECES = 20_000


class Capacity(NamedTuple):
    """Of one sequence: tokens, documents, and attention cost as the sum of squared piece lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 0, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit ids), and ids if asked for."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_ids import WordBpe

        bpe = WordBpe(tokenizer)
        end = np.array([end_id], "<u4")
        for s in slices(batches, "text"):
            ids, off = bpe.encode(s.column(1))
            ids = ids.astype("<u4")
            doc, piece, start, length, crc, own = [], [], [], [], [], []
            for i in range(s.num_rows):
                x = np.concatenate([ids[off[i] : off[i + 1]], end])
                for k, a in enumerate(range(0, len(x), max_tokens)):
                    part = x[a : a + max_tokens]
                    doc.append(i), piece.append(k), start.append(a), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        own.append(part.astype(np.int32))
            cols = [s.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(own, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return id_and_text(docs, doc_id, text).mapInArrow(run, schema)


def best_fit(length: np.ndarray, capacity: Capacity = Capacity(), weights: tuple[float, float, float] = (1.0, 0.25, 0.25), rule: str = "norm") -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of every piece, and the number of sequences. Ties: the earlier piece, the earlier sequence."""
    n = len(length)
    bins, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    cap = np.array(capacity, float)
    left_t, left_d, left_a = (np.zeros(n) for _ in range(3))
    w = np.array(weights)
    whole = length >= capacity.tokens
    opened = int(whole.sum())
    bins[whole] = np.arange(opened)
    order = np.argsort(-length, kind="stable")
    order = order[~whole[order]]
    least = length[order].min() if len(order) else 0
    live = np.zeros(0, np.int64)
    for k, i in enumerate(order):
        t = float(length[i])
        if k % 256 == 0 and len(live):
            live = live[left_t[live] >= least]
        lt = left_t[live]
        ok = live[(lt >= t) & (left_d[live] >= 1) & (left_a[live] >= t * t)]
        if len(ok):
            a, d, c = left_t[ok] / cap[0], left_d[ok] / cap[1], left_a[ok] / cap[2]
            if rule == "dot":
                b = ok[np.argmax(w[0] * a * t / cap[0] + w[1] * d / cap[1] + w[2] * c * t * t / cap[2])]
            else:
                b = ok[np.argmin(w[0] * (a - t / cap[0]) ** 2 + w[1] * (d - 1 / cap[1]) ** 2 + w[2] * (c - t * t / cap[2]) ** 2)]
        else:
            b = opened
            opened += 1
            left_t[b], left_d[b], left_a[b] = cap
            live = np.append(live, b)
        bins[i], offset[i] = b, int(cap[0] - left_t[b])
        left_t[b] -= t
        left_d[b] -= 1
        left_a[b] -= t * t
    return bins, offset, opened


def pack(parts: DataFrame, capacity: Capacity = Capacity(), weights: tuple[float, float, float] = (1.0, 0.25, 0.25), rule: str = "norm", group: int = GROUP_PIECES) -> DataFrame:
    """The rows of `parts` (length at most capacity.tokens) with sequence_id and offset. `parts` is written once, to count it."""
    spark = parts.sparkSession
    parts = stored(parts)
    n = parts.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        count = 0

        def fill() -> pa.Table:
            nonlocal base
            t = pa.Table.from_batches(held).combine_chunks()
            b, o, opened = best_fit(t.column("length").to_numpy(), capacity, weights, rule)
            t = t.append_column("sequence_id", pa.array(b + base, pa.int64())).append_column("offset", pa.array(o, pa.int64()))
            base += opened
            return t

        for x in batches:
            held.append(x)
            count += x.num_rows
            if count >= group:
                yield from fill().to_batches()
                held, count = [], 0
        if count:
            yield from fill().to_batches()

    out = parts.schema.add("sequence_id", "long").add("offset", "long")
    return parts.repartition(max(1, -(-n // group))).mapInArrow(run, out) if n else spark.createDataFrame([], out)


def sequences(packed: DataFrame) -> DataFrame:
    """From packed pieces with ids: one row per sequence, its ids in order of offset and where each document begins."""
    order = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(order.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
