"""What the text operators share: tables, the shared work folder, bounded Arrow slices and word offsets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from pulsegrid.sources.tables import shared_folder as work_dir

#: Text bytes that one step of a Python task holds at a time; a single longer text is a step of its own.
SLICE_BYTES = 4 << 20
#: Rows that Spark sends to a Python task at once.
BATCH_ROWS = 512
FOLDS = 5
#: `[\x20\x09-\x0D]`
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A side of at most so many bytes may be broadcast.
BROADCAST_BYTES = 64 << 20


def _bytes(c: Column, t: DataType) -> Column:
    if isinstance(t, StringType | BinaryType):
        return 24 + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(t, StructType):
        return reduce(Column.__add__, [_bytes(c[f.name], f.dataType) for f in t.fields], F.lit(16))
    if isinstance(t, ArrayType):
        return 32 + F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + _bytes(x, t.elementType)), F.lit(0))
    return F.lit(1024 if isinstance(t, MapType) else 16)


def row_bytes(df: DataFrame) -> Column:
    """About how much memory a row of df takes."""
    return reduce(Column.__add__, [_bytes(F.col(f"`{f.name}`"), f.dataType).cast("long") for f in df.schema.fields], F.lit(16))


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df (stored, as it is read here), marked for broadcast if all its rows are counted to take at most `limit` bytes; else left to the optimizer's shuffled joins."""
    return F.broadcast(df) if (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= limit else df


def small_batches(spark: SparkSession) -> None:
    """Long texts make large Arrow batches; fewer rows in each bound a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, mod 5; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def held_out(doc_id: Column | str) -> Column:
    return fold(doc_id) == 0


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts after one another, and where each begins; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, where, data = texts.buffers()
    off = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice has at most `limit` bytes of text or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        _, off = text_bytes(batch.column(at))
        first = 0
        while first < batch.num_rows:
            end = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
            yield batch.slice(first, end - first)
            first = end


class Words(NamedTuple):
    """codes[k] is the k-th word's place in `unique`; the words of text i are first[i]..first[i + 1]."""

    codes: np.ndarray
    unique: pa.Array
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(raw: np.ndarray, off: np.ndarray, keep: np.ndarray, cut: np.ndarray | None = None) -> Words:
    """Words are runs of the bytes where `keep` is true, within a text; a word also ends where `cut` is true."""
    n = len(raw)
    first = np.zeros(n + 1, bool)
    if n:
        first[1:n] = ~keep[:-1]
        first[off[:-1][off[:-1] < n]] = True
        if cut is not None:
            first[:n] |= cut
    starts = np.flatnonzero(first[:n] & keep)
    where = np.cumsum(keep)
    lens = np.diff(np.append(where[starts] - 1, where[-1] if n else 0)) if len(starts) else np.zeros(0, np.int64)
    ends = starts + lens
    data = np.ascontiguousarray(raw[keep]) if n else raw
    o = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(o), pa.py_buffer(data)).dictionary_encode()
    at = np.searchsorted(starts, off)
    return Words(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary, at, starts, ends)


def words_of(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of every text, with the bytes and offsets they come from."""
    raw, off = text_bytes(texts)
    return split_words(raw, off, ~SPACE[raw]), raw, off


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(unique: pa.Array) -> np.ndarray:
    """64-bit hash of each word; the same everywhere."""
    import xxhash

    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w) for w in unique.cast(pa.large_binary()).to_pylist()), np.uint64, len(unique))


def ngram_hashes(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of n consecutive words within a text, and where each text's windows begin. A text of fewer words, but not none, is one window."""
    counts = np.diff(first)
    windows = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(windows)])
    pos = np.arange(start[-1]) - np.repeat(start[:-1] - first[:-1], windows)
    size = np.repeat(np.minimum(counts, n), windows)
    out = np.full(len(pos), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(n):
        there = k < size
        nxt = h[np.minimum(pos + k, max(len(h) - 1, 0))] if len(h) else out
        out = np.where(there, mix(out * np.uint64(3) + nxt + np.uint64(k)), out)
    return out, start


def with_new_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array | np.ndarray | list], schema: pa.Schema) -> pa.RecordBatch:
    cols = [batch.column(batch.schema.get_field_index(k)) for k in keep] + list(new.values())
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) and c.type == f.type else (c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)) for c, f in zip(cols, schema, strict=True)], schema=schema)


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns, whatever else the table has; a missing text column counts as null texts."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.col(text).cast("string") if text in docs.columns else F.lit(None).cast("string")).alias("text"))


def plainly(docs: DataFrame, own: set[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What step, which keeps the columns, makes of docs; meanwhile the columns that aren't in `own` have names that clash with nothing."""
    names = [c if c in own else f"other_column_{k}" for k, c in enumerate(docs.columns)]
    return step(docs.toDF(*names)).select(*names).toDF(*docs.columns)
