"""Token counts by section or field: a document is encoded once, as a whole, and its tokens' spans are joined to the sections' spans.

A token that crosses a boundary goes, by the named rule, to the section of its first character ("first"), of its last
one ("last"), or to the one that holds most of its bytes, the earlier on a tie ("most"). So the counts of a document's
sections add up to the tokens of the whole text. Sections are the lines of the text, each with the line feed that ends
it; a text that ends in a line feed has no further section.

Null and empty texts have one section of no characters and no tokens; a null doc_id stays null; repeated rows are
counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, slices, small_batches, text_bytes

RULES = ("first", "last", "most")


def encoder(path: str, pattern: str):
    """A byte-level encoder from a file of ranks, and the length in bytes of each of its tokens."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for k, v in ranks.items():
        size[v] = len(k)
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size


def join_spans(starts: np.ndarray, token_end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Interval join on byte offsets: the section of each token, and whether it crosses a boundary. starts: of the sections, rising from 0."""
    token_start = np.concatenate([[0], token_end[:-1]]) if len(token_end) else token_end
    a = np.searchsorted(starts, token_start, side="right") - 1
    b = np.searchsorted(starts, token_end - 1, side="right") - 1
    cross = a != b
    if rule == "last":
        return b, cross
    if rule == "most" and cross.any():
        a = a.copy()
        ends = np.append(starts[1:], token_end[-1])
        for k in np.flatnonzero(cross):
            s = np.arange(a[k], b[k] + 1)
            held = np.minimum(ends[s], token_end[k]) - np.maximum(starts[s], token_start[k])
            a[k] = s[np.argmax(held)]
    return a, cross


def _counted(docs: DataFrame, tokenizer: str, pattern: str, rule: str, marks: str | None) -> DataFrame:
    """docs: doc_id, text and, if marks is named, an array of the byte offsets where sections begin."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, size = encoder(tokenizer, pattern)
        for s in slices(batches, "text"):
            raw, off = text_bytes(s.column(1))
            texts = s.column(1).to_pylist()
            begins = s.column(2).to_pylist() if marks else None
            doc, sec, a0, a1, tok, cut = [], [], [], [], [], []
            for i, text in enumerate(texts):
                b = raw[off[i] : off[i + 1]]
                if begins is not None:
                    starts = np.array(begins[i] or [0], np.int64)
                else:
                    starts = np.concatenate([[0], np.flatnonzero(b == 10) + 1])
                    starts = starts[:1] if not len(b) else starts[starts < len(b)]
                ids = np.array(enc.encode_ordinary(text), np.int64) if text else np.zeros(0, np.int64)
                at, cross = join_spans(starts, np.cumsum(size[ids]), rule)
                n = len(starts)
                chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
                edge = chars[np.append(starts, len(b))]
                doc.append(np.full(n, i)), sec.append(np.arange(n)), a0.append(edge[:-1]), a1.append(edge[1:])
                tok.append(np.bincount(at, minlength=n)), cut.append(np.bincount(at[cross], minlength=n))
            cols = [np.concatenate(x) for x in (doc, sec, a0, a1, tok, cut)]
            yield pa.RecordBatch.from_arrays([s.column(0).take(pa.array(cols[0])), *(pa.array(x.astype(np.int64)) for x in cols[1:])], names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    return docs.mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long")


def section_token_counts(docs: DataFrame, tokenizer: str, pattern: str, rule: str = "first", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per line of every text: doc_id, section (from 0), start and end (characters, end exclusive), n_tokens, and of these n_crossing that cross a boundary."""
    return _counted(id_and_text(docs, doc_id, text), tokenizer, pattern, rule, None)


def field_token_counts(docs: DataFrame, fields: list[str], tokenizer: str, pattern: str, rule: str = "first", separator: str = "\n", doc_id: str = "doc_id") -> DataFrame:
    """The same for fields: they are joined by the separator, which counts with the field before it, and `section` is a field's place in `fields`. A null field is empty."""
    parts = [F.concat(F.coalesce(F.col(f).cast("string"), F.lit("")), F.lit(separator if k + 1 < len(fields) else "")) for k, f in enumerate(fields)]
    sizes = [F.octet_length(p).cast("long") for p in parts]
    begins = F.array(*[sum(sizes[:k], F.lit(0).cast("long")) for k in range(len(fields))])
    df = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.concat(*parts).alias("text"), begins.alias("begins"))
    return _counted(df, tokenizer, pattern, rule, "begins")
