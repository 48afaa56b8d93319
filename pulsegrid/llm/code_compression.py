"""Vector codes by dual-tree Lloyd: a codebook of up to 256 entries for each of the consecutive parts of the vectors.

Rows without a vector, or with null or non-finite entries in it, are left out; an empty vector counts as none. Entries
become integers x = floor(1024 * c), and all distances, sums and means are of integers. A part position's codebook starts as
that part of the rows with the smallest ids (ties by the vector, null ids last). Each round assigns every part to the
nearest entry, of equally near ones the first, and replaces each entry by the floor of its parts' mean; entries without parts
stay. Afterwards parts are assigned once more.

Rows lie in stored blocks of bounded size. In a block each part position has a balanced tree, split at the median of the
widest side, whose order is stored with the block; a node is a run of the order, so running sums of the parts give any
node's sum. A round's codebooks, a bounded table, go to the tasks, which put a tree over their entries too. Both trees are
descended together, level by level: the boxes of two nodes give bounds of all distances between them, and a combination
whose least distance exceeds the smallest greatest distance of its node of parts is pruned. A node of parts with a single
entry left is assigned as a whole, by its cached sum. In the leaves that stay uncertain the distances to the entries that
are left are computed in integers. Tasks send counts and sums by entry, which Spark adds up.

Repeated rows count each; a null id stays null; null labels are one label; an empty table gives no rows; a table of fewer
rows than entries has shorter codebooks; other columns are ignored. Vectors of different lengths, or of a length that the
parts don't divide, are an error, as are entries so large that squared distances don't fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored
from .vectors import matrix, scaled, width_of

SCALE = 1024
PARTS = 4
#: At most 256, as an index is a byte of the code.
ENTRIES = 256
ITERATIONS = 4
BLOCK_BYTES = 4 << 20
LEAF = 64


class Tree(NamedTuple):
    """A balanced tree over the rows of points in its order: the ends of its nodes by level, their boxes, and running sums."""

    ends: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: np.ndarray


def node_ends(n: int, leaf: int) -> list[np.ndarray]:
    """The ends of the runs of each level, until none has more than `leaf` rows."""
    levels = [np.array([0, n])]
    while np.diff(levels[-1]).max(initial=0) > leaf:
        e = levels[-1]
        both = np.empty(2 * len(e) - 1, np.int64)
        both[::2], both[1::2] = e, (e[:-1] + e[1:]) // 2
        levels.append(both)
    return levels


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """The rows in the order of the tree."""
    order = np.arange(len(points))
    for ends in node_ends(len(points), leaf)[:-1]:
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            if b - a > 1:
                own = points[order[a:b]]
                side = own[:, int(np.argmax(own.max(0) - own.min(0)))]
                order[a:b] = order[a:b][np.argpartition(side, (a + b) // 2 - a)]
    return order


def tree_of(points: np.ndarray, leaf: int) -> Tree:
    """The tree over points that are in its order."""
    ends = node_ends(len(points), leaf)
    low, high = [], []
    for e in ends:
        # an empty run, which reduceat can't have, gets a box that is far from all
        full = np.diff(e) > 0
        lo, hi = np.full((len(full), points.shape[1]), np.iinfo(np.int64).max // 4), np.full((len(full), points.shape[1]), np.iinfo(np.int64).max // 4)
        lo[full], hi[full] = np.minimum.reduceat(points, e[:-1][full], 0), np.maximum.reduceat(points, e[:-1][full], 0)
        low.append(lo)
        high.append(hi)
    sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points, 0, out=sums[1:])
    return Tree(ends, low, high, sums)


class Assigned(NamedTuple):
    """Runs (start, end, entry) of the tree's order that are assigned as wholes, and the entry of each row that is not in one, else -1."""

    runs: list[tuple[int, int, int]]
    single: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between integer rows; exact, by doubles where these hold every number."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if a.shape[1] * (2 * most) ** 2 < 1 << 53:
        a, b = a.astype(float), b.astype(float)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return np.stack([((a - e) ** 2).sum(1) for e in b], 1)


def dual_assign(points: np.ndarray, tree: Tree, entries: np.ndarray) -> Assigned:
    """Nearest entries of all points, of equally near ones the first."""
    order = tree_order(entries, 1)
    codes = tree_of(entries[order], 1)
    runs: list[tuple[int, int, int]] = []
    single = np.full(len(points), -1)
    node, code, a, b = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while len(node):
        lo, hi, clo, chi = tree.low[a][node], tree.high[a][node], codes.low[b][code], codes.high[b][code]
        apart = np.maximum(0, np.maximum(lo - chi, clo - hi))
        across = np.maximum(hi - clo, chi - lo)
        least, most = (apart * apart).sum(1), (across * across).sum(1)
        # pairs stand by node
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        bound = np.repeat(np.minimum.reduceat(most, first), np.diff(np.append(first, len(node))))
        keep = least <= bound
        node, code = node[keep], code[keep]
        deepest = b == len(codes.ends) - 1
        if deepest:
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            count = np.diff(np.append(first, len(node)))
            e = tree.ends[a]
            runs += [(int(e[n]), int(e[n + 1]), int(order[codes.ends[b][c]])) for n, c in zip(node[first[count == 1]], code[first[count == 1]], strict=True)]
            left = np.repeat(count > 1, count)
            node, code = node[left], code[left]
            if a == len(tree.ends) - 1:
                for n in np.unique(node):
                    own = np.sort(order[codes.ends[b][code[node == n]]])
                    at = slice(e[n], e[n + 1])
                    single[at] = own[squared(points[at], entries[own]).argmin(1)]
                break
        down = a < len(tree.ends) - 1
        kids = lambda x, more: np.stack([2 * x, 2 * x + 1], 1) if more else x[:, None]
        n2, c2 = kids(node, down), kids(code, not deepest)
        node, code = np.repeat(n2, c2.shape[1], 1).ravel(), np.tile(c2, (1, n2.shape[1])).ravel()
        a, b = a + down, b + (not deepest)
        full = (np.diff(tree.ends[a])[node] > 0) & (np.diff(codes.ends[b])[code] > 0)
        node, code = node[full], code[full]
        by = np.argsort(node, kind="stable")
        node, code = node[by], code[by]
    return Assigned(runs, single)


def entry_sums(points: np.ndarray, tree: Tree, found: Assigned, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """How many parts each entry has, and their sum."""
    count, total = np.zeros(entries, np.int64), np.zeros((entries, points.shape[1]), np.int64)
    if found.runs:
        start, end, entry = np.array(found.runs).T
        np.add.at(count, entry, end - start)
        np.add.at(total, entry, tree.sums[end] - tree.sums[start])
    rest = np.flatnonzero(found.single >= 0)
    np.add.at(count, found.single[rest], 1)
    np.add.at(total, found.single[rest], points[rest])
    return count, total


def entry_of_each(found: Assigned) -> np.ndarray:
    out = found.single.copy()
    for a, b, entry in found.runs:
        out[a:b] = entry
    return out


def blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """rows (vec_id, label, x) as stored blocks: ids and labels, the parts of all positions in their trees' orders, and the orders."""
    label = rows.schema["label"].dataType
    at_once = max(1, BLOCK_BYTES // (8 * width))

    def block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        x = matrix(t.column("x"), width)
        if len(x) and width * (2 * int(np.abs(x).max())) ** 2 >= 1 << 62:
            raise ArithmeticError("squared distances of these vectors don't fit 64 bits")
        orders, points = [], []
        for p in np.split(x, parts, 1):
            orders.append(tree_order(p, LEAF).astype("<i4"))
            points.append(p[orders[-1]].astype("<i4"))
        one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c)
        binary = lambda arrays: pa.array([[a.tobytes() for a in arrays]], pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array([number]), one(t.column("vec_id")), one(t.column("label")), binary(points), binary(orders)], names=["block", "ids", "labels", "points", "orders"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, at_once - size)
                held, size, b = [*held, part], size + part.num_rows, b.slice(part.num_rows)
                if size == at_once:
                    yield block(held, first)
                    held, size, first = [], 0, first + 1
        if size:
            yield block(held, first)

    schema = f"block long, ids array<long>, labels array<{label.simpleString()}>, points array<binary>, orders array<binary>"
    return stored(rows.select("vec_id", "label", "x").mapInArrow(run, schema))


def _parts_of(batch: pa.RecordBatch, row: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for k, data in enumerate(batch.column("points")[row].as_py()):
        yield k, np.frombuffer(data, "<i4").reshape(-1, width).astype(np.int64)


def improved(stored_blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                for k, points in _parts_of(batch, row, width):
                    tree = tree_of(points, LEAF)
                    n, s = entry_sums(points, tree, dual_assign(points, tree, books[k]), len(books[k]))
                    count[k] += n
                    total[k] += s
        for k in range(len(books)):
            used = np.flatnonzero(count[k])
            sums = pa.ListArray.from_arrays(pa.array(np.arange(0, len(used) * width + 1, width), pa.int32()), pa.array(total[k][used].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k), pa.int32()), pa.array(used, pa.int32()), pa.array(count[k][used]), sums], names=["part", "entry", "n", "sums"])

    found = stored_blocks.select("points").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    sums = F.array(*[F.sum(F.col("sums")[j]) for j in range(width)])
    out = [b.copy() for b in books]
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), sums.alias("sums")).collect():
        out[r.part][r.entry] = [s // r.n for s in r.sums]
    return out


def assigned(stored_blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    width = books[0].shape[1]
    label = stored_blocks.schema["labels"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = batch.column("ids")[row].values, batch.column("labels")[row].values
                orders = batch.column("orders")[row].as_py()
                code, error = np.zeros((len(ids), len(books)), np.uint8), np.zeros(len(ids), np.int64)
                for k, points in _parts_of(batch, row, width):
                    entry = entry_of_each(dual_assign(points, tree_of(points, LEAF), books[k]))
                    order = np.frombuffer(orders[k], "<i4")
                    code[order, k] = entry
                    error[order] += ((points - books[k][entry]) ** 2).sum(1)
                text = code.tobytes().hex()
                n = 2 * len(books)
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([text[i : i + n] for i in range(0, len(text), n)], pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return stored_blocks.select("ids", "labels", "points", "orders").mapInArrow(run, f"vec_id long, label {label.simpleString()}, code string, error long")


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ITERATIONS, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding", label: Column | str | None = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """Per usable row vec_id, label, code (two hexadecimal digits a part) and error, stored; and the final codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    of = label if isinstance(label, Column) else F.col(f"`{label}`") if label in df.columns else F.lit(None).cast("string")
    rows = scaled(df, vector, scale, F.col(f"`{vec_id}`").cast("long").alias("vec_id"), of.alias("label"))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    width = len(first[0].x)
    if width % parts or any(len(r.x) != width for r in first):
        raise ValueError(f"the vectors have no common length that {parts} divides")
    books = [np.ascontiguousarray(b) for b in np.split(np.array([r.x for r in first], np.int64), parts, 1)]
    held = blocks(rows, width, parts)
    for _ in range(rounds):
        books = improved(held, books)
    return stored(assigned(held, books)), books


def report(df: DataFrame, **kw) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row."""
    found, books = compress(df, **kw)
    by = small_side(stored(found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))))
    out = found.join(by, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle(rounds: int = ITERATIONS) -> str:
    """SQL of `report` with the default parameters, every distance computed."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS (SELECT id, part, any_value(v) AS v, min(struct_pack(d := vv - 2 * list_inner_product(v, e) + ee, entry := entry)) AS x
        FROM p JOIN (SELECT *, list_inner_product(e, e) AS ee FROM c{k}) USING (part) GROUP BY id, part)""")
        if k < rounds:
            steps.append(f"""
n{k} AS (SELECT part, entry, list(f ORDER BY j) AS e FROM (SELECT part, x.entry AS entry, j, floor(sum(y) / count(*)) AS f
        FROM (SELECT part, x, unnest(v) AS y, unnest(range(len(v))) AS j FROM a{k}) GROUP BY ALL) GROUP BY ALL),
c{k + 1} AS (SELECT part, entry, coalesce(n{k}.e, c{k}.e) AS e FROM c{k} LEFT JOIN n{k} USING (part, entry))""")
    return f"""
WITH k AS (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: coalesce(isfinite(c), FALSE))) = len(embedding)),
p AS (SELECT *, list_inner_product(v, v) AS vv FROM (SELECT id, vec_id, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS v, x FROM k, (SELECT unnest(range({PARTS})) AS part))),
c0 AS (SELECT part, entry, v AS e FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, x) - 1 AS entry FROM p) WHERE entry < {ENTRIES}),{",".join(steps)},
h AS (SELECT sha256(string_agg(CAST(y AS BIGINT), ',' ORDER BY part, entry, j)) AS h FROM (SELECT part, entry, unnest(e) AS y, unnest(range(len(e))) AS j FROM c{rounds})),
r AS (SELECT id, string_agg(lpad(to_hex(x.entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(x.d) AS BIGINT) AS error FROM a{rounds} GROUP BY id)
SELECT vec_id, lower(code) AS code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM r JOIN k USING (id), h
"""
