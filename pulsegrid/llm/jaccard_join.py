"""Near-duplicate join on word shingles by chosen paths.

A text is the set of its shingles: five consecutive words, `[^\\x20\\x09-\\x0D]+`, hashed to 64 bits; a text of fewer words,
but not none, has one. Texts with equal sets are copies and stand for each other from the start. Two texts are linked if
5 * |A and B| >= 4 * |A or B|, that is at a Jaccard similarity of 0.8, decided on the whole sets.

Candidates come from chosen paths. In every run each set samples the token that a run's hash orders first, and sets that
sampled the same token share a bucket: a pair shares it with the probability of its similarity. A bucket of more than
`bucket` sets is split again, up to `depth` times, by two further sampled tokens per set, chosen by the path so far; small
buckets are compared by brute force. Runs are repeated until a pair at the threshold has been together with probability
`recall`, also if it was split `depth` times. Buckets that stay large hold sets that mostly are similar: they are compared
in tiles, which hold about `tile` sets or TILE_TOKENS shingles to a side, so that no task gets a whole bucket and long texts
make small tiles; a single text's set is held whole. Nothing is capped, and no pair is ever a row.

Buckets compare sketches, 64 sampled tokens of 16 bits for each set: a pair is plausible if half of them agree, which a
pair at the threshold misses with a probability of about one in 10^8. Components of plausible pairs are a coarse grouping
in which every link lies within a group; only there are the whole sets compared, every pair once, in tiles, which gives
the exact links, their number for each text and the classes. So the only large thing that moves is the sets of texts that
have a plausible partner, and it moves once.

Null and empty texts are linked to nothing and form classes of their own. A class is named by its least doc_id, null if
none is known. n_links counts other rows, copies included. Repeated rows are copies. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from pulsegrid.operators.identity import connected_components

from .common import id_and_text, mix, ngram_hashes, plainly, slices, small_batches, small_side, stored, word_hashes, words_of

SHINGLE = 5
#: Similarity as a fraction.
OVER, UNDER = 4, 5
RECALL = 1 - 1e-6
BUCKET = 1000
TILE = 1024
TILE_TOKENS = 2 << 20
DEPTH = 2
#: Sampled tokens of a sketch, 16 bits of each, and how many must agree.
MARKS = 64
AGREE = 32
SEED = 0x51ED270B0A1F39C1


def runs_for(recall: float, depth: int = DEPTH, similarity: float = OVER / UNDER) -> int:
    """Runs after which a pair at the threshold has shared a bucket with the given probability. A pair stays together in a split if it does by one of two tokens."""
    together = similarity * (1 - (1 - similarity) ** 2) ** depth
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts after one another, sorted within each, and where each text's begin."""
    w, _, _ = words_of(texts)
    h, first = ngram_hashes(word_hashes(w.unique)[w.codes] if len(w.codes) else np.zeros(0, np.uint64), w.first, n)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(first)))


def least_token(h: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """The token of each set (none is empty) that the seed's hash orders first."""
    return mix_back(np.minimum.reduceat(mix(h ^ np.uint64(seed)), first[:-1])) ^ np.uint64(seed)


def mix_back(h: np.ndarray) -> np.ndarray:
    """The inverse of mix."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
    return h ^ (h >> np.uint64(33))


def seed_of(*parts: int | str) -> int:
    return int.from_bytes(hashlib.blake2b(repr((SEED, *parts)).encode(), digest_size=8).digest(), "little")


def _sets_of(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    a = batch.column(column)
    off = a.offsets.to_numpy()
    return a.values.to_numpy()[off[0] : off[-1]].view(np.uint64), off - off[0]


def _longs(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def sketch(docs: DataFrame, runs: int, keep: list[str]) -> DataFrame:
    """The columns in `keep`, text_hash, text_size, sid (16 bytes that name the set, null without words), size (of the set), the runs' tokens and the sketch."""
    small_batches(docs.sparkSession)
    df = docs.select(*keep, F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_size"), "text")
    schema = df.drop("text").schema.add("sid", "binary").add("size", "integer").add("tokens", ArrayType(LongType())).add("marks", "binary")
    n = len(df.columns) - 1
    seeds = [seed_of(r) for r in range(runs)]
    factors = [np.uint64(seed_of("mark", k) | 1) for k in range(MARKS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "text"):
            h, first = shingle_sets(s.column(n))
            has = np.diff(first) > 0
            own = first[np.append(has, True)] if has.any() else np.zeros(1, np.int64)
            sid = np.full(s.num_rows, None, object)
            data = h.tobytes()
            sid[has] = [hashlib.blake2b(data[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(own[:-1], own[1:], strict=True)]
            tokens = np.stack([least_token(h, own, x) for x in seeds], 1) if has.any() else np.zeros((0, runs), np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * runs)]), pa.int32()), _longs(np.ascontiguousarray(tokens).ravel()))
            marks = np.full(s.num_rows, None, object)
            if has.any():
                least = np.stack([np.minimum.reduceat(h * f, own[:-1]) for f in factors], 1)
                marks[has] = [x.tobytes() for x in (mix(least) >> np.uint64(48)).astype("<u2")]
            yield pa.RecordBatch.from_arrays([*s.columns[:n], pa.array(sid, pa.binary()), pa.array(np.diff(first), pa.int32()), lists, pa.array(marks, pa.binary())], names=[*s.schema.names[:n], "sid", "size", "tokens", "marks"])

    return df.mapInArrow(run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The columns of wanted but the text's key, and the set of each sid, at most once from each task. wanted: sid, doc_id, text_hash, text_size and others."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_size"), "text")
    same = (F.col("d.text_hash") == F.col("w.text_hash")) & (F.col("d.text_size") == F.col("w.text_size")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    rest = [c for c in wanted.columns if c not in ("sid", "doc_id", "text_hash", "text_size")]
    texts = keyed.alias("d").join(small_side(wanted).alias("w"), same).select("sid", "text", *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for s in slices(batches, "text"):
            new = [k for k, x in enumerate(s.column(0).to_pylist()) if not (x in seen or seen.add(x))]
            s = s.take(pa.array(new, pa.int64()))
            h, first = shingle_sets(s.column(1))
            yield pa.RecordBatch.from_arrays([s.column(0), *s.columns[2:], pa.ListArray.from_arrays(pa.array(first, pa.int32()), _longs(h))], names=["sid", *rest, "set"])

    return texts.mapInArrow(run, texts.drop("text").schema.add("set", ArrayType(LongType())))


def split(buckets: DataFrame, level: int) -> DataFrame:
    """The child buckets (path, sid, marks) of the given ones: two sampled tokens for each set, chosen by the path."""
    df = buckets.select("path", "sid", "marks", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    which = F.pmod(F.xxhash64("path", F.lit(level), "k"), F.lit(MARKS)).cast("int")
    token = F.substring(F.col("marks"), which * 2 + 1, F.lit(2))
    return df.select(F.xxhash64("path", F.lit(level), "k", token).alias("path"), "sid", "marks")


def tiled(groups: DataFrame, tile: int) -> DataFrame:
    """groups (group, sid, n: the group's sets, tokens: these sets' shingles if whole sets are compared, and others) with block, tile (a pair of blocks) and mixed (two different ones), a tile's rows together; each two sets of a group meet in one tile at least."""
    df = groups.withColumn("blocks", F.ceil(F.greatest(F.col("n") / tile, F.col("tokens") / TILE_TOKENS)).cast("int")).withColumn("block", F.pmod(F.xxhash64("sid", "group"), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    df = df.withColumn("tile", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).withColumn("mixed", F.col("other") != F.col("block"))
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.drop("blocks", "other", "n", "tokens").repartition(n, "group", "tile").sortWithinPartitions("group", "tile", "sid")


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets (sorted, distinct) are similar: a square table."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    row = np.repeat(np.arange(n), size)
    order = np.argsort(every, kind="stable")
    token, row = every[order], row[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    count = np.diff(np.append(np.flatnonzero(new), len(token)))
    shared = np.repeat(count > 1, count)
    column = (np.cumsum(new & shared) - 1)[shared]
    row = row[shared]
    both = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    step = max(256, (4 << 20) // n)
    for a in range(0, width, step):
        at = slice(*np.searchsorted(column, [a, a + step]))
        x = np.zeros((n, min(step, width - a)), np.float32)
        x[row[at], column[at] - a] = 1
        both += x @ x.T
    # counts stay exact in single precision below 2 ** 24 shared tokens
    total = size[:, None] + size[None, :]
    return UNDER * both >= OVER * (total - both)


def small_linked(a: np.ndarray, b: np.ndarray) -> bool:
    if OVER * max(len(a), len(b)) > UNDER * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (group, tile, sid, ...) in order of group, tile and sid as one list for each tile; a sid that comes again is left out."""
    rows: list[tuple] = []
    for s in batches:
        cols = [c.to_pylist() for c in s.columns[:-1]]
        last = s.column(s.num_columns - 1)
        if pa.types.is_list(last.type):
            h, first = _sets_of(s, s.num_columns - 1) if s.num_rows else (None, [])
            cols.append([h[first[k] : first[k + 1]] for k in range(s.num_rows)])
        else:
            cols.append(last.to_pylist())
        for row in zip(*cols, strict=True):
            if rows and row[:2] != rows[-1][:2]:
                if len(rows) > 1:
                    yield rows
                rows = []
            if not rows or row[2] != rows[-1][2]:
                rows.append(row)
    if len(rows) > 1:
        yield rows


def forest(at: np.ndarray) -> tuple[list[int], list[int]]:
    """From a square table of links: for each row that is linked, one edge to the first row of its part."""
    seen, a, b = np.zeros(len(at), bool), [], []
    for root in range(len(at)):
        if seen[root]:
            continue
        seen[root], queue = True, [root]
        while queue:
            new = np.flatnonzero(at[queue.pop()] & ~seen)
            seen[new] = True
            queue += new.tolist()
            a += [root] * len(new)
            b += new.tolist()
    return a, b


def agreeing(marks: np.ndarray) -> np.ndarray:
    """Which sketches (rows of 16-bit tokens) agree in AGREE places at least."""
    n = len(marks)
    out = np.empty((n, n), bool)
    step = max(1, (1 << 21) // n)
    for k in range(0, n, step):
        count = np.zeros((min(step, n - k), n), np.uint8)
        for j in range(MARKS):
            count += marks[k : k + step, None, j] == marks[None, :, j]
        out[k : k + step] = count >= AGREE
    return out


def plausible(groups: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b): edges that connect all sets of a bucket whose sketches agree. groups: group, sid, n, tokens, marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for rows in _grouped(batches):
            if len(rows) == 2:
                x, y = (np.frombuffer(r[5], "<u2") for r in rows)
                i, j = ([0], [1]) if (x == y).sum() >= AGREE else ([], [])
            else:
                i, j = forest(agreeing(np.frombuffer(b"".join(r[5] for r in rows), "<u2").reshape(-1, MARKS)))
            a += [rows[k][2] for k in i]
            b += [rows[k][2] for k in j]
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    rows = tiled(groups, tile).select("group", "tile", "sid", "block", "mixed", "marks")
    return rows.mapInArrow(run, "a binary, b binary").distinct()


def _table(sets: list[np.ndarray]) -> np.ndarray:
    if len(sets) > 6:
        return linked(sets)
    out = np.eye(len(sets), dtype=bool)
    for i in range(len(sets)):
        for j in range(i):
            out[i, j] = out[j, i] = small_linked(sets[i], sets[j])
    return out


def links(groups: DataFrame, tile: int = TILE) -> DataFrame:
    """Of each tile: (a, b) edges that connect all linked sets, and (a, others) the rows of other sets that a's is linked to, each pair counted in one tile. groups: group, sid, n, tokens, copies, set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            at = _table([r[6] for r in rows])
            i, j = forest(at)
            np.fill_diagonal(at, False)
            if rows[0][4]:
                block = np.array([r[3] for r in rows])
                at &= block[:, None] != block[None, :]  # pairs within a block are counted in the block's own tile
            count = at @ np.array([r[5] for r in rows], np.int64)
            hit = np.flatnonzero(count)
            if len(i) + len(hit):
                a = [rows[k][2] for k in i] + [rows[k][2] for k in hit]
                b = [rows[k][2] for k in j] + [None] * len(hit)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([None] * len(i) + count[hit].tolist(), pa.int64())], names=["a", "b", "others"])

    rows = tiled(groups, tile).select("group", "tile", "sid", "block", "mixed", "copies", "set")
    return rows.mapInArrow(run, "a binary, b binary, others long")


def components(pairs: DataFrame) -> DataFrame:
    """(sid, label): the least sid of each component."""
    return connected_components(pairs, "a", "b").select(F.col("node").alias("sid"), F.col("component").alias("label"))


def shared_paths(paths: DataFrame, bucket: int) -> tuple[DataFrame, DataFrame]:
    """The rows of paths (path, and others) whose path others have too, with their number n: those of at most `bucket` rows, and the rest. The paths of more are few and are looked up where the rows lie, so that no task gets all rows of a frequent one."""
    counts = stored(paths.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"))
    often = small_side(stored(counts.filter(F.col("n") > bucket)))
    seen = paths.join(often, "path", "left")
    return seen.filter("n IS NULL").drop("n").join(counts.filter(F.col("n") <= bucket), "path"), seen.filter("n IS NOT NULL")


def near_duplicates(docs: DataFrame, recall: float = RECALL, bucket: int = BUCKET, tile: int = TILE, depth: int = DEPTH, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id (and the columns of `keep`), class_id and n_links."""
    source = docs
    docs = id_and_text(docs, doc_id, text)
    runs = runs_for(recall, depth)
    base = docs if not keep else source.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *keep)
    rows = stored(sketch(base, runs, ["doc_id", *(keep or [])]))
    reps = stored(rows.filter("sid IS NOT NULL").groupBy("sid").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash", "text_size")).alias("of"), F.any_value("size").alias("size"), F.any_value("tokens").alias("tokens"), F.any_value("marks").alias("marks")))
    paths = reps.select("sid", F.posexplode("tokens").alias("run", "token")).select(F.xxhash64("run", "token").alias("path"), "sid")
    small, large = shared_paths(paths, bucket)
    marks = reps.select("sid", "marks")
    buckets = [small.join(marks, "sid")]
    now = stored(large.join(marks, "sid"))
    for level in range(depth):
        if now.isEmpty():
            break
        small, large = shared_paths(stored(split(now, level).distinct()), bucket)
        buckets.append(small)
        now = stored(large)
    groups = reduce(DataFrame.unionByName, [*buckets, now]).withColumnRenamed("path", "group").withColumn("tokens", F.lit(0))
    coarse = components(stored(plausible(groups, tile)))

    each = stored(coarse.join(reps.select("sid", "size", "copies", "of"), "sid"))
    whole = each.groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("tokens"))
    wanted = stored(each.join(whole, "label").select("sid", "of.*", F.xxhash64("label").alias("group"), "n", "tokens", "copies"))
    found = stored(links(sets_of(docs, wanted), tile))
    label = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("sid")).agg(F.sum("others").alias("others"))
    member = stored(label.join(reps.select("sid", "least_id"), "sid"))
    named = member.join(member.groupBy("label").agg(F.min("least_id").alias("class_id")), "label").join(counts, "sid", "left")
    known = reps.select("sid", "copies", "least_id").join(named.select("sid", "class_id", "others", F.lit(True).alias("in_class")), "sid", "left")
    known = known.select("sid", F.when(F.col("in_class"), F.col("class_id")).otherwise(F.col("least_id")).alias("class_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.filter("sid IS NOT NULL").join(known, "sid").select("doc_id", *(keep or []), "class_id", "n_links", "sid")
    alone = rows.filter("sid IS NULL").select("doc_id", *(keep or []), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "sid")
    return out.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, with all their columns, but of each class only the row with the least doc_id; of rows that share it, the one with the least hash of its text, and of rows that share id and text the one with the least hash of all columns.

    Rows are known by their id and text, never by their place, so any order of reading gives the same rows. Rows without
    words stay; a class without any id is known by the set of its own.
    """
    return plainly(docs, {doc_id, text}, lambda d: _without_copies(d, doc_id, text))


def _without_copies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    key = ["__id", "__hash", "__bytes"]
    keyed = docs.select(*docs.columns, F.col(doc_id).cast("long").alias("__id"), F.xxhash64(F.col(text).cast("string")).alias("__hash"), F.octet_length(F.col(text).cast("string")).alias("__bytes"))
    found = near_duplicates(keyed, keep=key, doc_id=doc_id, text=text).filter("sid IS NOT NULL")
    each = stored(found.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("sid")).alias("s"), *key).agg(F.count("*").alias("rows")))
    first = each.groupBy("class_id", "s").agg(F.min(F.struct(F.col("__id").isNull().alias("unknown"), *key)).alias("x")).select("x.*").drop("unknown")
    same = lambda a, b: reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in key])
    each = stored(each.alias("e").join(first.alias("f"), same("e", "f"), "left").select("e.*", F.col("f.__hash").isNotNull().alias("stays")))
    gone = small_side(stored(each.filter("NOT stays").select(*key)))
    several = stored(each.filter("stays AND rows > 1").select(*key))
    keyed = keyed.alias("d")
    left = keyed.join(gone.alias("g"), same("d", "g"), "left_anti")
    if several.isEmpty():
        return left.select(*docs.columns)
    again = small_side(several).alias("g")
    single = left.join(again, same("d", "g"), "left_anti").select(*docs.columns)
    row = F.struct(*(F.col(f"d.`{c}`") for c in docs.columns))
    one = keyed.join(again, same("d", "g"), "left_semi").groupBy(*key).agg(F.min_by(row, F.xxhash64(row)).alias("row")).select("row.*")
    return single.unionByName(one)


#: near_duplicates over the table documents, by whole shingle sets and every pair of them that shares a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT DISTINCT id, array_to_string(w[i + 1 : i + 5], ' ') AS t FROM (SELECT id, w, unnest(range(greatest(len(w) - 5, 0) + 1)) AS i FROM w WHERE len(w) > 0)),
s AS (SELECT id, list(t ORDER BY t) AS s FROM x GROUP BY id),
g AS (SELECT min(id) AS g, min(doc_id) AS least_id, count(*) AS copies, len(s) AS n, list(id) AS ids FROM s JOIN w USING (id) GROUP BY s),
t AS (SELECT t, list(struct_pack(g, n)) AS own FROM x JOIN g ON id = g GROUP BY t HAVING count(*) > 1),
e AS (SELECT a.g AS a, b.g AS b FROM (SELECT own, unnest(own) AS a FROM t), unnest(own) AS u(b)
      WHERE a.g <> b.g AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY a.g, b.g, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)),
r(a, b) AS (SELECT g, g FROM g UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT r.a AS g, min(least_id) AS class_id FROM r JOIN g ON g.g = r.b GROUP BY r.a),
k AS (SELECT e.a AS g, sum(copies) AS others FROM e JOIN g ON g.g = e.b GROUP BY e.a),
m AS (SELECT unnest(ids) AS id, class_id, copies - 1 + coalesce(others, 0) AS n_links FROM g JOIN c USING (g) LEFT JOIN k USING (g))
SELECT doc_id, CASE WHEN m.id IS NULL THEN doc_id ELSE class_id END AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links FROM w LEFT JOIN m USING (id)
"""
