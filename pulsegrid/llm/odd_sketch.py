"""Near copies by MinHash with odd sketches.

A-Z are lower-cased; a text is the set of its shingles: two consecutive words, `[^\\x20\\x09-\\x0D]+`, hashed to 64 bits; a text
of one word has that one. Two texts are linked if 100 * |A and B| >= 80 * |A or B|, decided on the whole sets. Texts with
equal sets are one set from the start.

Each set has SAMPLES MinHash samples. Bands of consecutive samples name buckets: a pair at the threshold shares one with
the probability RECALL. An odd sketch of BITS bits folds all samples: each flips the bit that its number and value hash to.
Of two sketches' XOR only the samples that differ leave bits, so its population count estimates a high similarity closely;
pairs whose count is above the limit that a pair at the threshold exceeds with a probability of MISS aren't candidates.

Groups of sets meet in two steps, first buckets with their sketches and then the components of candidates with their whole
sets. In the first step a group is cut into chunks of a bounded number of sets and shingles; all sets of a chunk are compared,
and some sets of the group, its pivots, come to every chunk. That takes time linear in the group, joins the sets of a large
group of near copies, and is all that a group of one chunk needs. The second step takes the groups of several chunks in
which several parts were left: every pair of sets in different parts is compared in tiles, but none within the group's
largest part, whose sets therefore never meet each other again. Nothing is capped and no pair is ever a row: tasks return
edges that connect what they found linked, at most one for each set.

Null and empty texts, and texts without words, have empty sets, are linked with nothing and stand alone. component_id is the
smallest doc_id that can be reached, null if no id is known there; kept is whether it is the row's own, so rows that share
the smallest id are all kept. Repeated rows are copies. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import LOWER, SPACE, id_and_text, mix, ngram_hashes, slices, small_batches, small_side, split_words, stored, text_bytes, word_hashes
from .jaccard_join import _grouped, _table, components, forest, seed_of

SHINGLE = 2
#: Similarity as a fraction, as it is in the comparison of whole sets.
SIMILARITY = 0.8
SAMPLES = 512
BITS = 512
ROWS = 4
RECALL = 1 - 1e-6
MISS = 1e-8
CHUNK = 1024
CHUNK_TOKENS = 2 << 20
PIVOTS = 16


def bands_for(recall: float, rows: int = ROWS, similarity: float = SIMILARITY) -> int:
    """Bands of so many rows after which a pair at the threshold has shared one with the given probability."""
    return max(1, int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows))))


@cache
def limit_for(miss: float, samples: int = SAMPLES, bits: int = BITS, similarity: float = SIMILARITY) -> int:
    """The population count that the XOR of two sketches of a pair at the threshold exceeds with a probability of at most `miss`."""
    # of the samples that differ each side flips a bit; odd[k]: the probability that k bits are odd after the flips so far
    k = np.arange(samples + 1)
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, samples + 1)))])
    differing = np.exp(log_fact[-1] - log_fact - log_fact[::-1] + k * np.log(1 - similarity) + (samples - k) * np.log(similarity))
    odd, total = np.zeros(bits + 1), np.zeros(bits + 1)
    odd[0] = 1.0
    at = np.arange(bits + 1)
    for d in range(samples + 1):
        total += differing[d] * odd
        for _ in range(2):
            up, down = odd * (bits - at) / bits, odd * at / bits
            odd = np.append(0.0, up[:-1]) + np.append(down[1:], 0.0)
    tail = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(tail <= miss)[0]) - 1


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all lower-cased texts after one another, sorted within each, and where each text's begin."""
    raw, off = text_bytes(texts)
    w = split_words(LOWER[raw], off, ~SPACE[raw])
    h, first = ngram_hashes(word_hashes(w.unique)[w.codes] if len(w.codes) else np.zeros(0, np.uint64), w.first, n)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.append(np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))
    return h[new], np.searchsorted(doc[new], np.arange(len(first)))


def minhash(h: np.ndarray, first: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """A row of samples for each set; none of the sets is empty."""
    factors = [np.uint64(seed_of("minhash", k) | 1) for k in range(samples)]
    return np.stack([np.minimum.reduceat(h * f, first[:-1]) for f in factors], 1)


def odd_sketch(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity bitmaps (rows of bits / 8 bytes) of rows of samples."""
    number = np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = (mix(samples + number[None, :]) % np.uint64(bits)).astype(np.int64) + bits * np.arange(len(samples))[:, None]
    odd = np.bincount(at.ravel(), minlength=bits * len(samples)) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(samples), bits), axis=1)


def band_names(samples: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """A hash of each band's samples and number."""
    out = np.empty((len(samples), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(samples), seed_of("band", b), np.uint64)
        for r in range(rows):
            x = mix(x * np.uint64(3) + samples[:, (b * rows + r) % samples.shape[1]])
        out[:, b] = x
    return out


def sketches(docs: DataFrame, bands: int) -> DataFrame:
    """doc_id, text_hash, text_size, sid (16 bytes that name the set, null if it is empty), size (of the set), its bands and its odd sketch."""
    small_batches(docs.sparkSession)
    df = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_size"), "text")
    schema = df.drop("text").schema.add("sid", "binary").add("size", "integer").add("bands", ArrayType(LongType())).add("odd", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "text"):
            h, first = shingle_sets(s.column(3))
            has = np.diff(first) > 0
            sid, odd = np.full(s.num_rows, None, object), np.full(s.num_rows, None, object)
            names = np.zeros((0, bands), np.uint64)
            if has.any():
                own, data = first[np.append(has, True)], h.tobytes()
                sid[has] = [hashlib.blake2b(data[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(own[:-1], own[1:], strict=True)]
                samples = minhash(h, own)
                odd[has] = [x.tobytes() for x in odd_sketch(samples)]
                names = band_names(samples, bands)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * bands)]), pa.int32()), pa.array(np.ascontiguousarray(names).ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([*s.columns[:3], pa.array(sid, pa.binary()), pa.array(np.diff(first), pa.int32()), lists, pa.array(odd, pa.binary())], names=["doc_id", "text_hash", "text_size", "sid", "size", "bands", "odd"])

    return df.mapInArrow(run, schema)


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The set of each sid in wanted (sid, doc_id, text_hash, text_size: one row that has it)."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_size"), "text")
    same = (F.col("d.text_hash") == F.col("w.text_hash")) & (F.col("d.text_size") == F.col("w.text_size")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    texts = keyed.alias("d").join(small_side(wanted).alias("w"), same).select("sid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for s in slices(batches, "text"):
            s = s.take(pa.array([k for k, x in enumerate(s.column(0).to_pylist()) if not (x in seen or seen.add(x))], pa.int64()))
            h, first = shingle_sets(s.column(1))
            yield pa.RecordBatch.from_arrays([s.column(0), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(h.view(np.int64)))], names=["sid", "set"])

    # rows that repeat lie in several tasks
    return texts.mapInArrow(run, "sid binary, set array<long>").groupBy("sid").agg(F.any_value("set").alias("set"))


def alike(rows: list[tuple]) -> np.ndarray:
    """Which sketches (last in each row) are those of candidates: a square table."""
    bits = np.unpackbits(np.frombuffer(b"".join(r[-1] for r in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    ones = bits.sum(1)
    # the population count of the XOR; whole numbers, exact in single precision
    return ones[:, None] + ones[None, :] - 2 * (bits @ bits.T) <= limit_for(MISS)


def similar(rows: list[tuple]) -> np.ndarray:
    """Which whole sets (last in each row) are linked: a square table."""
    return _table([r[-1] for r in rows])


def compared(tiles: DataFrame, what: str, table: Callable[[list[tuple]], np.ndarray]) -> DataFrame:
    """(a, b), stored: edges that connect what is linked in each tile. tiles: group, tile, sid and the column `what`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[bytes] = []
        b: list[bytes] = []
        for rows in _grouped(batches):
            i, j = forest(table(rows))
            a += [rows[k][2] for k in i]
            b += [rows[k][2] for k in j]
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    n = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.select("group", "tile", "sid", what).repartition(n, "group", "tile").sortWithinPartitions("group", "tile", "sid")
    return stored(dealt.mapInArrow(run, "a binary, b binary").distinct())


def meet(groups: DataFrame, what: str, table: Callable[[list[tuple]], np.ndarray], chunk: int = CHUNK) -> DataFrame:
    """(a, b): edges with the same components as all linked pairs of sets that share a group. groups, stored: group, sid, tokens (of the set, if whole sets are compared) and the column `what`."""
    sizes = groups.groupBy("group").agg(F.count("*").alias("n"), F.sum("tokens").alias("total")).filter("n > 1")
    parts = F.ceil(F.greatest(F.col("n") / chunk, F.col("total") / CHUNK_TOKENS)).cast("int")
    sizes = stored(sizes.select("group", parts.alias("chunks")))
    large = small_side(stored(sizes.filter("chunks > 1")))
    marked = groups.join(large, "group", "left")
    few = marked.filter("chunks IS NULL").drop("chunks").join(sizes.filter("chunks = 1").select("group"), "group").withColumn("tile", F.lit(0))
    many = marked.filter("chunks IS NOT NULL")
    cell = lambda n: F.pmod(F.xxhash64("sid", "group"), n).cast("int")
    pivot = many.groupBy("group", F.pmod(F.xxhash64("group", "sid"), F.lit(PIVOTS)).alias("_")).agg(F.min("sid").alias("sid"))
    pivots = many.join(pivot.select("group", "sid"), ["group", "sid"], "left_semi").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cols = ["group", "tile", "sid", what]
    first = compared(few.select(*cols).unionByName(many.withColumn("tile", cell(F.col("chunks"))).select(*cols)).unionByName(pivots.select(*cols)), what, table)
    if large.isEmpty():
        return first

    label = stored(components(first))
    known = many.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    counts = stored(known.groupBy("group", "label").agg(F.count("*").alias("n"), F.sum("tokens").alias("total")))
    main = counts.groupBy("group").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    open_ = counts.join(main.select("group", "main"), "group").withColumn("large", F.col("label") == F.col("main"))
    blocks = lambda large: F.ceil(F.greatest(F.sum(F.when(F.col("large") == large, F.col("n"))) / chunk, F.sum(F.when(F.col("large") == large, F.col("total"))) / CHUNK_TOKENS)).cast("int")
    plan = small_side(stored(open_.groupBy("group", "main").agg(blocks(False).alias("rest"), blocks(True).alias("most"))))
    left = known.join(plan, "group").withColumn("large", F.col("label") == F.col("main"))
    block = F.when(F.col("large"), F.col("rest") + cell(F.col("most"))).otherwise(cell(F.col("rest")))
    # the blocks of the largest part come after the others', and meet only these
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("large"), F.col("rest")).otherwise(F.col("rest") + F.col("most")) - 1))
    left = left.withColumn("block", block).withColumn("other", other)
    tile = F.least("block", "other") * (F.col("rest") + F.col("most")) + F.greatest("block", "other")
    return first.unionByName(compared(left.withColumn("tile", tile).select(*cols), what, table))


def near_copies(docs: DataFrame, recall: float = RECALL, chunk: int = CHUNK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept."""
    docs = id_and_text(docs, doc_id, text)
    bands = bands_for(recall)
    rows = stored(sketches(docs, bands))
    sets = stored(rows.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash", "text_size")).alias("of"), F.any_value("size").alias("tokens"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd")))
    named = sets.select("sid", F.explode("bands").alias("group"))
    shared = named.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1").select("group")
    buckets = stored(named.join(shared, "group").join(sets.select("sid", "odd"), "sid").select("group", "sid", F.lit(0).alias("tokens"), "odd"))
    coarse = stored(components(stored(meet(buckets, "odd", alike, chunk))))

    wanted = stored(coarse.join(sets.select("sid", "tokens", "of"), "sid").select("sid", "of.*", F.xxhash64("label").alias("group"), "tokens"))
    whole = whole_sets(docs, wanted.select("sid", "doc_id", "text_hash", "text_size")).join(wanted.select("sid", "group", "tokens"), "sid")
    label = stored(components(stored(meet(stored(whole), "set", similar, chunk))))
    member = label.join(sets.select("sid", "least_id"), "sid")
    of_label = member.groupBy("label").agg(F.min("least_id").alias("component_id"))
    linked = stored(member.join(of_label, "label").select("sid", "component_id", F.lit(True).alias("linked")))
    known = sets.select("sid", "least_id").join(linked, "sid", "left").select("sid", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least_id")).alias("component_id"))
    out = reduce(DataFrame.unionByName, [
        rows.filter("sid IS NOT NULL").join(known, "sid").select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id"),
        rows.filter("sid IS NULL").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")),
    ])
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: near_copies over the table documents, by every pair of whole shingle sets that shares one of the rarest shingles that it must share.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT DISTINCT id, array_to_string(w[i + 1 : i + 2], ' ') AS t FROM (SELECT id, w, unnest(range(greatest(len(w) - 2, 0) + 1)) AS i FROM w WHERE len(w) > 0)),
s AS (SELECT id, list(t ORDER BY t) AS s FROM x GROUP BY id),
g AS (SELECT min(id) AS g, min(doc_id) AS least_id, len(s) AS n, list(id) AS ids FROM s JOIN w USING (id) GROUP BY s),
y AS (SELECT g, n, t, row_number() OVER (PARTITION BY g ORDER BY c, t) AS k FROM x JOIN g ON id = g JOIN (SELECT t, count(*) AS c FROM x JOIN g ON id = g GROUP BY t) USING (t)),
p AS (SELECT DISTINCT a.g AS a, b.g AS b FROM y a JOIN y b USING (t) WHERE a.g < b.g AND a.k <= a.n - ceil(0.8 * a.n) + 1 AND b.k <= b.n - ceil(0.8 * b.n) + 1 AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
e AS (SELECT a, b FROM p JOIN s u ON u.id = a JOIN s v ON v.id = b WHERE 9 * len(list_intersect(u.s, v.s)) >= 4 * (len(u.s) + len(v.s))),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT g, g FROM g UNION SELECT r.a, f.b FROM r JOIN f ON f.a = r.b),
c AS (SELECT r.a AS g, min(least_id) AS component_id FROM r JOIN g ON g.g = r.b GROUP BY r.a),
m AS (SELECT unnest(ids) AS id, n, component_id FROM g JOIN c USING (g))
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CASE WHEN m.id IS NULL THEN doc_id ELSE component_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN m.id IS NULL THEN doc_id ELSE component_id END AS kept FROM w LEFT JOIN m USING (id)
"""
