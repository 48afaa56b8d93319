"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

`index` passes over the texts once and stores a posting (term, row, position) of every word of theirs, whatever will be looked
up: benchmarks that come later are answered from the same index, without the texts. A term is the 64-bit hash of a word, and
the index lies in PARTS ranges of it, a folder each, sorted by term. Each task writes the postings of its own documents, so
nothing is shuffled and a frequent term is spread over all tasks' files. A posting in the folder END stands for each row of
docs and holds its columns and its number of words, so that index and rows come from the same job.

Queries are the benchmark's windows: 13 consecutive words of an item, or all words of an item that has fewer. The lists of
a window's terms, moved back by the terms' offsets, are intersected from the rarest: the postings of the rarest term give
the candidate places (row, start); the second list is joined to them by term, row and place; then all the other lists at
once, of the rows that are left. Every join has the row in its key, so no term's list is ever one task's work. The index is
scanned four times, in its needed columns only: for how often the benchmark's terms occur, and for each of the three steps.
The rarest terms, if they are at most LISTED, are written into their scan as a list: it opens their folders alone and skips
row groups and pages by the statistics of the sorted terms.

A place where all terms stand exactly at their offsets is a phrase match. A place where each of them stands within `slop`
words of its offset is a proximity match; phrase matches are ones too. The rarest term's own place counts as exact, so a
proximity match is named by the start that it implies, which can lie before the text.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased. Null and empty texts have no words; a text's words
are one array in its row, however long it is. Items without an id are ignored; texts of items that share an id count for that
id together. Repeated documents give a row each; a null doc_id stays null; empty tables give no rows or no hits; other columns
are ignored. Of equally rare terms of a window the earlier comes first.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import settings

from .common import id_and_text, small_side, stored, work_dir

WORDS = 13
SLOP = 5
#: Ranges of the terms' hash, a power of two, and the part of the postings that stand for whole rows.
PARTS = 16
END = -1
#: Terms that a scan takes as a list.
LISTED = 10_000
#: What is not a word, before and after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
KEY = ["doc_id", "text_hash", "text_size"]
PLACE = ["window", "row", "start"]


def words(text: Column | str) -> Column:
    """The words of a text as they are written."""
    return F.array_remove(F.split(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), BETWEEN), "")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def windows(benchmark: DataFrame, size: int = WORDS, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(terms, length, item): each window of each item once. At most 62 words make a window."""
    if not 0 < size < 63:
        raise ValueError("a window has 1 to 62 words")
    df = benchmark.filter(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item"), words(ascii_lower(F.col(text).cast("string"))).alias("w"))
    df = df.filter(F.size("w") > 0).withColumn("at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))))
    return df.select(F.slice("w", F.col("at") + 1, F.lit(size)).alias("terms"), "item").distinct().withColumn("length", F.size("terms"))


def term_of(word: Column | str) -> Column:
    return F.xxhash64(word)


def part_of(term: Column | str) -> Column:
    """The range of the hash that a term lies in."""
    return F.shiftrightunsigned(term, 64 - PARTS.bit_length() + 1).cast("int")


def index(docs: DataFrame) -> DataFrame:
    """The stored postings (part, term, row, position) of docs (doc_id, text); those of the part END also have doc_id, text_hash and text_size, and the row's number of words as position."""
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_size"), words("text").alias("words"), F.monotonically_increasing_id().alias("row"))
    each = base.select("row", *KEY, F.posexplode(F.concat("words", F.array(F.lit("")))).alias("position", "word"))
    # lower() also changes letters beyond A-Z, so it serves only words that have none
    plain = F.octet_length("word") == F.length("word")
    each = each.withColumn("word", F.when(plain, F.lower("word")).otherwise(ascii_lower(F.col("word"))))
    end = F.col("word") == ""
    own = [F.when(end, F.col(c)).alias(c) for c in KEY]
    found = each.select(F.when(end, END).otherwise(part_of(term_of("word"))).alias("part"), term_of("word").alias("term"), "row", "position", *own)
    path = work_dir(docs.sparkSession)
    # a range's writer stays open for the next of its rows, so the rows need no other order than the terms'
    with settings(docs.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(PARTS + 1)}):
        found.sortWithinPartitions("term").write.partitionBy("part").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def lists_of(postings: DataFrame) -> DataFrame:
    return postings.filter(F.col("part") != END).select("part", "term", "row", "position")


def ranked(spread: DataFrame, postings: DataFrame) -> DataFrame:
    """(window, length, r): the windows all of whose terms occur, with (n, offset, term) of each term from the rarest. spread: window, length, offset, term."""
    known = small_side(spread.select("term").distinct())
    n = lists_of(postings).select("term").join(known, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    return spread.join(n, "term").groupBy("window", "length").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("r")).filter("size(r) = length")


def within(lists: DataFrame, terms: DataFrame) -> DataFrame:
    """lists, of the given distinct terms only if these are few: as a list in the plan."""
    few = [r.term for r in terms.limit(LISTED + 1).collect()]
    if len(few) > LISTED:
        return lists
    parts = sorted({(t % (1 << 64)) >> (64 - PARTS.bit_length() + 1) for t in few})
    return lists.filter(F.col("part").isin(parts) & F.col("term").isin(few))


def near(places: DataFrame, lists: DataFrame, slop: int) -> DataFrame:
    """places (window, row, start, length, term, offset, and others), with `off`: how far each posting of the term within `slop` words is from its place. lists: term, row, position."""
    width = 2 * slop + 1
    goal = F.col("start") + F.col("offset")
    cell = lambda c: F.floor(c / width)
    at = places.withColumn("cell", F.explode(F.array_distinct(F.array(cell(goal - slop), cell(goal + slop)))))
    found = at.join(lists.withColumn("cell", cell(F.col("position"))), ["term", "row", "cell"]).withColumn("off", F.abs(F.col("position") - goal))
    return found.filter(F.col("off") <= slop).drop("cell", "position")


def bits(found: DataFrame) -> DataFrame:
    """Of each place how many of its offsets have a posting nearby (`near`), and how many have one exactly there (`exact`)."""
    bit = F.expr("shiftleft(1L, offset)")
    return found.groupBy(*PLACE, "length").agg(F.bit_count(F.bit_or(bit)).alias("near"), F.bit_count(F.coalesce(F.bit_or(F.when(F.col("off") == 0, bit)), F.lit(0).cast("long"))).alias("exact"))


def starts(postings: DataFrame, queries: DataFrame) -> DataFrame:
    """(window, row, start, length, second): the places that the rarest terms' postings imply, with the second term. queries, stored: as `ranked` gives them."""
    nth = lambda k: F.get("r", F.lit(k))
    first = queries.select("window", "length", nth(0)["term"].alias("term"), nth(0)["offset"].alias("offset"), nth(1).alias("second"))
    lists = within(lists_of(postings), first.select("term").distinct())
    return lists.join(small_side(first), "term").withColumn("start", F.col("position") - F.col("offset")).select(*PLACE, "length", "second")


def matches(postings: DataFrame, queries: DataFrame, slop: int = SLOP) -> DataFrame:
    """(window, row, start, length, phrase): the places of all phrase and proximity matches, stored. queries, stored: as `ranked` gives them."""
    spark, lists = postings.sparkSession, lists_of(postings).drop("part")
    start = starts(postings, queries)
    seconds = small_side(queries.select(F.get("r", F.lit(1))["term"].alias("term")).filter("term IS NOT NULL").distinct())
    pairs = near(start.filter("length > 1").select(*PLACE, "length", "second.term", "second.offset"), lists.join(seconds, "term", "left_semi"), slop)
    one = start.filter("length = 1").select(*PLACE, "length", F.lit(1).cast("long").alias("exact"))
    with settings(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(LISTED)}):
        two = stored(bits(pairs).select(*PLACE, "length", "exact").unionByName(one) if not queries.filter("length = 1").isEmpty() else bits(pairs).select(*PLACE, "length", "exact"))
    more = two.filter("length > 2")
    rows = small_side(stored(more.select("row").distinct()))
    rest = small_side(queries.filter("length > 2").select("window", F.explode(F.slice("r", F.lit(3), F.col("length"))).alias("t")).select("window", "t.term", "t.offset"))
    others = bits(near(more.join(rest, "window"), lists.join(rows, "row", "left_semi"), slop)).filter("near = length - 2")
    others = others.withColumnRenamed("exact", "more").select(*PLACE, "more").join(more, PLACE)
    whole = others.select(*PLACE, "length", (F.col("more") + F.col("exact") == F.col("length") - 1).alias("phrase"))
    return stored(two.filter("length <= 2").select(*PLACE, "length", (F.col("exact") == 1).alias("phrase")).unionByName(whole))


def look_up(postings: DataFrame, benchmark: DataFrame, size: int = WORDS, slop: int = SLOP) -> tuple[DataFrame, DataFrame]:
    """The matches of the benchmark's windows in an index, and (window, item), stored."""
    each = stored(windows(benchmark, size).withColumn("window", F.xxhash64("terms")))
    spread = each.select("window", "length", F.posexplode("terms").alias("offset", "word")).select("window", "length", "offset", term_of("word").alias("term")).distinct()
    return matches(postings, stored(ranked(spread, postings)), slop), each.select("window", "item")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, share: int = 20, slop: int = SLOP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, text_hash, text_size, n_words, n_hit (words inside any window's phrase match), n_items, items_sha256, contaminated and n_near (proximity matches, phrase matches included)."""
    postings = index(id_and_text(docs, doc_id, text))
    return contamination_of(postings, benchmark, size, share, slop)


def contamination_of(postings: DataFrame, benchmark: DataFrame, size: int = WORDS, share: int = 20, slop: int = SLOP) -> DataFrame:
    """The same from the index of docs, whose texts aren't read."""
    found, of_window = look_up(postings, benchmark, size, slop)
    exact = found.filter("phrase")
    places = exact.select("row", "start", "length").distinct()
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reach = F.coalesce(F.max(end).over(before), F.lit(0))
    hits = places.withColumn("covered", F.greatest(F.lit(0), end - F.greatest("start", reach))).groupBy("row").agg(F.sum("covered").alias("n_hit"))
    items = exact.select("row", "window").distinct().join(small_side(of_window), "window").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    close = found.groupBy("row").agg(F.count("*").alias("n_near"))
    rows = postings.filter(F.col("part") == END).select("row", *KEY, F.col("position").cast("long").alias("n_words"))
    out = rows.join(hits, "row", "left").join(items, "row", "left").join(close, "row", "left")
    hit, own = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(*KEY, "n_words", hit.alias("n_hit"), F.size(own).cast("long").alias("n_items"), F.sha2(F.array_join(own, ",").cast("binary"), 256).alias("items_sha256"), ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def report(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The same without the text's key."""
    return contamination(docs, benchmark, **kw).drop("text_hash", "text_size")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that are not contaminated."""
    bad = contamination(docs, benchmark, doc_id=doc_id, text=text).filter("contaminated").select(*(F.col(c).alias(f"__{c}") for c in KEY)).distinct()
    bad = small_side(stored(bad))
    same = docs[doc_id].cast("long").eqNullSafe(bad["__doc_id"]) & (F.xxhash64(docs[text].cast("string")) == bad["__text_hash"]) & (F.octet_length(docs[text].cast("string")) == bad["__text_size"])
    return docs.join(bad, same, "left_anti")


def phrase_and_proximity(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, slop: int = SLOP) -> DataFrame:
    """(doc_id, item_id, window, start, length, phrase): every match of every item's windows; `window` tells an item's windows apart."""
    postings = index(id_and_text(docs))
    found, items = look_up(postings, benchmark, size, slop)
    rows = postings.filter(F.col("part") == END).select("row", "doc_id")
    return found.join(rows, "row").join(items, "window").select("doc_id", F.col("item").alias("item_id"), "window", "start", "length", "phrase")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT DISTINCT item, array_to_string(w[i + 1 : i + 13], ' ') AS phrase, least(13, len(w)) AS n
      FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase
      FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
h AS (SELECT p.doc_id, p.i, p.n, q.item FROM p JOIN q USING (phrase, n)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id),
x AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
t AS (SELECT phrase, n, unnest(string_split(phrase, ' ')) AS term, unnest(range(n)) AS o FROM (SELECT DISTINCT phrase, n FROM q)),
r AS (SELECT t.*, row_number() OVER (PARTITION BY phrase ORDER BY c, o) AS k, count(c) OVER (PARTITION BY phrase) AS known FROM t LEFT JOIN (SELECT term, count(*) AS c FROM x GROUP BY term) USING (term)),
f AS (SELECT phrase, n, doc_id, pos - o AS s FROM r JOIN x USING (term) WHERE k = 1 AND known = n),
near AS (SELECT f.doc_id, f.phrase, f.s FROM f JOIN r ON r.phrase = f.phrase AND k > 1 JOIN x ON x.doc_id = f.doc_id AND x.term = r.term AND abs(pos - o - s) <= 5
         GROUP BY f.doc_id, f.phrase, f.s, f.n HAVING count(DISTINCT o) = f.n - 1 UNION ALL SELECT doc_id, phrase, s FROM f WHERE n = 1),
m AS (SELECT doc_id, count(*) AS n_near FROM near GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN m USING (doc_id)
"""
