"""Personal data by bootstrapped contextual extraction.

Seeds are e-mail addresses, IPv4 addresses, card numbers and phone numbers of fixed forms (`base_spans`), access key ids of
their published form, and the few values that stand for all other secrets: SEED_VALUES of the hexadecimal keys that a text
gives to a name in quotes, those with the least hash. No form makes any other string a secret: a bare hexadecimal run, or a
value given to a name, is a candidate, and only its contexts can tell. The words around a seed are lexical patterns; so are those around other strings that might be an
identifier (candidates). Patterns and instances form a bipartite graph, which Spark scores in rounds: a pattern's confidence
for a kind is the share of the kind in its evidence, which is its accepted instances, each by its score, and the open ones
whose shape excludes the kind; open ones of a fitting shape are no evidence. A candidate takes the best confidence of its
patterns for a kind that its shape allows; that of the single word before it only if none of its longer patterns has
`min_support` instances without being sure itself. Candidates that reach `min_confidence` through a pattern with at least
`min_support` accepted instances join the seeds of the next round, in which all patterns are scored anew. The final spans
are the seeds' and the accepted candidates'; seeds are never dropped.

A shape allows a kind only where its definition does: a number of a card's length that fails the checksum is no card in any
context, and a part of a longer word is no number. Such numbers count against their patterns.

One pass over the texts finds seeds and candidates with their patterns; it is stored, and everything after works on that
small table. Null and empty texts have no spans; a null doc_id stays null; repeated rows are searched each; an empty table
gives no rows; other columns are ignored, or kept by `redact`. Equal starts are ordered email, ip, card, phone, secret.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plainly, slices, small_batches, small_side, stored

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![A-Za-z0-9])[0-9][0-9()./ -]*[0-9](?![A-Za-z0-9])")
#: Fixed value: the published form of access key ids.
ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])")
#: Hexadecimal runs of 64 bits or more, and those of 128 bits or more that are given to a name in quotes.
HEX_RUN = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{16,}(?![A-Za-z0-9])")
QUOTED_KEY = re.compile(r"(?:(?<=[=:] \")|(?<=[=:]\"))[0-9A-Fa-f]{32,64}(?=\")")
#: Distinct values of this form that are seeds.
SEED_VALUES = 6
#: A value that is given to a name.
GIVEN = re.compile(r"(?<=[A-Za-z_][=:])[^\s\"'<>,;=:]{6,64}|(?<=[=:] \")[^\s\"<>]{6,64}|(?<=[=:]\")[^\s\"<>]{6,64}")
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,64}(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]{1,64})+")
ANY_DIGIT = re.compile("[0-9]")
#: The first word or sign.
FIRST = re.compile(r"\A\s*(\w+|[^\w\s])")
#: The white space before signs that stand alone.
LONE_SIGNS = re.compile(r"\s+(?=[^\w\s]+(?:\s|$))")
#: Characters of context looked at on either side.
REACH = 48
MIN_CONFIDENCE = 0.9
MIN_SUPPORT = 5
ROUNDS = 3


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; looks only around each @, so long runs without one cost nothing."""
    out, done, at = [], 0, t.find("@")
    while at >= 0:
        a = at
        while a > done and t[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(t, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = t.find("@", done)
    return out


def ips(t: str) -> list[tuple[int, int]]:
    """A chain of dotted numbers holds a match for each four in a row."""
    out = []
    for m in DOTTED.finditer(t):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def base_spans(t: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    if not t:
        return []
    out = [("email", a, b) for a, b in emails(t)] if "@" in t else []
    if ANY_DIGIT.search(t):
        out += [("ip", a, b) for a, b in ips(t)]
        for m in DIGITS.finditer(t):
            if m.end() - m.start() >= 14 and 14 <= len(d := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in t:
            out += [("phone", *m.span()) for m in PHONE.finditer(t) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def access_keys(t: str) -> list[tuple[str, int, int]]:
    return [("secret", *m.span()) for m in ACCESS_KEY.finditer(t)] if "AKIA" in t or "ASIA" in t else []


def mixed(t: str) -> bool:
    """Whether t has letters and digits."""
    return bool(ANY_DIGIT.search(t)) and not t.isdigit()


def candidates(t: str, taken: list[tuple[str, int, int]]) -> list[tuple[list[str], int, int]]:
    """Other strings that could be an identifier, with the kinds that their shape allows, none for some numbers; none of them meets a seed."""
    found: list[tuple[list[str], int, int]] = []
    if "at)" in t or "at]" in t:
        found += [(["email"], *m.span()) for m in SPELLED.finditer(t)]
    for m in NUMBER.finditer(t):
        d = "".join(filter(str.isdigit, m.group()))
        n = len(d)
        if n >= 4:
            kinds = ["card"] * (13 <= n <= 19 and luhn(d)) + ["phone"] * (7 <= n <= 15) + ["ip"] * (m.group().count(".") == 3 and n <= 12)
            found.append((kinds, *m.span()))
    if "=" in t or ":" in t:
        found += [(["secret"], *m.span()) for m in GIVEN.finditer(t) if ANY_DIGIT.search(m.group())]
    found += [(["secret"], *m.span()) for m in HEX_RUN.finditer(t) if mixed(m.group())]
    out, k = [], 0
    taken = sorted(taken, key=lambda s: s[1])
    reach = 0
    for kinds, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        while k < len(taken) and taken[k][1] < b:
            reach = max(reach, taken[k][2])
            k += 1
        if a >= reach:
            out.append((kinds, a, b))
            reach = b
    return out


def patterns(t: str, start: int, end: int) -> list[str]:
    """The word before, the two words before, and the word before with the word or sign behind; digits are one sign. Signs that stand alone belong to the word before them, so `token = "` is one word."""
    left = [re.sub(r"[0-9]+", "9", w) for w in LONE_SIGNS.sub("", t[max(0, start - REACH) : start].lower()).split()[-2:]]
    right = [re.sub(r"[0-9]+", "9", w) for w in FIRST.findall(t[end : end + REACH].lower())]
    out = [f"W {left[-1]}"] if left else []
    out += ["L " + " ".join(left)] if len(left) == 2 else []
    return out + ([f"B {left[-1]} _ {right[0]}"] if left and right else [])


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


MENTION = "array<struct<start:long,end:long,kind:string,kinds:array<string>,instance:string,quoted:boolean,patterns:array<string>>>"


def extract(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The stored first pass: the columns in `keep`, row, n_email, n_ip, n_card, n_phone, base_sha256, seeds, mentions."""
    small_batches(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    df = docs.select(F.col(text).cast("string").alias("__text"), *keep)
    own = ", ".join(["n_email long, n_ip long, n_card long, n_phone long, base_sha256 string", "seeds array<struct<start:long,rank:int,kind:string,end:long>>", f"mentions {MENTION}"])
    from pyspark.sql.types import _parse_datatype_string

    schema = df.drop("__text").schema
    for f in _parse_datatype_string(own).fields:
        schema = schema.add(f)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = [arrow.field(k) for k in range(len(keep), len(arrow))]
        for s in slices(batches, "__text"):
            cols: list[list] = [[] for _ in range(7)]
            for t in s.column(0).to_pylist():
                base = base_spans(t)
                for k, kind in enumerate(KINDS):
                    cols[k].append(sum(x[0] == kind for x in base))
                cols[4].append(hashlib.sha256(digest(base).encode()).hexdigest())
                sure = base + access_keys(t) if t else base
                quoted = {m.span() for m in QUOTED_KEY.finditer(t) if mixed(m.group())} if t else set()
                cols[5].append([{"start": a, "rank": ALL_KINDS.index(k), "kind": k, "end": b} for k, a, b in sure])
                found = [(k, [], a, b) for k, a, b in sure] + [(None, kinds, a, b) for kinds, a, b in candidates(t, sure)] if t else []
                cols[6].append([{"start": a, "end": b, "kind": k, "kinds": ks, "instance": t[a:b].lower(), "quoted": (a, b) in quoted, "patterns": patterns(t, a, b)} for k, ks, a, b in found])
            yield pa.RecordBatch.from_arrays([*s.columns[1:], *(pa.array(c, f.type) for c, f in zip(cols, tail, strict=True))], names=arrow.names)

    return stored(df.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))


def mentions_of(found: DataFrame) -> DataFrame:
    return found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")


def instances(found: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE, min_support: int = MIN_SUPPORT, seed_values: int = SEED_VALUES) -> DataFrame:
    """(instance, kind, score, round): the seed values, of round 0, and what the rounds accepted. Each step is stored, so that no plan holds a round or more: the driver keeps plans, and their stages' broadcasts, in memory."""
    mention = mentions_of(found)
    few = mention.filter("quoted AND kind IS NULL").select("instance").distinct().orderBy(F.xxhash64("instance"), "instance").limit(seed_values)
    values = stored(few.select("instance", F.lit("secret").alias("kind"), F.lit(1.0).alias("score"), F.lit(0).alias("round")))
    sides = mention.select("instance", "kind", "kinds", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.min("kind").alias("kind"), F.max("kinds").alias("kinds"))
    own = F.broadcast(values.select("instance", F.col("kind").alias("given")))  # seed_values rows
    edges = stored(sides.join(own, "instance", "left").withColumn("kind", F.coalesce("kind", "given")).drop("given"))
    accepted = stored(edges.filter("kind IS NOT NULL").groupBy("instance").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("kind", F.lit(1.0))))).alias("scores")))
    new = values
    for number in range(1, rounds + 1):
        sure = stored(verdicts(edges.select("pattern", "instance", "kinds").join(accepted, "instance", "left"), min_confidence, min_support))
        open_ = edges.filter("kind IS NULL").select("pattern", "instance", "kinds").join(accepted, "instance", "left_anti")
        got = stored(judged(open_.join(sure, "pattern")).select("instance", "kind", "score"))
        if got.isEmpty():
            break
        new = new.unionByName(got.withColumn("round", F.lit(number)))
        accepted = accepted.unionByName(got.select("instance", F.create_map("kind", "score").alias("scores")))
    return new


def verdicts(edges: DataFrame, min_confidence: float, min_support: int) -> DataFrame:
    """(pattern, sure: its confidences by kind where it is sure, usual) of the patterns that are sure or usual. edges: pattern, instance, kinds, scores (by kind, null for open instances)."""
    # evidence against a kind: accepted instances of another one, and open ones whose shape excludes it; other open ones are no evidence
    known = F.count("scores").alias("known")
    each = [F.struct(F.lit(k).alias("k"), F.count(F.when(F.col("scores").isNull() & ~F.array_contains("kinds", k), 1)).alias("shut"), F.sum(F.col("scores")[k]).alias("s"), F.count(F.col("scores")[k]).alias("support")) for k in ALL_KINDS]
    size = edges.groupBy("pattern").agg(known, F.count("*").alias("total"), F.array(*each).alias("each"))
    scored = F.transform(F.filter("each", lambda x: x["support"] >= min_support), lambda x: F.struct(x["k"].alias("k"), (x["s"] / (F.col("known") + x["shut"])).alias("confidence")))
    sure = size.select("pattern", "total", F.filter(scored, lambda x: x["confidence"] >= min_confidence).alias("sure"))
    # the word before says little where the longer contexts are usual ones of their own and not sure
    usual = ~F.col("pattern").startswith("W ") & (F.col("total") >= min_support) & (F.size("sure") == 0)
    return sure.select("pattern", "sure", usual.alias("usual")).filter("usual OR size(sure) > 0")


def judged(edges: DataFrame) -> DataFrame:
    """(instance, kind, score): one kind for each instance that a sure pattern names: the most confident, then the first by name. edges: pattern, instance, kinds, sure, usual."""
    fits = F.transform(F.filter("sure", lambda x: F.array_contains("kinds", x["k"])), lambda x: F.struct((-x["confidence"]).alias("c"), x["k"].alias("k")))
    best, short = F.array_min("fits"), F.col("pattern").startswith("W ")
    each = edges.withColumn("fits", fits).groupBy("instance").agg(F.bool_or("usual").alias("doubtful"), F.min(F.when(~short, best)).alias("long"), F.min(F.when(short, best)).alias("short"))
    x = each.select("instance", F.when(F.col("doubtful"), F.col("long")).otherwise(F.least("long", "short")).alias("x")).filter("x IS NOT NULL")
    return x.select("instance", F.col("x.k").alias("kind"), (-F.col("x.c")).alias("score"))


def discover(found: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(row, added): the spans of the seed values and of accepted candidates in each row that has any."""
    new = instances(found, rounds, min_confidence, min_support)
    rank = F.element_at(F.create_map(*[F.lit(x) for k, name in enumerate(ALL_KINDS) for x in (name, k)]), F.col("kind"))
    hits = mentions_of(found).filter("kind IS NULL").drop("kind").join(new.select("instance", "kind"), "instance")
    return hits.groupBy("row").agg(F.collect_list(F.struct("start", rank.cast("int").alias("rank"), "kind", "end")).alias("added"))


def with_spans(found: DataFrame, added: DataFrame) -> DataFrame:
    """`found` with all spans, in order, as `all_spans` and written out as `spans`."""
    none = F.expr("cast(array() AS array<struct<start:long,rank:int,kind:string,end:long>>)")
    every = F.array_sort(F.concat("seeds", F.coalesce("added", none)))
    df = found.drop("mentions").join(small_side(stored(added)), "row", "left").withColumn("all_spans", every)
    return df.withColumn("spans", F.array_join(F.transform("all_spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","))


def personal_data(docs: DataFrame, rounds: int = ROUNDS, text: str = "text") -> DataFrame:
    """Per document: doc_id, the counts and digest of its seeds, and all spans as kind:start:end, comma-joined."""
    found = extract(docs, text)
    return with_spans(found, discover(found, rounds)).select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans")


def redact(docs: DataFrame, rounds: int = ROUNDS, text: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in angle brackets; of overlapping spans the first one names what they cover together. An n_chars column is counted anew; the others keep their values, whatever they are called."""
    return plainly(docs, {text, "n_chars"}, lambda d: _redacted(d, rounds, text))


def _redacted(docs: DataFrame, rounds: int, text: str) -> DataFrame:
    keep = [f"`{c}`" for c in docs.columns]
    found = extract(docs, text, keep)
    df = with_spans(found, discover(found, rounds)).select(*docs.columns, "all_spans")
    schema = docs.schema
    at, size = docs.columns.index(text), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, text):
            cols, texts = list(s.columns[:-1]), []
            for t, spans in zip(s.column(at).to_pylist(), s.column(s.num_columns - 1).to_pylist(), strict=True):
                parts, done = [], 0
                for x in spans or []:
                    if x["start"] >= done:
                        parts += [t[done : x["start"]], f"<{x['kind'].upper()}>"]
                    done = max(done, x["end"])
                texts.append("".join([*parts, t[done:]]) if parts else t)
            cols[at] = pa.array(texts, cols[at].type)
            if size is not None:
                cols[size] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, names=s.schema.names[:-1])

    return df.mapInArrow(run, schema)
