from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from pulsegrid.llm import language_id, packing, quality_knn, quality_rules, token_counts
from pulsegrid.llm.common import ngram_hashes, slices, words_of
from pulsegrid.llm.queries import QUERIES, vocabulary
from pulsegrid.llm.token_ids import WordBpe

from ..conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, " ", "\n\n", "a", "a b", "É.É,É İI ﬁ ≠ .̸", "it's don't're <|endoftext|>", "a\x1cb\x85c d　e", "x" * 5000, "ab " * 3000, "a\nb\na\n\na", "  lead", "trail \n", "ΑΣ. ΣΑΣ", "123.456", "\x00\x7f"]


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCS)


def test_slices_and_words():
    a = pa.record_batch({"text": pa.array(ODD)})
    parts = list(slices(iter([a]), "text", 100))
    assert sum(p.num_rows for p in parts) == len(ODD) and pa.Table.from_batches(parts).column("text").to_pylist() == ODD
    w, _, _ = words_of(a.column(0).slice(3))
    names = w.unique.to_pylist()
    for k, t in enumerate(ODD[3:]):
        got = [names[c] for c in w.codes[w.first[k] : w.first[k + 1]]]
        assert got == re.findall(r"[^\x20\x09-\x0D]+", t)


def test_ngram_windows():
    h = np.arange(7, dtype=np.uint64)
    out, start = ngram_hashes(h, np.array([0, 0, 2, 7]), 3)
    assert start.tolist() == [0, 0, 1, 4] and len(set(out.tolist())) == 4


@pytest.mark.parametrize("cache", [3, 10**6])
def test_token_ids_equal_the_library(cache):
    r = random.Random(5)
    texts = [*ODD, *["".join(r.choice("aàbEé.,'&$ \n\t12st—́<|>") for _ in range(r.randint(0, 60))) for _ in range(400)]]
    bpe = WordBpe(vocabulary("word_bpe_49k.json"), cache)
    for part in (texts[:200], texts[200:]):
        ids, off = bpe.encode(pa.array(part))
        for k, t in enumerate(part):
            assert bpe.tok.encode(t or "", add_special_tokens=False).ids == ids[off[k] : off[k + 1]].tolist()


def check_packing(spark, rows, docs, cap):
    own = {}
    bpe = WordBpe(vocabulary("word_bpe_49k.json"))
    for d in docs.collect():
        ids = [*bpe.tok.encode(d.text or "", add_special_tokens=False).ids, 0]
        own.setdefault(d.doc_id, []).append(ids)
    seqs = {}
    for r in rows:
        ids = own[r.doc_id][0]
        assert 0 < r.length <= cap and r.start == r.piece * cap
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(x) for v in own.values() for x in v)
    for spans in seqs.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= cap
    return len(seqs)


def test_packing(spark):
    docs = table(spark, [*ODD, *["word " * k for k in range(0, 300, 7)]], [None, *range(1, len(ODD)), *range(100, 143)])
    for rule in ("norm", "dot"):
        parts = packing.pieces(docs, vocabulary("word_bpe_49k.json"), 64)
        n = check_packing(spark, packing.pack(parts, packing.Capacity(64, 64, 64 * 64), rule=rule).collect(), docs, 64)
        assert n <= 1.05 * parts.agg({"length": "sum"}).first()[0] / 64 + 1
    few = packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json"), 64), packing.Capacity(64, 2, 64 * 64)).groupBy("sequence_id").count()
    assert few.agg({"count": "max"}).first()[0] <= 2
    assert packing.pack(packing.pieces(docs.limit(0), vocabulary("word_bpe_49k.json"))).count() == 0
    whole = packing.sequences(packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json"), 64, with_ids=True), packing.Capacity(64, 64, 4096))).collect()
    assert all(len(r.ids) <= 64 and len(r.doc_ids) == len(r.offsets) for r in whole)


def test_packing_query(spark, results):
    _, rows = results("op5_best_fit_packing")
    n = check_packing(spark, rows, spark.read.parquet(f"{SF}/documents.parquet"), 2048)
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_token_counts(spark):
    path = vocabulary("byte_bpe_50k.tiktoken")
    docs = table(spark, [*ODD, "naïve\nzwölf\n\nend 🙂🙂\n"])
    enc, size = token_counts.encoder(path, public_tokenizers.PATTERN)
    for rule in token_counts.RULES:
        rows = token_counts.section_token_counts(docs, path, public_tokenizers.PATTERN, rule).collect()
        for d in docs.collect():
            own = sorted((r for r in rows if r.doc_id == d.doc_id), key=lambda r: r.section)
            text = d.text or ""
            lines = text.splitlines(keepends=True) if "\n" in text and not re.search("[\x1c\x85]", text) else [text]
            assert [text[r.start : r.end] for r in own] == lines
            ids = enc.encode_ordinary(text)
            assert sum(r.n_tokens for r in own) == len(ids)
            # brute force: walk over the bytes
            starts = [len("".join(lines[:k]).encode()) for k in range(len(lines))]
            at, want = 0, Counter()
            for t in ids:
                held = Counter(max(k for k, s in enumerate(starts) if s <= b) for b in range(at, at + size[t]))
                k = {"first": min(held), "last": max(held), "most": min(held, key=lambda k: (-held[k], k))}[rule]
                want[k] += 1
                at += size[t]
            assert [r.n_tokens for r in own] == [want[k] for k in range(len(lines))]
    fields = token_counts.field_token_counts(docs, ["lang", "text", "source"], path, public_tokenizers.PATTERN).filter("doc_id = 4").orderBy("section").collect()
    assert [(r.start, r.end) for r in fields] == [(0, 3), (3, 5), (5, 6)] and sum(r.n_tokens for r in fields) == len(enc.encode_ordinary("en\na\ns"))
    assert token_counts.section_token_counts(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def brute_rules(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_quality_rules_counts(spark):
    r = random.Random(3)
    texts = [*ODD, *["".join(r.choice(["a ", "b ", "é#", "\n", "a b c ", "|"]) for _ in range(r.randint(0, 80))) for _ in range(200)]]
    docs = table(spark, texts)
    rows = quality_rules.score(docs, np.zeros(16)).orderBy("doc_id").collect()
    for t, x in zip(texts, rows, strict=True):
        n, chars, marks, dup, rep = brute_rules(t)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (n, chars, marks, dup, rep)
        assert x.base_failed == (n < 50 or 100 * rep > 50 * n) and x.kept == (not x.base_failed)
    assert quality_rules.score(docs.limit(0), np.zeros(16)).count() == 0


def test_log_ratios_equal_brute_force(spark):
    docs = table(spark, ["good words here", "bad bad bad", None, "good words"])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (3, 1, 0), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    marked = quality_rules.trusted(docs, labels)
    assert sorted((x.text or "", x.trusted) for x in marked.collect()) == [("", False), ("bad bad bad", False), ("good words", False), ("good words here", True)]
    got = quality_rules.log_ratios(quality_rules.ngram_counts(marked, 1 << 10), 1 << 10, 1.0)
    w, _, _ = words_of(pa.array(["good words here"]))
    b, _ = quality_rules.buckets(w.unique, w.codes, w.first, 1 << 10)
    raw, tgt = 5 + 3 + 3 + 2 + 1 - 0, 5
    raw = 3 + 2 + 3 + 2 + 2 + 1
    own = 1.0 * tgt / raw
    want = np.log((1 + own) / (tgt + own * 1024)) - np.log((np.array([2, 2, 1, 2, 1]) + 1) / (raw + 1024))
    assert np.allclose(sorted(got[b]), sorted(want))
    assert not quality_rules.log_ratios(quality_rules.ngram_counts(marked.withColumn("trusted", marked.trusted & (marked.text == "")), 64), 64).any()


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    rows = language_id.predict(docs.withColumn("score_", docs.n_chars), model, keep=["doc_id", "lang"]).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in rows)
    odd = language_id.predict(table(spark, ODD), model).orderBy("doc_id").collect()
    for t, r in zip(ODD, odd, strict=True):
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, t or "")))
    assert language_id.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in language_id.predict(table(spark, ["abc", None]), None).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_driver_unpacks_few_rows_of_the_sample_at_once(spark):
    """1,200 texts are 79 MB as rows of the kernel; packed, as they come, they are 2.5 MB."""
    import tracemalloc

    df = spark.createDataFrame([(k, f"{'the of and' if k % 2 else 'der die und'} {k} {k * k}", "en" if k % 2 else "de") for k in range(1500)], "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        model = language_id.fit(df, per_language=600)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ["de", "en"] and model.landmarks.shape[0] == language_id.SLOTS
    assert peak < 50e6, peak


def test_presence_equals_brute_force():
    text = "Ab1 é  zz!"
    folded = re.sub(r"[\x00-\x7f]", lambda m: m.group().lower() if m.group().isalpha() else " ", text)
    b = re.sub(" +", " ", folded).encode()
    want = np.zeros(language_id.SLOTS, bool)
    for n, m in enumerate(language_id.MULTIPLIERS):
        for k in range(len(b) - n):
            want[(int.from_bytes(b[k : k + n + 1], "big") * m % 2**32) >> 18] = True
    assert (language_id.presence(np.frombuffer(text.encode(), np.uint8)) == want).all()


def test_quality_neighbours(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_knn.fit(docs, labels)
    rows = {r.doc_id: r for r in quality_knn.score(docs, model).collect()}
    known = [r for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(rows[r.doc_id].predicted == r.quality for r in known) >= 0.9 * len(known)
    odd = quality_knn.score(table(spark, ODD), model).orderBy("doc_id").collect()
    assert len(odd) == len(ODD) and odd[0].score == odd[1].score == 0 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in odd)
    # the blocked products give the votes of a plain search
    texts = [r.text for r in docs.limit(40).collect()]
    x = quality_knn._unit(quality_knn.weighted(quality_knn.term_counts(pa.array(texts)), model.idf) @ model.axes)
    got = [rows[r.doc_id].score for r in docs.limit(40).collect()]
    for v, s in zip(x, got, strict=True):
        c = v @ model.vectors
        near = sorted(range(len(c)), key=lambda k: -c[k])[: quality_knn.NEIGHBOURS]
        w = [max(c[k], 0) ** quality_knn.SHARPNESS + 1e-12 for k in near]
        assert abs(sum(a * model.labels[k] for a, k in zip(w, near, strict=True)) / sum(w) - s) < 1e-3
    assert quality_knn.fit(docs.limit(0), labels) is None
    assert {r.score for r in quality_knn.score(table(spark, ["a"]), None).collect()} == {0.0}


def test_language_scores_equal_plain_kernel_ridge(spark):
    """With every training text a landmark the scores are those of one-versus-rest kernel ridge regression on the set kernel."""
    import random

    r = random.Random(5)
    sounds = {"aa": "abcde", "bb": "cdefgh", "cc": "hijkl"}
    text = lambda lang: " ".join("".join(r.choice(sounds[lang]) for _ in range(r.randint(2, 6))) for _ in range(r.randint(3, 30)))
    docs = [(k, text(lang), lang) for k, lang in enumerate(r.choice(list(sounds)) for _ in range(60))]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    got = {x.doc_id: (x.lang_pred, x.score) for x in language_id.predict(df, model).collect()}

    sets = {k: set(np.flatnonzero(language_id.presence(np.frombuffer(t.encode(), np.uint8)))) for k, t, _ in docs}
    train = [k for k, _, _ in docs if zlib.crc32(str(k).encode()) % 5]
    kernel = lambda a, b: len(sets[a] & sets[b]) / (len(sets[a]) * len(sets[b])) ** 0.5
    names = sorted({docs[k][2] for k in train})
    gram = np.array([[kernel(a, b) for b in train] for a in train])
    y = np.array([[1.0 if docs[k][2] == n else -1.0 for n in names] for k in train])
    alpha = np.linalg.solve(gram + 1e-2 * len(train) / 100 * np.eye(len(train)), y)
    for k, _, _ in docs:
        out = np.array([kernel(k, b) for b in train]) @ alpha
        assert got[k][0] == names[int(out.argmax())]
        assert abs(got[k][1] - min(1, max(0, (out.max() + 1) / 2))) < 1e-3


def test_rules_verdict_equals_brute_force(spark, results):
    import math

    import xxhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good, bad = set(), set()
    for x in labels.collect():
        (good if x.quality == 1 else bad).add(x.doc_id)
    whole = (1 << 64) - 1

    def mixed(h):
        for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = ((h ^ (h >> 33)) * m) & whole
        return h ^ (h >> 33)

    def grams(t):
        h = [xxhash.xxh64_intdigest(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        two = [mixed((a * int(quality_rules.FAR) + b) & whole) for a, b in zip(h, h[1:])]
        return [x % quality_rules.BUCKETS for x in [*h, *two]], len(h)

    each = {x.doc_id: grams(x.text) for x in docs.collect()}
    raw, target = Counter(), Counter()
    for i, (b, _) in each.items():
        raw.update(b)
        if i in good - bad:
            target.update(b)
    n, t, s, size = sum(raw.values()), sum(target.values()), quality_rules.SMOOTHING, quality_rules.BUCKETS
    own = s * t / n
    ratio = {b: math.log((target[b] + own) / (t + own * size)) - math.log((raw[b] + s) / (n + s * size)) for b in raw}
    for x in results("op3_quality_rules")[1]:
        b, words = each[x.doc_id]
        llr = sum(ratio[k] for k in b) / max(len(b), 1)
        assert abs(x.llr - llr) < 1e-9
        failed = words < 50 or 100 * x.n_repeat_words > 50 * words
        assert x.base_failed == failed and (abs(llr - quality_rules.THRESHOLD) < 1e-9 or x.kept == (not failed and llr >= quality_rules.THRESHOLD))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_covers_its_table(spark, results, name):
    of = {"op4_html_extraction": ("page_id", "pages"), "op7_warc_round_trip": ("page_id", "pages"), "op11_embedding_whitening": ("vec_id", "embeddings"), "op12_code_compression": ("vec_id", "embeddings")}
    key, table = of.get(name, ("doc_id", "documents"))
    want = {x[0] for x in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = [x[key] for x in results(name)[1]]
    assert set(got) == want
    assert len(got) == len(want) * {"op11_embedding_whitening": 4}.get(name, 1) or name in ("op2_token_counts", "op5_best_fit_packing")


def test_ties_between_neighbours_go_to_the_first():
    import numpy as np

    from pulsegrid.llm.quality_knn import nearest

    rng = np.random.default_rng(4)
    cosine = rng.integers(0, 4, (50, 80)).astype(np.float32)
    cosine[0] = 1
    for row, got in zip(cosine, nearest(cosine, 15)):
        assert sorted(got) == sorted(np.argsort(-row, kind="stable")[:15])
