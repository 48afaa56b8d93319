from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline as P
from pulsegrid.llm.common import stored

from ..conftest import SF
from .test_pages_pii_pairs import brute_classes, brute_hits, brute_links, brute_spans


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    named = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "pii", "best_fit_packing"]
    a = stored(named["language_id"](spark, docs, SF))
    assert a.columns == docs.columns and a.count() >= 0.99 * docs.count()
    one = a.collect()
    b = stored(named["ngram_jaccard_join"](spark, a, SF))
    classes = brute_classes([r.doc_id for r in one], brute_links([r.text for r in one]))
    assert sorted(r.doc_id for r in b.collect()) == sorted(set(classes))
    c = stored(named["benchmark_decontamination"](spark, b, SF))
    assert sorted(r.doc_id for r in c.collect()) == sorted(x[0] for x in brute_hits([(r.doc_id, r.text) for r in b.collect()], bench) if not x[5])
    d = stored(named["pii"](spark, c, SF))
    assert d.columns == docs.columns and d.count() == c.count() and not any(brute_spans(r.text) for r in d.collect())
    e = named["best_fit_packing"](spark, d, SF).collect()
    assert {r.doc_id for r in e} == {r.doc_id for r in d.select("doc_id").collect()}
    assert len(P.run(spark, SF).collect()) == len(e)


def test_rejection(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    more = spark.createDataFrame([(-1, "123 456", "en", "s", 7), (-2, None, "en", "s", None)], df.schema)
    left = P.identify_language(spark, df.unionByName(more), SF)
    assert not [r for r in left.collect() if r.doc_id < 0] and all(re.search(r"\w", r.text) for r in left.collect())


def test_columns_with_clashing_names_stay(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for name in ("lang_pred", "score", "sid", "class_id", "row", "seeds", "spans", "all_spans", "text_hash", "a.b"):
        d = d.withColumn(name, F.lit("own"))
    for stage in (P.identify_language, P.drop_near_copies, P.redact_personal_data):
        out = stage(spark, d, SF)
        assert out.columns == d.columns
        got = out.collect()
        assert got and all(r["a.b"] == r["row"] == r["spans"] == "own" for r in got)
