"""The documents' way through five stages: language, near copies, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() writes each result as Parquet in
the shared folder and reads it again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, jaccard_join, language_id, packing, pii
from pulsegrid.llm.common import plainly, stored, table
from pulsegrid.llm.queries import vocabulary

#: Below this score no language accepts the text: its best output is under -0.4 on the scale from -1 to 1.
LEAST_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or that no language accepts, go; `lang` becomes the prediction."""
    model = language_id.fit(docs)

    def accepted(docs: DataFrame) -> DataFrame:
        found = language_id.predict(docs, model, keep=docs.columns)
        kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
        return kept.withColumn("lang", F.col("lang_pred"))

    return plainly(docs, {"doc_id", "text", "lang"}, accepted)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least doc_id stays."""
    return jaccard_join.drop_near_duplicates(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark windows go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes the name of its kind; n_chars follows."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json"), max_tokens=2048), packing.Capacity())


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack_sequences),
]
#: Language, personal data and packing aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
