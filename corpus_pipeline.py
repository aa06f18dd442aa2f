"""A training-data pipeline: stages that filter or rewrite documents, ending in token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import decontaminate, langid, minhash, pii, queries, sentencepiece_codec

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near-duplicates have a similarity of 0.8 or more on shingles of five words; op9 has its own 0.85.
#: The estimate's standard deviation is 0.0188 there, so 4.5 of them are a wider margin than op9's.
NEAR = minhash.Settings(percent=80, margin=0.085)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among the dropped ones; a null doc_id stays."""
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter. `lang` becomes the
    predicted language of the others."""
    model = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    shown = langid.predict_rows(docs, model)
    return shown.where(F.col("lang_pred") != langid.UNDETERMINED) \
        .withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each near-duplicate group."""
    return _without(docs, minhash.groups(docs, settings=NEAR).where(~F.col("kept")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap with a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.overlaps(docs, items))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; n_chars follows the text."""
    cleaned = pii.redact_rows(docs, pii.fit(docs))
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document, with digests of ids and decoded text."""
    return sentencepiece_codec.tokens(docs, queries.piece_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Backtracking encoding, a fitted classifier and message passing have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over documents; each result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = session.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
