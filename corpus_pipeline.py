"""Corpus pipeline: language ID, near-dedup, sanitising, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``, in their order and with their types; further columns,
whatever their names, are carried along. An empty table stays one. Intermediate tables stay in the work folder until
``tidemill.session.clear_work``, as results may still read them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import language, mixing, packing, pii, simhash
from tidemill.session import materialize

#: A document is rejected if no language is found in it, or if the one found contradicts its label this clearly.
CONTRADICTED = 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned; label those without a label.

    Null, empty and letterless texts have no language and go, and so does a text that contradicts its label at a score of
    CONTRADICTED or more. It learns from the labels that it judges (a bounded sample), so an error that most documents
    of a label share isn't seen. Without any label all documents go. Repeated rows share one decision; null ids stay.
    """
    label = language.labeller(docs)
    found = docs.select(F.struct(*docs.columns).alias("row"), label(F.col("text")).alias("found"))
    lang, pred = F.col("row.lang"), F.col("found.lang_pred")
    wrong = F.coalesce(lang != pred, F.lit(False)) & (F.col("found.score") >= CONTRADICTED)
    kept = found.where((pred != language.UNDETERMINED) & ~wrong)
    return kept.select(*[F.coalesce(lang, pred).alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: that of the smallest id, the first met of several with it.

    Null and empty texts are copies of each other; a null id comes after all others.
    """
    return simhash.keep_one(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data and what discloses it; n_chars follows the text. Every row stays, null texts and repeated rows as well."""
    return with_length(pii.sanitise(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents as often as the curriculum does, in ranges of training position; n_chars follows the text.

    Texts without words (null and empty ones too) are never taken; a null source is a source; repeated rows each count.
    """
    return with_length(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack into sequences. A null text is an empty one, which has one token, the end; repeated rows are packed each."""
    return packing.pack(docs)


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("sanitise", sanitise),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Fingerprints, learned weights and tokenizers can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
