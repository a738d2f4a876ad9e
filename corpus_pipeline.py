"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; between stages the rows are written and read again. All stages but the
last return the columns of `documents`.

Defined results: texts that are NULL or hold no letter go at language ID; a
NULL id is carried through (two rows of one text and id share one verdict at
line dedup and near-dedup); sources that are NULL are a source of their own;
repeated rows are as many documents until near-dedup leaves one; very long
texts are read whole by every stage; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoset.llm import language_id, line_dedup, minhash, mixing, sentencepieces
from chronoset.llm.catalog import piece_model
from chronoset.llm.common import documents, staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is near a known language; texts without a letter and far-off ones go."""
    said = language_id.identified(docs, language_id.fitted(docs))
    return said.where("not rejected").select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere before; n_chars follows. Rows that were nothing else go."""
    cut = line_dedup.line_deduped(docs)
    blank = F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) == ""
    kept = cut.where((F.size("removed") == 0) | ~blank)
    chars = F.when(F.size("removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(*docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, a row for each document taken."""
    return sentencepieces.digests(sentencepieces.encoded(docs.select("doc_id", "text"), piece_model(), keep_text=False))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("minhash_near_dedup", remove_near_copies),
    ("mix_sources", mix_sources),
    ("sentencepieces", to_pieces),
]

#: No SQL: the first three stages hash and classify in ways SQL has no words for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written rows of the one before."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
