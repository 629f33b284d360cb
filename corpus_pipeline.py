"""From raw documents to a training mix: five stages, each written and read again.

The stages, in order: quality rules, line dedup, n-gram Jaccard join, benchmark
decontamination, mixing to target weights. Each works on all rows that the one
before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, line_dedup, mixing, ngram_join, quality
from tidemark.llm.common import fresh_folder, stored, table, word_count
from tidemark.llm.queries import MAX_EPOCHS, MIX_WEIGHTS

# Connected classes of similar lines and documents, word by word cuts: tested against a plain version instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their bad lines."""
    return quality.cleaned(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each class of equal or similar lines once; a document of which no word is left goes."""
    rows = line_dedup.dedup_lines(docs)
    rows = rows.where((rows["_n_removed"] == 0) | (word_count(rows["text"]) > 0))
    return line_dedup.recounted(rows, rows["_n_removed"] > 0).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return ngram_join.one_of_each(docs).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that the benchmark holds; mostly copied documents go."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents it takes words of, with how many, repeats counted."""
    return mixing.mixed(docs, MIX_WEIGHTS, MAX_EPOCHS).where("taken > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    folder, docs = fresh_folder(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
