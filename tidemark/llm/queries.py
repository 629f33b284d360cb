"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontam,
    html_extract,
    line_dedup,
    lm_score,
    merkle,
    mixing,
    ngram_join,
    pii,
    quality,
    repair,
    url_filter,
    warc,
)
from tidemark.llm.common import fresh_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed by the task: rules by host and path.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
# Sites whose pages a block list would hold; the list of their URLs is taken from the pages.
LISTED_SITES = ["cheap-pills", "spam-farm", "casino-win"]
MIX_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@query
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumnsRenamed({"_n_lines": "n_lines", "_n_removed": "n_removed"})


@query
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MAX_EPOCHS)


@query
def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archive(table(spark, sf_dir, "pages"), f"{fresh_folder(spark)}/archive")
    return warc.read_index(spark, folder)


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    site = F.regexp_extract(url_filter.url_host(F.col("url")), r"([^.]+)\.example\.", 1)
    return url_filter.judge_urls(pages, pages.where(site.isin(LISTED_SITES)), URL_RULES)


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audits(repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
