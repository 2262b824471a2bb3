"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.decontaminate import find_leaks
from tidemark.llm.language import identify_language
from tidemark.llm.licenses import PATH_SQL, check_sql, scan_licenses
from tidemark.llm.line_dedup import remove_repeats
from tidemark.llm.mixing import mix_sources
from tidemark.llm.quality import JUDGE_SQL, judge_quality
from tidemark.llm.secrets import find_secrets
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.spelling import group_variants, variants_sql
from tidemark.llm.suffix_dedup import remove_earlier_strings
from tidemark.llm.syncmers import edits_sql, fingerprint_edits
from tidemark.llm.tokenizer_alignment import align_tokens
from tidemark.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(function):
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return register


@query("op8_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))


@query("op5_line_frequency_quality", JUDGE_SQL)
def line_frequency_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents"))


@query(
    "op9_warc_round_trip",
    """
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
g AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d FROM p),
m AS (SELECT *, MAX(page_id) OVER (PARTITION BY d) AS largest FROM g)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM m""",
)
def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    archives = write_archives(table(spark, folder, "pages"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read_archives(archives, with_payload=False).select(*columns)


@query("op1_repeated_units")
def repeated_units(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


@query("op2_simhash_components")
def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query("op7_language_models")
def language_models(spark: SparkSession, folder: str) -> DataFrame:
    return identify_language(table(spark, folder, "documents"))


@query("op6_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_entropy_balanced_mix")
def entropy_balanced_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))


@query("op10_suffix_repeats")
def suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_earlier_strings(table(spark, folder, "documents"))


@query("op3_license_scan", check_sql())
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scan_licenses(docs.select("doc_id", "text", F.expr(PATH_SQL).alias("path")))


@query("op11_syncmer_fingerprints", edits_sql())
def syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_edits(table(spark, folder, "documents"))


@query("op12_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents"))


@query("op13_spelling_variants", variants_sql())
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return group_variants(table(spark, folder, "documents"))
