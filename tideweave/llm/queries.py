"""One query per operator, applied with production parameters to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideweave.llm import langid, quality
from tideweave.llm.exact_dedup import exact_groups
from tideweave.llm.lm import score
from tideweave.llm.minhash import near_duplicates
from tideweave.llm.mixing import mix
from tideweave.llm.packing import pack
from tideweave.llm.pii import pseudonymise
from tideweave.llm.sstable import round_trip
from tideweave.llm.warc import archive_round_trip


def tokenizer_path() -> str:
    """The vocabulary file the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


#: For the synthetic tables alone; the operator has no key of its own.
TEST_KEY = "synthetic tables"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents"), TEST_KEY)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archive_round_trip(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op10_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_quality_rules": op4_quality_rules,
        "op5_pii": op5_pii,
        "op6_language_id": op6_language_id,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_warc": op8_warc,
        "op9_mixing": op9_mixing,
        "op10_sstable": op10_sstable,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": """
            WITH t AS (
                SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
                FROM documents
            )
            SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size,
                   doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
                   sha256(norm) AS text_sha256
            FROM t
        """,
        "op8_warc": """
            WITH t AS (
                SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
            ), u AS (
                SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS least FROM t
            )
            SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
                   CASE WHEN least IS NULL OR least = page_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN least <> page_id THEN least END AS refers_to
            FROM u
        """,
    }
