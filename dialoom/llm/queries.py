"""The queries of the language-model problems (1, 6, 7 and 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.tables import table
from . import bpe, mojibake, packing, pair_defects


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each defective prompt-response pair with its defect."""
    return pair_defects.flag_pairs(table(spark, d, "prompt_response_content"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of each document."""
    return bpe.encode_corpus(table(spark, d, "documents"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of each document, or part of one, per profile."""
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_profiles"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers and unused space per profile."""
    return packing.container_report(p7_containers(spark, d), table(spark, d, "pack_profiles"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents with a wrongly decoded stretch."""
    return mojibake.find_garbled(table(spark, d, "documents")).select("doc_id")


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    """The garbled documents with their text as far as it can be regained."""
    return mojibake.find_garbled(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p6_ids, p7_containers, p7_report, p8_found, p8_restored)}
ORACLE: dict[str, str] = {}
