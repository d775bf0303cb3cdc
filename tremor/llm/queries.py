"""Queries of the problems on text and training data, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import encoding, linkage, mapping, mixture, residue
from tremor.plans.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose machine is in the machine list."""
    return p2_matches(spark, sf_dir).select("cell_id", "normalized_tag")


def p2_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machines of all cells with their confidence."""
    return linkage.link_cells(table(spark, sf_dir, "matrix_cells"), table(spark, sf_dir, "crosswalk"))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_points(table(spark, sf_dir, "points"), table(spark, sf_dir, "reference_items"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every typed value with the item it means."""
    return _mapped(spark, sf_dir).select("record_num", "slot", "ref_id")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values that mean no item, with how often each is typed."""
    return _mapped(spark, sf_dir).where("ref_id = 0").groupBy((F.col("slot") == 0).alias("is_name"), "typed").agg(F.count("*").alias("n"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encoding.encode_documents(table(spark, sf_dir, "documents"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected documents of every mix."""
    return mixture.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares asked for and reached."""
    return mixture.mix_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are template residue, padding or a message in place of content."""
    return residue.residue_documents(table(spark, sf_dir, "documents")).select("doc_id")


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without them."""
    return residue.clean_corpus(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "doc_type", "n_chars", "text")


QUERIES = {
    "p2_found": p2_found,
    "p2_matches": p2_matches,
    "p3_found": p3_found,
    "p3_unmatched": p3_unmatched,
    "p6_ids": p6_ids,
    "p7_mixture": p7_mixture,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_clean": p8_clean,
}
#: None of them: each needs state, dynamic programming or a tokenizer, which SQL can't express.
SQL: dict[str, str] = {}
