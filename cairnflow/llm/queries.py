"""Queries of the text problems 7 to 9 on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.llm import leakage, packing, quality
from cairnflow.session import table


def p7_windows(spark: SparkSession, d: str) -> DataFrame:
    """The assignment of every document to windows of every capacity."""
    return packing.pack(table(spark, d, "documents"), table(spark, d, "pack_capacities"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_windows(spark, d).where("piece = 0 AND n_pieces > 1").select("capacity_id", "doc_id")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: windows, tokens and the share of the windows' room that is used."""
    used = p7_windows(spark, d).groupBy("capacity_id", "window_id").agg(F.sum("n_tokens").alias("n_tokens"))
    per = used.groupBy("capacity_id").agg(F.count("*").alias("n_windows"), F.sum("n_tokens").alias("n_used"))
    return per.join(table(spark, d, "pack_capacities").select("capacity_id", F.col("n_tokens").alias("room")), "capacity_id").select(
        "capacity_id", "n_windows", "n_used", (F.col("n_used") / (F.col("n_windows") * F.col("room"))).alias("fill")
    )


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"), table(spark, d, "common_words"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Per evaluation item: in how many documents it leaked."""
    n = p8_found(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    return table(spark, d, "eval_items").select("item_id", "suite").distinct().join(n, "item_id", "left").select("item_id", "suite", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.statistics(table(spark, d, "documents"), table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(_stats(spark, d)).select("doc_id")


def p9_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.scored(_stats(spark, d))


def p9_sketches(spark: SparkSession, d: str) -> DataFrame:
    return quality.sketches(_stats(spark, d))


QUERIES = {f.__name__: f for f in (p7_found, p7_windows, p7_fill, p8_found, p8_items, p9_found, p9_stats, p9_sketches)}

ORACLE = {
    "p7_found": "SELECT DISTINCT c.capacity_id, d.doc_id FROM (SELECT doc_id, max(octet_length(encode(text)) + 1) AS n FROM documents WHERE text IS NOT NULL GROUP BY doc_id) d JOIN pack_capacities c ON d.n > c.n_tokens",
}
