"""Readers for the benchmark tables and the derived fixtures the queries run on.

Every fixture is a lazy projection/join of the given Parquet tables, so its size grows with them.
Missing values are injected by key arithmetic (no NULLs exist in the given tables), with the same
expressions the DuckDB oracle uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def missing(key: str, mod: int, value: Column) -> Column:
    """``case when key % mod = 0 then null else value end``."""
    return F.when(F.col(key) % mod == 0, F.lit(None)).otherwise(value)


def parts_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: p_partkey, p_size (missing when key % 7 = 0), p_retailprice (missing when key % 5 = 0)."""
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey",
                    missing("p_partkey", 7, F.col("p_size").cast("double")).alias("p_size"),
                    missing("p_partkey", 5, F.col("p_retailprice")).alias("p_retailprice"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents, with ``score = least(1, n_chars / 2000)``."""
    lab = read(spark, sf_dir, "labels")
    doc = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", "quality", "toxic", "lang", "source", "n_chars",
        F.least(F.lit(1.0), F.col("n_chars") / F.lit(2000.0)).alias("score"))


def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, ``quality`` missing where the document has no label or doc_id % 13 = 0."""
    lab = read(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return doc.join(lab, "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars", missing("doc_id", 13, F.col("quality")).alias("quality"))


# The recipes' tables, as expressions that Spark and DuckDB read alike (FIXTURES.md section 4).
PASSENGER = {
    "gender": "CASE o_orderstatus WHEN 'F' THEN 'Male' WHEN 'O' THEN 'Female' END",
    "cabin": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN c_nationkey % 4 = 0 THEN 'Crew' WHEN c_nationkey % 4 = 1 THEN 'C3' "
             "WHEN c_nationkey % 4 = 2 THEN 'C2' ELSE 'C1' END",
    "port": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_mktsegment END",
    "age": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_acctbal END",
    "fare": "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN o_totalprice * 50 ELSE o_totalprice END",
    "y": "CAST(o_orderpriority = '1-URGENT' AS INTEGER)",
}
CUSTOMER = {
    "os": "CASE WHEN event_id % 11 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END",
    "isp": "CAST(user_id % 10 AS STRING)",
    "experience": "CASE event_type WHEN 'click' THEN 'low' WHEN 'view' THEN 'medium' WHEN 'purchase' THEN 'high' END",
    "gender": "CASE WHEN user_id % 3 = 0 THEN 'Male' ELSE 'Female' END",
    "age": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(18 + user_id % 60 AS DOUBLE) END",
    "time_spent": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END",
    "y": "CAST(event_id % 3 = 0 AS INTEGER)",
}
HOMERUN = {
    "home_team": "lang",
    "batter_team": "source",
    "away_team": "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat(lang, '-', source) END",
    "batter_name": "CAST(doc_id % 50 AS STRING)",
    "pitcher_name": "CAST(doc_id % 31 AS STRING)",
    "bb_type": "CAST(quality AS STRING)",
    "bearing": "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE CAST(n_chars % 4 AS STRING) END",
    "launch_speed": "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(n_chars AS DOUBLE) END",
    "launch_angle": "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(doc_id * 37 % 181 - 90 AS DOUBLE) END",
    "y": "toxic",
}


def _derived(df: DataFrame, key: str, columns: dict) -> DataFrame:
    return df.select(key, *[F.expr(e).alias(c) for c, e in columns.items()])


def passenger_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer with the columns of recipe A's table."""
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return _derived(o.join(c, o["o_custkey"] == c["c_custkey"]), "o_orderkey", PASSENGER)


def customer_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the columns of recipe B's table."""
    return _derived(read(spark, sf_dir, "events"), "event_id", CUSTOMER)


def homerun_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents x labels with the columns of recipe C's table."""
    doc = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return _derived(doc.join(read(spark, sf_dir, "labels"), "doc_id"), "doc_id", HOMERUN)


def wide_gaps(spark: SparkSession, sf_dir: str, dims: int = 9) -> DataFrame:
    """embeddings: vec_id and the first ``dims`` coordinates, three in ten of them missing by key arithmetic."""
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", *[F.expr(f"CASE WHEN (vec_id * {2 * i + 3} + {i}) % 10 < 3 THEN NULL "
                                       f"ELSE CAST(embedding[{i}] AS DOUBLE) END").alias(f"e{i}") for i in range(dims)])


def embedding_points(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """embeddings: vec_id, the first ``dims`` coordinates as doubles, y = label >= 5."""
    e = read(spark, sf_dir, "embeddings")
    return e.select("vec_id", *[F.element_at("embedding", i + 1).cast("double").alias(f"e{i}") for i in range(dims)],
                    (F.col("label") >= 5).cast("int").alias("y"))
