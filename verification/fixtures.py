"""Task tables that Spark derives from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CREDIT_NUMERIC = ["o_totalprice", "c_acctbal"]
CREDIT_FACTORS = ["c_mktsegment", "o_orderstatus", "c_nationkey"]
CREDIT_VARIABLES = CREDIT_NUMERIC + CREDIT_FACTORS
LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_FACTORS = ["l_linestatus", "l_linenumber"]
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer; the label is an urgent priority."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("y"),
        "o_totalprice", "c_acctbal", "c_mktsegment", "o_orderstatus", "c_nationkey")


def credit_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit(spark, sf_dir).withColumns({
        "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
        "o_orderstatus": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))})


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; the label is a returned item."""
    return table(spark, sf_dir, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))


def strong_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a label that depends on the variables."""
    return table(spark, sf_dir, "lineitem").withColumn(
        "y", ((F.col("l_quantity") * F.col("l_discount") > 1.2)
              | (F.col("l_suppkey") % 7 == 0) & (F.col("l_linenumber") > 3)).cast("int"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score with many ties, exact 0 and exact 1 included."""
    return lines(spark, sf_dir).select(
        *LINE_KEYS, "y", (F.col("l_quantity") * F.col("l_discount") / F.lit(5.0)).alias("p1"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id")


def coded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "value",
        (F.col("event_type") == "error").cast("int").alias("y"))


CREDIT_SQL = """credit AS (
  SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS y, o_totalprice, c_acctbal,
         c_mktsegment, o_orderstatus, c_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
MISSING_SQL = CREDIT_SQL + """,
miss AS (
  SELECT o_orderkey, y, o_totalprice, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
         c_mktsegment, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
         c_nationkey
  FROM credit)"""
LINES_SQL = """lines AS (
  SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem)"""
STRONG_SQL = """strong AS (
  SELECT *, CAST(l_quantity * l_discount > 1.2::DOUBLE
                 OR (l_suppkey % 7 = 0 AND l_linenumber > 3) AS INTEGER) AS y FROM lineitem)"""
SCORED_SQL = """scored AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity * l_discount / 5.0::DOUBLE AS p1
  FROM lineitem)"""
