"""The ledger that the test tables stand for: orders as transactions, their lines as outputs, their totals as inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF_HEIGHT, CUTOFF_TIME = 2404, "2001-08-01 00:00:00"
CAMPAIGN = "synthetic-ledger"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _addresses() -> F.Column:
    part = F.concat(F.lit("acct:"), F.col("l_partkey"))
    return (
        F.when(F.col("l_linenumber") == 7, F.array().cast("array<string>"))
        .when(F.col("l_linenumber") == 6, F.array(part, F.concat(F.lit("acct:s"), F.col("l_suppkey"))))
        .otherwise(F.array(part))
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested transactions, one for each order."""
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    value = F.round(F.col("l_extendedprice") * 100).cast("bigint") * F.pow(F.lit(10), F.col("l_partkey") % 7).cast("bigint")
    known = F.when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "A"), F.lit(None)).otherwise(value)
    script = F.when(F.col("l_linenumber") == 4, F.lit(None)).when(F.col("l_linenumber") == 3, F.lit("")).otherwise(F.lower(F.hex(F.concat(F.lit("acct:"), F.col("l_partkey")))))
    kind = F.when(F.col("l_returnflag") == "R", F.lit("nonstandard")).otherwise(F.lit("pubkeyhash"))
    out = F.struct(
        F.col("l_linenumber").cast("bigint").alias("index"), script.alias("script_hex"), kind.alias("type"),
        _addresses().alias("addresses"), known.cast("decimal(38,9)").alias("value"),
    )
    outputs = line.groupBy(F.col("l_orderkey").alias("_k")).agg(F.collect_list(out).alias("outputs"))
    spent = F.struct(
        F.lit(0).cast("bigint").alias("index"), F.lit(None).cast("string").alias("spent_transaction_hash"),
        F.lit(None).cast("bigint").alias("spent_output_index"),
        F.lit(None).cast("string").alias("script_hex"), F.lit("pubkeyhash").alias("type"),
        F.array(F.concat(F.lit("acct:"), F.col("o_custkey"))).alias("addresses"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("decimal(38,9)").alias("value"),
    )
    day = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return order.join(outputs, order["o_orderkey"] == outputs["_k"], "left").select(
        F.sha2(F.concat(F.lit("tx:"), F.col("o_orderkey")).cast("binary"), 256).alias("hash"),
        F.sha2(F.concat(F.lit("block:"), day).cast("binary"), 256).alias("block_hash"),
        day.cast("bigint").alias("block_number"), F.col("o_orderdate").alias("block_timestamp"),
        F.trunc("o_orderdate", "MM").alias("block_timestamp_month"),
        F.array(spent).alias("inputs"), F.coalesce("outputs", F.array().cast(outputs.schema["outputs"].dataType)).alias("outputs"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("o_orderdate"), F.lit("1995-01-01").cast("date"))
    per_day = table(spark, sf_dir, "orders").groupBy(day.alias("number")).agg(F.max("o_orderdate").alias("timestamp"))
    return per_day.select(
        F.sha2(F.concat(F.lit("block:"), F.col("number")).cast("binary"), 256).alias("hash"), F.col("number").cast("bigint"),
        "timestamp", F.trunc("timestamp", "MM").alias("timestamp_month")
    )
