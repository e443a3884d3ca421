"""Latest, first and top rows by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import kept


def first_by(df: DataFrame, keys: list[str], *order: Column, k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each key; Spark limits each group before the shuffle."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def latest(df: DataFrame, keys: list[str], at: str, tie: str, as_of: str | None = None) -> DataFrame:
    """The newest row of each key not after as_of; ties go to the larger tie value."""
    if as_of is not None:
        df = df.where(F.col(at) <= F.lit(as_of).cast(df.schema[at].dataType))
    return first_by(df, keys, F.desc(at), F.desc(tie))


def ranked(df: DataFrame, *order: Column, name: str = "queue_rank") -> DataFrame:
    """df with its place in a total order, from 1.

    Rows are dealt to sorted ranges and kept in the shared folder with their
    range: bounds come from a sample, so a second run, or a lost executor's,
    might deal otherwise. Counts of the ranges before and places within each
    are then taken from that one table; no single task holds all rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))  # at most n rows
    before = counts.select(
        "_range",
        F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = dealt.withColumn("_within", within).join(F.broadcast(before), "_range")
    return placed.withColumn(name, (F.col("_before") + F.col("_within")).cast("bigint")).drop("_range", "_before", "_within")


def top(df: DataFrame, k: int, *order: Column, name: str = "queue_rank") -> DataFrame:
    """The first k rows in a total order and their places; k is a budget, so the window over them is bounded."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def previous(df: DataFrame, keys: list[str], value: str, *order: Column, name: str = "supersedes") -> DataFrame:
    return df.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))


def nearest_rank(df: DataFrame, value: str, quantiles: dict[str, float]) -> DataFrame:
    """The ceil(q n)-th smallest value for each name; exact."""
    kind = df.schema[value].dataType
    return df.agg(*[F.expr(f"percentile_disc({q}) within group (order by {value})").cast(kind).alias(name) for name, q in quantiles.items()])
