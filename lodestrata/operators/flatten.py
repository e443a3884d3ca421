"""From nested transactions to input and output rows, in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_cutoff(tx: DataFrame, height: int, time: str) -> DataFrame:
    """Rows up to a height and a time; the month is compared too, so partitions are pruned."""
    cut = F.lit(time).cast(tx.schema["block_timestamp"].dataType)
    month = F.trunc(F.lit(time).cast("date"), "MM")
    return tx.where((F.col("block_number") <= height) & (F.col("block_timestamp") <= cut) & (F.col("block_timestamp_month") <= month))


def recent(frame: DataFrame, as_of: str, days: int = 7, ts: str = "block_timestamp", month: str = "block_timestamp_month") -> DataFrame:
    """Rows of the days before a date, that date itself not included."""
    end, start = F.lit(as_of).cast("date"), F.date_sub(F.lit(as_of).cast("date"), days)
    return frame.where(
        F.col(month).between(F.trunc(start, "MM"), F.trunc(F.date_sub(end, 1), "MM")) & (F.to_date(ts) >= start) & (F.to_date(ts) < end)
    )


def flatten_io(tx: DataFrame, full: bool = False) -> DataFrame:
    """One row for each input and output, told apart by row_kind; full adds scripts and positions.

    Both sides leave one explode, so the table is read once.
    """
    fields = ["addresses", "value"] + (["index", "script_hex", "type"] if full else [])

    def side(kind: str, name: str) -> Column:
        return F.transform(name, lambda x: F.struct(F.lit(kind).alias("row_kind"), *[x[f].alias(f) for f in fields]))

    rows = tx.select(
        "block_hash", F.col("hash").alias("transaction_hash"), "block_number", "block_timestamp",
        F.explode(F.concat(side("input", "inputs"), side("output", "outputs"))).alias("io")
    )
    out = rows.select("block_hash", "transaction_hash", "block_number", "block_timestamp", "io.*")
    out = out.withColumnRenamed("value", "source_value").withColumn("value_sats", F.expr("try_cast(source_value as decimal(38,0))"))
    return out.withColumnRenamed("type", "script_type") if full else out


def single_address(io: DataFrame) -> DataFrame:
    """Rows of exactly one address, as normalized_address."""
    return io.where(F.size("addresses") == 1).withColumn("normalized_address", F.get("addresses", F.lit(0))).drop("addresses")


def since(ts: Column, cutoff: Column, days: int) -> Column:
    """Whether ts is at most so many days before the cutoff, both ends included."""
    return ts >= cutoff - F.expr(f"INTERVAL {days} DAYS")
