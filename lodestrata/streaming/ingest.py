"""An extension: the ledger's append and admission as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import path_for


def new_evidence(stream: DataFrame, key: str = "evidence_fingerprint", ts: str = "observed_at", late: str = "1 day") -> DataFrame:
    """Each fingerprint once within the watermark; state is dropped beyond it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def admission_counts(stream: DataFrame, ts: str = "reserved_at", late: str = "5 minutes") -> DataFrame:
    """Requests and bytes of each minute."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "1 minute")).agg(
        F.count("*").alias("requests"), F.sum(F.coalesce("actual_bytes", "estimated_bytes")).alias("bytes")
    )


def drained(stream: DataFrame, name: str) -> DataFrame:
    """What a stream gives of all that is there now, as a table in the shared folder, where its checkpoint is too."""
    spark = stream.sparkSession
    out, state = path_for(spark, name), path_for(spark, f"{name}-checkpoint")
    run = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
