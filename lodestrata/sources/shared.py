"""Tables in the folder that driver and executors share: lineage ends there, and executors may go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of this machine only where the session has none and runs locally."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file:///tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(where)
    return where


def path_for(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lodestrata-{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder."""
    spark = df.sparkSession
    path = path_for(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
