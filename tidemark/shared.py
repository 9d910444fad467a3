"""Tables that a job writes for itself, in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a local master uses a folder of its warehouse, and a
    cluster, which has no folder that is safe to assume, is asked for the setting."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written there and read back: its lineage is its files, and all readers see the same rows."""
    path = f"{shared_folder(df.sparkSession)}/tidemark-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
