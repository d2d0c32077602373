"""The folder that the driver and all executors see, and tables that cut lineage there."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; one of our own only where a session of one machine names none, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors see")
        named = tempfile.mkdtemp(prefix="recsense-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for what several parts of a query read."""
    path = f"{shared(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
