"""Session settings the library relies on. A cluster may override any of them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key across tasks even when that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "scorelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for cut lineage, if any."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint folder. A local session may go without one; a cluster may not,
    as its executors would not see each other's files."""
    root = checkpoint_root(spark)
    if root is None:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join(tempfile.gettempdir(), f"scorelake-{os.getpid()}")
    return f"{root.rstrip('/')}/scorelake-{uuid.uuid4().hex}"


def landed(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet on shared storage and read back, so that repeated passes do not redo
    its joins and a lost executor costs a re-read only."""
    path = scratch_dir(df.sparkSession) + "/table"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
