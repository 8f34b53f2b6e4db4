"""Python workers that can import this package, and tables that all executors see."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame


def reachable(df: DataFrame) -> DataFrame:
    """`df`, once its session's workers have this package on their path, as they need for functions sent by name."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    return df


def shared_table(df: DataFrame, name: str, *by: str) -> DataFrame:
    """`df` written once under spark.checkpoint.dir, in folders of the values of `by`, and read back: lost executors take nothing with them.

    That setting is the cluster's; only a local session without it gets a folder of its own, as in tests.
    """
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.gettempdir()}/ratevane-shared"
    own = f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(own)
    return spark.read.schema(df.schema).parquet(own).select(df.columns)
