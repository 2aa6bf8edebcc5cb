"""A folder for tables a job writes and reads back."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A path nobody else uses, in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/blotter-{uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="blotter-")
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def staged(df: DataFrame) -> DataFrame:
    """``df``, written and read back: what follows doesn't compute it again, also not after a loss of executors."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
