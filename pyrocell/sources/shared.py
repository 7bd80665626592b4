"""The folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one of our own is only made on a single machine."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/products-{uuid.uuid4().hex}"


class Rounds:
    """Tables that a loop writes to the shared folder, round by round, and reads back.

    A table read back is as large as its files. One that is checkpointed keeps the size its plan was guessed to have,
    and in a loop of joins these guesses multiply until planning alone takes minutes.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.n = spark, new_path(spark), 0

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.path}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.n}")

    def only(self, df: DataFrame) -> DataFrame:
        """``df`` written as the result; what the rounds wrote goes."""
        out = new_path(self.spark)
        df.write.parquet(out)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return self.spark.read.schema(df.schema).parquet(out)
