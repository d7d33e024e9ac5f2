"""Tables in the folder that driver and executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import ensure_checkpoint_dir

#: Most bytes of a table that is sent to every executor; what may be larger is joined by a shuffle.
BROADCAST_BYTES = 32 << 20


class Staged:
    """A frame written as Parquet in the shared folder and read back.

    Later jobs no longer depend on any executor: a lost one costs no upstream work.  ``drop`` deletes
    the files once no later frame reads them; what is not dropped goes with the job's folder.
    """

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.df.sparkSession, self.path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark reads it with."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def sent_if_small(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """``df`` marked for broadcast where its size is known to be at most ``BROADCAST_BYTES``."""
    return F.broadcast(df) if rows * bytes_per_row <= BROADCAST_BYTES else df
