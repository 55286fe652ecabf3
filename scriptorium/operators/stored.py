"""Intermediate tables in the folder that all executors share, and joins whose small side is measured first."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes as measured after it was written, that is sent to all executors.
SMALL_SIDE = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only where it is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


class Stored:
    """A table as written: read again instead of computed again, its rows and partitions fixed, its size known."""

    def __init__(self, df: DataFrame):
        spark = df.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}")
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        df.write.parquet(where.toString())
        fs.deleteOnExit(where)
        self.bytes = fs.getContentSummary(where).getLength()
        self.df = spark.read.schema(df.schema).parquet(where.toString())

    def side(self) -> DataFrame:
        """For a join: broadcast if measured small, else left to a shuffle."""
        return F.broadcast(self.df) if self.bytes <= SMALL_SIDE else self.df
