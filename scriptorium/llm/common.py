"""Shared plumbing: the shared folder, written intermediate tables, size-checked joins."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes as measured after it was written, that may be broadcast.
BROADCAST_LIMIT = 32 << 20
#: Classes of at least one in so many rows go to all executors, whatever the others do.
HOT_CLASSES = 1 << 14


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``; own folder only where unset and local."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


class Written:
    """A table written to the shared folder; lineage ends here and a lost executor costs no recomputation."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/scriptorium-{label}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        fs, path = _filesystem(self.spark, self.path)
        fs.deleteOnExit(path)
        self.bytes = fs.getContentSummary(path).getLength()
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the files; only for tables whose last reader has been written elsewhere."""
        fs, path = _filesystem(self.spark, self.path)
        fs.delete(path, True)

    def side(self, limit: int = BROADCAST_LIMIT) -> DataFrame:
        """For the small side of a join: broadcast when the measured size allows, else left to a shuffle join."""
        return F.broadcast(self.df) if self.bytes * 4 <= limit else self.df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, by which work is cut into pieces of one size however many they are."""
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def join_classes(rows: DataFrame, classes: Written, key: str, size: str, total: int) -> DataFrame:
    """``rows`` left joined with ``classes``, whose column ``size`` says how many of all ``total`` rows have the key.

    Classes too large to broadcast meet their rows by a shuffle, but for those of at least 1/HOT_CLASSES of all
    rows: these are HOT_CLASSES at most, so they are broadcast and no task gets a hot key's rows.
    """
    if classes.bytes * 4 <= BROADCAST_LIMIT:
        return rows.join(F.broadcast(classes.df), key, "left")
    is_hot = F.col(size) * HOT_CLASSES >= total
    hot = F.broadcast(classes.df.filter(is_hot))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(classes.df.filter(~is_hot), key, "left"))


def partitions(spark: SparkSession) -> int:
    """Partition count for exchanges that carry packed rows."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def release() -> None:
    """Gives a worker's free memory back: workers live through all stages, and what one left would add to the next's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A map over batches that gives memory back once its task is through."""

    @functools.wraps(run)
    def through(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return through
