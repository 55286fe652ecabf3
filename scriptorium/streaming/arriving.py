"""Translated batches as files that arrive: each is checked before it counts, and gets the tail of the batch before it.

Two streams, each with a checkpoint of its own.  The gate writes what it accepts and what it finds, one folder an epoch,
so an epoch that is run again replaces its own rows; a batch that fails stops the gate before the epoch counts, and the
next start reads the same files again.  The tail of each project's last batch is state, which survives a restart.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scriptorium.plans import rules
from scriptorium.sources import batches as b

#: Entries of a batch that the next one sees.
TAIL = 8
ACCEPTED = "epoch long, path string, project string, batch_id string, start int, end int, n_entries int, tail array<string>"
TAILS = "project string, batch_id string, previous string, tail string"


class BatchRejected(Exception):
    """A batch failed its rules; nothing of its epoch counts."""


def arriving(spark: SparkSession, folder: str, per_epoch: int = 1) -> DataFrame:
    """``path, text`` of files as they arrive, oldest first, ``per_epoch`` at a time."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", per_epoch).load(folder)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def summaries(batches: DataFrame) -> DataFrame:
    """``path, project, batch_id, start, end, n_entries, tail`` of parsed batches; the project is the file's folder."""
    ids = F.transform("entries", lambda e: F.concat_ws(":", e["id"], e["type"]))
    tail = F.when(F.size(ids) > TAIL, F.slice(ids, -TAIL, TAIL)).otherwise(ids)
    project = F.element_at(F.split("path", "/"), -2)
    return batches.select("path", project.alias("project"), "batch_id", F.col("source_pages.start").alias("start"), F.col("source_pages.end").alias("end"), F.size("entries").alias("n_entries"), tail.alias("tail"))


def gate(files: DataFrame, accepted: str, findings: str, checkpoint: str) -> StreamingQuery:
    """Starts the gate over what is there now; it ends when all is read, or with BatchRejected."""

    def check(texts: DataFrame, epoch: int) -> None:
        parsed = b.parse_batches(texts)
        found = rules.validate(parsed, key="path")
        found.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{findings}/epoch-{epoch}")
        failed = texts.sparkSession.read.parquet(f"{findings}/epoch-{epoch}").filter("level = 'FAIL'")
        first = failed.select("path", "code", "message").orderBy("path", "code", "message").limit(1).collect()
        if first:
            raise BatchRejected(f"{first[0]['path']}: {first[0]['code']} {first[0]['message']}")
        rows = summaries(parsed).select(F.lit(epoch).cast("long").alias("epoch"), "*")
        rows.write.mode("overwrite").parquet(f"{accepted}/epoch-{epoch}")

    return files.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _next_tails(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Batches of a project in order of their pages; the state is the last batch and its tail, TAIL entries at most."""
    last_end, previous, tail = state.get if state.exists else (None, None, None)
    rows = pd.concat(list(chunks)).sort_values(["start", "end", "batch_id"])
    out = []
    for r in rows.itertuples(index=False):
        earlier = last_end is not None and last_end < r.start
        out.append((key[0], r.batch_id, previous if earlier else None, tail if earlier else None))
        if last_end is None or r.end >= last_end:
            last_end, previous, tail = int(r.end), r.batch_id, ",".join(r.tail)
    state.update((last_end, previous, tail))
    yield pd.DataFrame(out, columns=["project", "batch_id", "previous", "tail"])


def tails(spark: SparkSession, accepted: str, out: str, checkpoint: str) -> StreamingQuery:
    """Starts the stream of ``TAILS`` over what the gate has accepted: one row for each batch, in order of arrival."""
    rows = spark.readStream.schema(ACCEPTED).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(accepted)
    placed = rows.dropna(subset=["project", "start", "end"]).select("project", "batch_id", "start", "end", "tail").groupBy("project")
    found = placed.applyInPandasWithState(_next_tails, TAILS, "last_end int, previous string, tail string", "append", GroupStateTimeout.NoTimeout)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def tails_at_once(batches: DataFrame) -> DataFrame:
    """The same rows from all batches at once: for each the latest earlier batch of its project, by one ordered merge."""
    from scriptorium.operators import scans

    rows = batches.dropna(subset=["project", "start", "end"]).select("project", "batch_id", "start", "end", F.array_join("tail", ",").alias("tail"))
    ended = rows.select("project", "end", F.struct("end", "start", "batch_id", "tail").alias("before"))
    met = scans.as_of(rows.select("project", "batch_id", "start"), ended, ["project"], "start", "end", "before", "before")
    return met.select("project", "batch_id", F.col("before.batch_id").alias("previous"), F.col("before.tail").alias("tail"))
