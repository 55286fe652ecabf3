"""Relations that queries start from, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ordered source lines: ``doc_id, line_no, line``."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


#: The same relation for SQL.
LINES = "(SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents)"
