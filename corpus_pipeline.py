"""Documents to packed sequences: language ID, exact dedup, near dedup, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame;
``run`` writes each result to the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import exact_dedup, language_id, packing, simhash, suffix_dedup
from scriptorium.llm.common import Written, table

#: SQL can express neither the models nor the tokenizer.
ORACLE_SQL = None


def _key(doc_id: Column, sha: Column) -> Column:
    """Digest of an id (or that it is null) and of the hex SHA-256 of a text: rows of one key are equal in id and text."""
    return F.unhex(F.sha2(F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")), sha), 256))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with the key that operators' results are joined by; null texts equal the empty text."""
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return docs.select(F.struct("*").alias("row"), _key(F.col("doc_id"), sha).alias("key"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language; ``und`` (null, or without a letter) goes.  ``lang`` becomes the prediction where it is null."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    langs, model = language_id.fit(base.filter(~language_id.held_out()))
    out = language_id.predict(docs, langs, model).filter(F.col("pred") != language_id.UNKNOWN)
    lang = F.coalesce("row.lang", "pred")
    return out.select(*[lang.alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _kept(docs: DataFrame, dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows whose key is not among ``dropped (key)``, and of rows with one key among ``repeated (key)`` the first.

    A side is broadcast only if it was measured small.
    """
    gone, again = Written(dropped.distinct(), "dropped"), Written(repeated, "again")
    keyed = _keyed(docs).join(gone.side(), "key", "left_anti")
    once = keyed.join(again.side(), "key", "left_anti")
    first = keyed.join(again.side(), "key", "left_semi").dropDuplicates(["key"])
    return once.union(first).select("row.*")


def _repeated(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").count().filter("count > 1").select("key")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays (a null id is the smallest); of rows that repeat it, id and text, one does.

    Null and empty texts are equal, so one row of them stays; an empty table stays empty.
    """
    found = exact_dedup.exact_duplicates(docs).filter("group_size > 1")
    found = Written(found.select(_key(F.col("doc_id"), F.col("text_sha256")).alias("key"), "kept"), "found").df
    return _kept(docs, found.filter(~F.col("kept")).select("key"), _repeated(found.filter("kept")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one row stays: that with the smallest id (a null id last), then with the smallest key.

    Null, empty and wordless texts share fingerprint zero, so one row of them stays; an empty table stays empty.
    """
    keyed = _keyed(docs).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"), "key")
    found = Written(simhash.members(keyed, carried=["key"]).filter("root is not null").select("root", "doc_id", "key"), "members").df
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))["key"].alias("first"))
    found = found.join(first, "root").select("key", (F.col("key") == F.col("first")).alias("kept"))
    return _kept(docs, found.filter(~F.col("kept")).select("key"), _repeated(found.filter("kept")))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts bytes of 100-byte strings that start earlier (smaller id, null first; then place) out of the texts; ``n_chars`` follows.

    Null texts stay null, empty and short ones as they are; rows of one id and text are cut alike; an empty table stays empty.
    """
    out = suffix_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, as ``packing.pack_documents`` says; an empty table gives no row."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Written(stage(spark, docs, sf_dir), name).df
    return docs
