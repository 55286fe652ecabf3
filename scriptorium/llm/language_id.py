"""Operator 4: language by prediction by partial matching.

One variable-order byte context tree per language, learned from a bounded sample of labelled rows and then
frozen, gives the exact code length of a text; the shortest wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.llm import ppm
from scriptorium.llm.common import Written, releasing, table

#: Labelled rows a language is learned from (those whose id hashes lowest), which are whole texts, one after the
#: other until SAMPLE_BYTES are reached; the first always counts.  This bounds fitting at any corpus size.
SAMPLE_ROWS, SAMPLE_BYTES = 300, 2 << 20
#: Of each language so many times its sample, by expectation, is ranked; the rest is left out before the shuffle.
RANKED = 4
UNKNOWN = "und"
#: Bytes whose likelihoods the share compares, and rows scored at a time.
SHARPNESS, SLICE_ROWS = 16, 500
_LETTER = re.compile(r"[^\W\d_]")


def held_out(id_column: str = "doc_id", parts: int = 3):
    """Whether crc32 of the id as text leaves 1; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % parts == 1


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text) if not text.isascii() else _LETTER.search(text) is not None


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[str], ppm.Lengths]:
    """Languages and their frozen model, from columns ``doc_id, text, lang``.

    The rows of a language are counted first, which tells below which hash its lowest rows lie; only those
    are ranked, so what one task ranks does not grow with the input.  Counts are kept whole and sparse: a
    language's are no more than its sample has bytes, and all of them, at (number of languages) x SAMPLE_BYTES
    grams at most, go to the executors.
    """
    some = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = Written(some.groupBy("lang").agg(F.count("*").alias("size")), "languages")
    place = F.col("hash").cast("double") / 2.0**64 + 0.5
    low = some.select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("hash")).join(sizes.side(), "lang").filter(place * F.col("size") <= RANKED * rows)
    in_order = Window.partitionBy("lang").orderBy("hash", "text")
    before = F.coalesce(F.sum(F.octet_length("text")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = low.withColumn("at", F.row_number().over(in_order)).filter(F.col("at") <= rows)
    ranked = first.withColumn("before", before).filter(F.col("before") < most_bytes)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {}
        for b in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text.encode())
            for lang, own in texts.items():
                parts.setdefault(lang, []).append(ppm.gram_counts(own))
        for lang, own in parts.items():
            keys, n = ppm.merge_counts(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    sample = ranked.select("lang", "text")
    counted = sample.mapInArrow(releasing(grams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    models = [ppm.Grams.whole(own["gram"].to_numpy(), own["n"].to_numpy().astype(np.float64)) for _, own in sorted(counted.groupby("lang"))]
    return langs, ppm.Lengths(models)


def _guess(texts: list[str | None], langs: list[str], model: ppm.Lengths) -> tuple[list[str], list[float]]:
    """Language and share of each text; ties go to the first language by name."""
    pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    at = [i for i, t in enumerate(texts) if t is not None and langs and has_letter(t)]
    if at:
        data = [texts[i].encode() for i in at]
        bits = model.score(data)
        per_byte = (bits - bits.min(axis=1, keepdims=True)) / np.array([len(d) for d in data])[:, None]
        share = np.exp2(-np.minimum(per_byte * SHARPNESS, 500))
        share /= share.sum(axis=1, keepdims=True)
        for i, k, own in zip(at, bits.argmin(axis=1).tolist(), share):
            pred[i], score[i] = langs[k], float(own[k])
    return pred, score


def predict(docs: DataFrame, langs: list[str], model: ppm.Lengths, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``, whatever their names), ``pred`` and ``score`` (the language's share of the likelihoods per byte, 0 to 1).

    Null texts and texts without a letter get ``und`` and 0, and so does everything if no language was learned.
    Every row gives a row; texts are scored in slices of a batch.
    """
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, model = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                pred, score = _guess(part.column(1).to_pylist(), langs, model)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["row", "pred", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("body"))
    return rows.mapInArrow(releasing(run), schema)


def identify(docs: DataFrame, rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``; learns from rows that are not held out.

    A null id counts as the empty text in the rule of who is held out; repeated rows each give a row, and each counts
    in the sample it falls into.  An empty table gives no row; other columns are not read.
    """
    base = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    langs, model = fit(base.filter(~held_out()), rows)
    out = predict(base.select("doc_id", "text"), langs, model)
    return out.select("row.doc_id", held_out("row.doc_id").alias("held_out"), F.col("pred").alias("lang_pred"), "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
