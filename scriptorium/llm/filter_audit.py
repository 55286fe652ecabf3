"""Operator 13: how filters interact in every order, from a packed bitmap index.

1. One pass over the texts gives each document its failures of the filters that look at a text alone, and the SHA-256
   of the text; copies are told by that digest, so texts are not shuffled.
2. Each partition packs, part by part, one bitset per filter and per label.  What a prefix of filters leaves does not
   depend on the order within it, so AND-NOT over the 32 subsets and a popcount give what all 120 orders need.
3. The counts of a part, subset and filter are summed over partitions, and a fixed list of (order, step, subset,
   filter) spells them out.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import Written, join_classes, releasing, table

FILTERS = "ABCDE"
#: Least words (A), least distinct words in 100 (B), most capitals in 100 code points (C), symbols (D).
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, b"#$%&*|"
#: Every prefix that a filter can follow: the set of filters before it, as bits, and the filter's place.
PREFIXES = [(s, f) for s in range(1 << len(FILTERS)) for f in range(len(FILTERS)) if not s >> f & 1]
_CAPITAL = np.zeros(256, np.uint8)
_CAPITAL[ord("A") : ord("Z") + 1] = 1
_HEAD = (np.arange(256) & 0xC0 != 0x80).astype(np.uint8)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8)).astype(np.uint8)


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails; words are cut at ASCII white space, as ``bytes.split`` does."""
    words = text.split()
    n, distinct = len(words), len(set(words))
    data = np.frombuffer(text, np.uint8)
    found = [
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n,
        100 * int(_CAPITAL[data].sum(dtype=np.int64)) > MOST_CAPITALS * int(_HEAD[data].sum(dtype=np.int64)),
        bool(_SYMBOL[data].any()),
    ]
    return sum(hit << k for k, hit in enumerate(found))


def judged(docs: DataFrame, id_column: str, text: str, part: str) -> DataFrame:
    """``doc_id, part, sha, bits`` of every row: the failures of A to D and the digest of the text."""
    columns = [F.col(f"`{id_column}`").cast("long"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits, sha = [], []
            for value in b.column(2):
                own = value.as_py()
                bits.append(failures(own))
                sha.append(hashlib.sha256(own).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sha, pa.binary()), pa.array(bits, pa.int32())], names=["doc_id", "part", "sha", "bits"])

    return docs.select(*[c.alias(n) for c, n in zip(columns, ("doc_id", "part", "body"))]).mapInArrow(releasing(run), "doc_id long, part string, sha binary, bits int")


def packed_counts(fails: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Per entry of PREFIXES: kept, removed, redundant, unique_fails, good_lost, toxic_lost, from packed bitsets.

    ``fails`` has a row of booleans per filter and a column per document.
    """
    index, marks = np.packbits(fails, axis=1), [np.packbits(good), np.packbits(toxic)]
    count = lambda bits: int(np.bitwise_count(bits).sum(dtype=np.int64))
    alive = {0: np.packbits(np.ones(fails.shape[1], bool))}
    for s in range(1, 1 << len(fails)):
        f = s.bit_length() - 1
        alive[s] = alive[s ^ 1 << f] & ~index[f]
    left = {s: count(bits) for s, bits in alive.items()}
    everything = (1 << len(fails)) - 1
    out = np.empty((len(PREFIXES), 6), np.int64)
    for row, (s, f) in enumerate(PREFIXES):
        out_here = alive[s] & index[f]
        kept, others = left[s | 1 << f], everything ^ 1 << f
        unique = left[others] - left[everything]
        redundant = count(index[f] & ~alive[s])
        out[row] = kept, left[s] - kept, redundant, unique, *(count(out_here & m) for m in marks)
    return out


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def prefix_counts(rows: DataFrame) -> DataFrame:
    """``part, subset, filter`` and the COUNTS, from ``part, bits, good, toxic``; what a batch counts is summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subset, place = (np.array(c, np.int32) for c in zip(*PREFIXES))
        for b in batches:
            if not b.num_rows:
                continue
            parts = b.column(0).dictionary_encode()
            code = parts.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            bits, good, toxic = (b.column(k).to_numpy(zero_copy_only=False)[order] for k in (1, 2, 3))
            fails = (bits[None, :] >> np.arange(len(FILTERS))[:, None] & 1).astype(bool)
            ends = np.cumsum(np.bincount(code, minlength=len(parts.dictionary)))
            for at, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                found = packed_counts(fails[:, start:end], good[start:end], toxic[start:end])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([parts.dictionary[at].as_py()] * len(PREFIXES), pa.string()), pa.array(subset), pa.array(place), *[pa.array(found[:, k]) for k in range(len(COUNTS))]],
                    names=["part", "subset", "filter", *COUNTS],
                )

    schema = "part string, subset int, filter int, " + ", ".join(f"{c} long" for c in COUNTS)
    counted = rows.select("part", "bits", "good", "toxic").mapInArrow(releasing(run), schema)
    return counted.groupBy("part", "subset", "filter").agg(*[F.sum(c).alias(c) for c in COUNTS])


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per part, order of the filters and step: ``part, filter_order, step``, the COUNTS and ``shapley``.

    Null texts equal the empty text and a null part the empty one.  Copies are told by the SHA-256 of the text; a row
    fails E if a smaller id has its text, so repeated rows of the smallest id pass, and so does a null id, which makes
    no other row fail either.  A document is good (toxic) if one of its label rows says 1; null ids have no label.
    Every repeated row counts.  An empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    seen = Written(judged(docs, id_column, text, part), "judged")
    copies = seen.df.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = Written(copies, "copies")
    met = join_classes(seen.df, copies, "sha", "n", seen.df.count())
    late = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    bits = F.col("bits") + F.when(late, 1 << FILTERS.index("E")).otherwise(0)
    marked = labels.filter(F.col(f"`{id_column}`").isNotNull()).groupBy(F.col(f"`{id_column}`").cast("long").alias("doc_id"))
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marked = Written(marked.agg(says("quality").alias("good"), says("toxic").alias("toxic")).filter("good or toxic"), "marked")
    rows = met.select("doc_id", "part", bits.cast("int").alias("bits")).join(marked.side(), "doc_id", "left")
    no = F.lit(False)
    counted = prefix_counts(rows.select("part", "bits", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")))
    found = Written(counted, "counted").df
    n = len(FILTERS)
    times = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), F.bit_count("subset") + 1)
    shapley = found.groupBy("part", "filter").agg(F.sum(F.col("removed") * times).alias("shapley"))
    steps = [("".join(FILTERS[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k]) for order in itertools.permutations(range(n)) for k in range(n)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, subset int, filter int")  # 600 rows
    spelt = found.join(F.broadcast(steps), ["subset", "filter"]).join(shapley, ["part", "filter"])
    return spelt.select("part", "filter_order", "step", *COUNTS, "shapley")


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS fa,
         CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS fb,
         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 1 ELSE 0 END AS fc,
         CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 1 ELSE 0 END AS fd,
         CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 1 ELSE 0 END AS fe
  FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id
),
g AS (SELECT part, good, toxic, fa, fb, fc, fd, fe, count(*) AS n FROM f GROUP BY ALL),
orders(o) AS (
  SELECT '' UNION ALL SELECT o || c FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) l(c) WHERE position(c IN o) = 0
),
steps AS (SELECT o AS filter_order, CAST(k AS INTEGER) AS step FROM orders, range(1, 6) r(k) WHERE length(o) = 5),
x AS (
  SELECT part, filter_order, step, n, good, toxic, substr(filter_order, step, 1) AS own,
         substr((CASE WHEN fa = 1 THEN 'A' ELSE '' END || CASE WHEN fb = 1 THEN 'B' ELSE '' END || CASE WHEN fc = 1 THEN 'C' ELSE '' END || CASE WHEN fd = 1 THEN 'D' ELSE '' END || CASE WHEN fe = 1 THEN 'E' ELSE '' END), 1) AS failed
  FROM g, steps
),
y AS (
  SELECT *, position(own IN failed) > 0 AS fails, length(translate(substr(filter_order, 1, step - 1), failed, '')) < step - 1 AS gone FROM x
),
z AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant, coalesce(sum(n) FILTER (failed = own), 0) AS unique_fails,
         coalesce(sum(n * good) FILTER (NOT gone AND fails), 0) AS good_lost, coalesce(sum(n * toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM y GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM z
"""
