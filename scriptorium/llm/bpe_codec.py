"""Operator 2: encode whole texts and decode them again."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bpe
from scriptorium.llm.common import releasing, table

TOKENIZER = "word_bpe_49k.json"


class _Decoded(dict):
    """Pre-token -> its decoded tokens: a memo of the decoder, fed with the ids that the encoder's memo holds."""

    def __init__(self, ids: bpe.Memo):
        super().__init__()
        self.ids = ids

    def __missing__(self, word: str) -> str:
        value = bpe.TextDecoder(self.ids.vocabulary, joined=True).feed(map(int, self.ids[word].split())) + " "
        if len(word) <= bpe.REMEMBERED:
            if len(self) >= 2 * self.ids.most:
                self.clear()
            self[word] = value
        return value


@functools.lru_cache(2)
def _caches(tokenizer: str):
    vocabulary = bpe.load(tokenizer)

    def make(ids, starts: list[int]) -> list[str]:
        numbers = [f"{i} " for i in ids.tolist()]
        return ["".join(numbers[a:b]) for a, b in zip(starts, starts[1:])]

    ids = bpe.Memo(vocabulary, make)
    return vocabulary, ids, _Decoded(ids)


def _digest(runs: Iterable[list[str] | int], tokenizer: str) -> tuple[int, str, str]:
    vocabulary, id_text, decoded = _caches(tokenizer)
    n, of_ids, of_text, first = 0, hashlib.sha256(), hashlib.sha256(), True
    for run in runs:
        if isinstance(run, int):
            a, b = f"{run} ", vocabulary.token[run] + " "
        else:
            a, b = "".join(map(id_text.__getitem__, run)), "".join(map(decoded.__getitem__, run))
        if a:
            n += a.count(" ")
            of_ids.update((a[:-1] if first else " " + a[:-1]).encode())
            of_text.update((b[:-1] if first else " " + b[:-1]).encode())
            first = False
    return n, of_ids.hexdigest(), of_text.hexdigest()


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """Adds ``ids array<int>`` to every row (null text: no ids; all other columns stay, an own ``ids`` is replaced)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "ids"]

    @F.pandas_udf("array<int>")
    def ids(texts):
        vocabulary = bpe.load(tokenizer)
        return texts.map(lambda t: list(bpe.encode(t, vocabulary)))

    return docs.select(*kept, ids(F.col(f"`{text}`")).alias("ids"))


def decode_documents(encoded: DataFrame, tokenizer: str = TOKENIZER, joined: bool = True) -> DataFrame:
    """Adds ``decoded string`` from ``ids`` (null ids: empty text)."""
    kept = [F.col(f"`{c}`") for c in encoded.columns if c.lower() != "decoded"]

    @F.pandas_udf("string")
    def decoded(ids):
        vocabulary = bpe.load(tokenizer)

        def one(row) -> str:
            machine = bpe.TextDecoder(vocabulary, joined)
            return machine.feed(row if row is not None else ()) + machine.finish()

        return ids.map(one)

    return encoded.select(*kept, decoded("ids").alias("decoded"))


def codec_digests(docs: DataFrame, tokenizer: str = TOKENIZER, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: token count and digests of the ids and of the decoded text.

    Null texts count as empty (0 tokens, digests of the empty string); repeated rows and null ids give a
    row each; empty tables give none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, id_text, _ = _caches(tokenizer)
        for batch in batches:
            rows = [_digest(runs, tokenizer) for runs in bpe.gathered((t.as_py() for t in batch.column(1)), vocabulary, [id_text])]
            n, a, b = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(releasing(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digests(table(spark, sf_dir, "documents"))
