"""Operator 5: token counts that follow edits.

A document is cut at white space into leaves; a segment tree holds the characters and tokens below every
node.  An edit finds its leaves by descending the character sums, re-encodes those leaves and, where it
removed the white space that ended one, the next (a pre-token never crosses white space), and updates the
sums on their paths to the root.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bpe
from scriptorium.llm.bpe_codec import TOKENIZER
from scriptorium.llm.common import releasing, table

#: Characters after which a leaf ends at the next white space.
LEAF_CHARS = 512
#: Pre-tokens of texts up to so many characters are worked out with other texts', those of longer ones for so many leaves at a time.
TOGETHER_CHARS, TOGETHER_LEAVES = 1 << 17, 256
EDIT = "array<struct<start:long,stop:long,replacement:string>>"
_GAP = re.compile(bpe._SEPARATORS.pattern)


@functools.lru_cache(2)
def _counter(tokenizer: str) -> bpe.Memo:
    return bpe.Memo(bpe.load(tokenizer), lambda ids, starts: [b - a for a, b in zip(starts, starts[1:])])


def count_tokens(text: str, tokenizer: str = TOKENIZER) -> int:
    counts = _counter(tokenizer)
    return sum(1 if isinstance(run, int) else sum(map(counts.__getitem__, run)) for run in bpe.runs(text, counts.vocabulary))


def leaves_of(text: str, size: int = LEAF_CHARS) -> list[str]:
    """Cuts after white space; joined they are the text."""
    out, at = [], 0
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        if not gap or gap.end() == len(text):
            break
        out.append(text[at : gap.end()])
        at = gap.end()
    out.append(text[at:])
    return out


class CountTree:
    """Segment tree of leaf texts with sums of characters and tokens."""

    def __init__(self, text: str, tokenizer: str = TOKENIZER, leaf_chars: int = LEAF_CHARS):
        self.tokenizer, self.leaf_chars, self.encoded = tokenizer, leaf_chars, 0
        self._build(leaves_of(text, leaf_chars), {})

    def _build(self, leaves: list[str], known: dict[str, int]) -> None:
        self.leaves = leaves
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        counts = _counter(self.tokenizer) if sum(map(len, leaves)) > TOGETHER_CHARS else None
        for i, leaf in enumerate(leaves):
            if counts is not None and i % TOGETHER_LEAVES == 0:
                fresh = (t for t in leaves[i : i + TOGETHER_LEAVES] if t not in known)
                counts.learn([run for t in fresh for run in bpe.runs(t, counts.vocabulary) if not isinstance(run, int)])
            self.chars[self.width + i] = len(leaf)
            n = known.get(leaf)
            if n is None:
                n = count_tokens(leaf, self.tokenizer)
                self.encoded += 1
            self.tokens[self.width + i] = n
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def locate(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before that leaf."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place - before >= self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def _set(self, leaf: int, text: str) -> None:
        self.leaves[leaf] = text
        node = self.width + leaf
        self.chars[node] = len(text)
        self.tokens[node] = count_tokens(text, self.tokenizer) if text else 0
        self.encoded += bool(text)
        while node := node // 2:
            self._sum(node)

    def edit(self, start: int, stop: int, replacement: str) -> int:
        """Replaces characters [start, stop), clipped to the text; returns the new count."""
        size = self.chars[1]
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        first, before = self.locate(start)
        if start == before:  # the leaf before may end in no white space once this one changes
            while first and (start == before):
                first -= 1
                before -= len(self.leaves[first])
        last, last_before = self.locate(max(stop - 1, start)) if stop > start else self.locate(start)
        last = max(last, first)
        old = "".join(self.leaves[first : last + 1])
        new = old[: start - before] + replacement + old[stop - before :]
        while last + 1 < len(self.leaves) and not (new and _GAP.fullmatch(new[-1])):
            last += 1
            new += self.leaves[last]
        parts = leaves_of(new, self.leaf_chars)
        if len(parts) > last - first + 1:
            known = {t: self.tokens[self.width + i] for i, t in enumerate(self.leaves) if not first <= i <= last}
            self._build([*self.leaves[:first], *parts, *self.leaves[last + 1 :]], known)
        else:
            for i in range(first, last + 1):
                self._set(i, parts[i - first] if i - first < len(parts) else "")
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)


def count_with_edits(docs: DataFrame, edits: Column, tokenizer: str = TOKENIZER, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: tokens before and after its ``edits`` (applied in array order, offsets in characters of the
    text as it then is, clipped to it), leaves, and leaves encoded again.

    Null texts count as empty, null edit lists as none, a null replacement as a deletion; null ids and
    repeated rows give a row each; empty tables give none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counter(tokenizer)
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            learned = bpe.gathered((t if t and len(t) <= TOGETHER_CHARS else "" for t in texts), counts.vocabulary, [counts])
            for value, changes, _ in zip(texts, batch.column(2), learned):  # each text right after the memo has learned it
                tree = CountTree(value or "", tokenizer)
                n, leaves, built = tree.tokens[1], len(tree.leaves), tree.encoded
                changes = [c for c in changes.as_py() or () if c]
                for c in changes:
                    start = c["start"] or 0
                    tree.edit(start, start if c["stop"] is None else c["stop"], c["replacement"] or "")
                rows.append((n, tree.tokens[1], len(changes), leaves, tree.encoded - built))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_tokens", "n_tokens_edited", "n_edits", "n_leaves", "n_encoded_again"])

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), edits.cast(EDIT).alias("edits"))
    return rows.mapInArrow(releasing(run), "doc_id long, n_tokens long, n_tokens_edited long, n_edits long, n_leaves long, n_encoded_again long")


def standing_edits(text: str = "text") -> Column:
    """The query's edits: an insertion in the middle, a deletion at a quarter, a replacement at the end."""
    n = F.length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))

    def edit(start: Column, stop: Column, replacement: str) -> Column:
        return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"), F.lit(replacement).alias("replacement"))

    half, quarter = F.floor(n / 2), F.floor(n / 4)
    return F.array(edit(half, half, " inserted words, here"), edit(quarter, quarter + 24, ""), edit(n - 10, n + 24, "edited end."))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_with_edits(table(spark, sf_dir, "documents"), standing_edits())
