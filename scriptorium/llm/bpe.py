"""BPE with word ends as a bounded-lookahead streaming transducer, and its incremental decoder.

Encoding runs over the UTF-8 bytes of one pre-token.  A boundary between two symbols can only be merged
away by a chain of rules of falling rank that reaches to its right; the longest such chain in the merge
list is the *sufficient lookahead*.  A buffer of that many symbols past a boundary decides it, so tokens
left of it are emitted and forgotten: memory stays constant however long the pre-token is.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

INFINITY = 1 << 60
_NONE = np.int32(2**31 - 1)
WORD_END = "</w>"
#: Pre-tokens of up to so many characters are remembered, which bounds an entry of the memo.
REMEMBERED = 64
#: Bytes that the stream takes in at a time beyond the lookahead.
STRIDE = 256
#: Words of a generation of a worker's memo, which has two: what is not met again while one fills is forgotten.
CACHE_WORDS = 120_000
#: Words of up to so many bytes are merged many at a time, and texts are gathered up to so many characters for that.
BATCH_BYTES, BATCH_CHARS = (8, 16, 32), 1 << 21
#: Characters of a text that are split into words at a time.
BLOCK_CHARS = 1 << 20

_SEPARATORS = re.compile("[\t-\r \x85\xa0  -     　]+")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_ASCII_WORDS = re.compile(rf"[a-z]+|{_CONTRACTIONS}|[0-9]|[^\sa-z0-9]+", re.A)
#: Pre-tokens of lower-case text: letters, contractions, single numbers, and what is neither these nor white space.
_WORDS = regex.compile(rf"[\p{{L}}]+|{_CONTRACTIONS}|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+")
#: The same, and faster, for texts whose only numbers are decimal digits.
_PLAIN_WORDS = re.compile(rf"[^\W\d_]+|{_CONTRACTIONS}|\d|(?:[^\w\s]|[_\x1c-\x1f])+")

#: The same two, where a line end is a match of its own.
_WORD_LINES, _PLAIN_LINES = regex.compile(_WORDS.pattern + "|\n"), re.compile(_PLAIN_WORDS.pattern + "|\n")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge rules over token ids, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        alphabet = byte_alphabet()
        self.byte_id = [ids[c] for c in alphabet]
        self.final_id = [ids[c + WORD_END] for c in alphabet]
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.rank: dict[int, int] = {}
        self.product: list[int] = []
        self.parts: dict[int, tuple[int, int]] = {}
        self.rules: list[tuple[int, int]] = []
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(ids[a] << 20 | ids[b], k)
            self.product.append(ids[a + b])
            self.parts.setdefault(ids[a + b], (ids[a], ids[b]))
            self.rules.append((ids[a], ids[b]))
        self._steps = {k: spec.get(k) for k in ("normalizer", "pre_tokenizer")}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    @functools.cached_property
    def library(self):
        """The library's own normaliser and splitter, for code points that Python's Unicode tables do not hold yet."""
        from tokenizers import Tokenizer

        empty = {"type": "BPE", "vocab": {}, "merges": []}
        return Tokenizer.from_str(json.dumps({"version": "1.0", "added_tokens": [], "model": empty, "post_processor": None, "decoder": None, **self._steps}))

    @functools.cached_property
    def length(self) -> dict[int, int]:
        """Bytes of each token."""
        return {i: len(t.removesuffix(WORD_END)) or len(t) for i, t in self.token.items()}

    @functools.cached_property
    def lookahead(self) -> int:
        """Bytes right of a boundary that decide whether a merge removes it, from the merge list alone.

        Rule r = (u, v) removes the boundary before v only if the boundary after v lived until r, and only
        rules of lower rank whose left side lies on v's right edge could have removed that one.
        """
        reach: dict[int, int] = {}
        longest = 1
        for u, v in self.rules:
            beyond, edge = 0, v
            while True:
                beyond = max(beyond, reach.get(edge, 0))
                if edge not in self.parts:
                    break
                edge = self.parts[edge][1]
            chain = self.length[v] + beyond
            reach[u] = max(reach.get(u, 0), chain)
            longest = max(longest, chain)
        return longest + 1

    def merge(self, symbols: list[int]) -> list[int]:
        """All merges of a symbol sequence, lowest rank first, leftmost first."""
        if len(symbols) > 48:
            return self._merge_long(symbols)
        get, product = self.rank.get, self.product
        ranks = [get(a << 20 | b, INFINITY) for a, b in zip(symbols, symbols[1:])]
        while ranks and (k := min(ranks)) != INFINITY:
            i = ranks.index(k)
            symbols[i] = made = product[k]
            del symbols[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(symbols[i - 1] << 20 | made, INFINITY)
            if i < len(ranks):
                ranks[i] = get(made << 20 | symbols[i + 1], INFINITY)
        return symbols

    @functools.cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Pair -> rank as an open-addressing table."""
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        ranks = np.fromiter(self.rank.values(), np.int64, len(self.rank))
        bits = max(8, (len(keys) * 16).bit_length())
        slots, values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        at = self._slot(keys, bits)
        while len(keys):
            free = slots[at] == -1
            slots[at[free]] = keys[free]
            won = slots[at] == keys
            values[at[won]] = ranks[won]
            keys, ranks, at = keys[~won], ranks[~won], (at[~won] + 1) & ((1 << bits) - 1)
        return slots, values, bits

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slots, values, bits = self._table
        keys = a.astype(np.int64) << 20 | b
        at = self._slot(keys, bits)
        held = slots[at]
        out = np.where(held == keys, values[at], _NONE)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << bits) - 1)
            held = slots[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = values[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    @functools.cached_property
    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.byte_id, np.int32), np.array(self.final_id, np.int32), np.array(self.product, np.int32)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens, one after the other, and where each pre-token's begin (and the last's end).

        The end of a pre-token decides all that is held, so the machines of short ones finish side by side,
        a merge of each per step; longer ones stream one at a time.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        low, parts, n_ids = 0, [], np.zeros(len(words), np.int64)
        for width in BATCH_BYTES:
            some = np.flatnonzero((sizes > low) & (sizes <= width))
            for at in range(0, len(some), 1 << 14):
                own = some[at : at + (1 << 14)]
                symbols, n_ids[own] = self._side_by_side([words[i] for i in own.tolist()], width)
                parts.append((own, symbols[np.arange(width + 1) < n_ids[own][:, None]]))
            low = width
        for i in np.flatnonzero(sizes > low).tolist():
            ids = np.array(self.word(words[i]), np.int32)
            n_ids[i] = len(ids)
            parts.append((np.array([i]), ids))
        starts = np.concatenate([[0], np.cumsum(n_ids)])
        out = np.empty(starts[-1], np.int32)
        for own, ids in parts:
            n = n_ids[own]
            out[np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return out, starts

    def _side_by_side(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """A row of symbols per word, and how many of them count."""
        first, final, product = self._arrays
        n, columns = len(words), np.arange(width)
        sizes = np.fromiter(map(len, words), np.int64, n)
        symbols = np.zeros((n, width + 1), np.int32)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols[:, :width][columns < sizes[:, None]] = first[data]
        symbols[np.arange(n), sizes - 1] = final[data[np.cumsum(sizes) - 1]]
        ranks = np.full((n, width + 1), _NONE, np.int32)
        pairs = columns < sizes[:, None] - 1
        ranks[:, :width][pairs] = self._ranks(symbols[:, :width][pairs], symbols[:, 1:][pairs])
        live, done, done_sizes = np.arange(n), symbols.copy(), sizes.copy()
        while len(live):
            k = ranks.argmin(axis=1)
            rows = np.arange(len(k))
            rank = ranks[rows, k]
            more = rank != _NONE
            if not more.all():
                ended = live[~more]
                done[ended], done_sizes[ended] = symbols[~more], sizes[~more]
                live, symbols, ranks, sizes, k, rank = live[more], symbols[more], ranks[more], sizes[more], k[more], rank[more]
                rows = np.arange(len(k))
                if not len(live):
                    break
            keep = np.arange(width) <= k[:, None]
            symbols[:, :width] = np.where(keep, symbols[:, :width], symbols[:, 1:])
            ranks[:, :width] = np.where(keep, ranks[:, :width], ranks[:, 1:])
            symbols[rows, k] = product[rank]
            sizes -= 1
            right = self._ranks(symbols[rows, k], symbols[rows, k + 1])
            ranks[rows, k] = np.where(k + 1 < sizes, right, _NONE)
            inner = np.flatnonzero(k > 0)
            ranks[inner, k[inner] - 1] = self._ranks(symbols[inner, k[inner] - 1], symbols[inner, k[inner]])
        return done, done_sizes

    def _merge_long(self, symbols: list[int]) -> list[int]:
        n, get = len(symbols), self.rank.get
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(k, i) for i in range(n - 1) if (k := get(symbols[i] << 20 | symbols[i + 1], INFINITY)) != INFINITY]
        heapq.heapify(heap)
        while heap:
            k, i = heapq.heappop(heap)
            j = after[i] if live[i] else n
            if j >= n or get(symbols[i] << 20 | symbols[j], INFINITY) != k:
                continue
            symbols[i], live[j], after[i] = self.product[k], False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n and (r := get(symbols[left] << 20 | symbols[after[left]], INFINITY)) != INFINITY:
                    heapq.heappush(heap, (r, left))
        return [s for s, keep in zip(symbols, live) if keep]

    def stream(self, pieces: Iterable[bytes]) -> Iterator[int]:
        """Token ids of one pre-token that arrives in pieces; each is emitted once no later byte can change it."""
        held = b""
        look = self.lookahead
        for piece in pieces:
            for at in range(0, len(piece), STRIDE):
                held += piece[at : at + STRIDE]
                if len(held) < look + STRIDE + 1:
                    continue
                safe, end = len(held) - 1 - look, 0
                for t in self.merge([self.byte_id[b] for b in held[:-1]]):
                    if end + self.length[t] > safe:
                        break
                    end += self.length[t]
                    yield t
                held = held[end:]
        if held:
            yield from self.merge([self.byte_id[b] for b in held[:-1]] + [self.final_id[held[-1]]])

    def word(self, data: bytes) -> list[int]:
        return list(self.stream([data]))


@functools.lru_cache(4)
def load(name: str) -> Vocabulary:
    """A vocabulary by file path, or by its name among the installed public tokenizers; once per worker."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Vocabulary(name)


class Memo(dict):
    """A memo of the encoder: pre-token -> what ``make`` derives from its ids.

    ``make`` gets the ids of many pre-tokens and the places where each one's begin, and gives their values.  The
    memo is bounded: once a generation is full it becomes the old one, from which only what is met again returns.
    """

    def __init__(self, vocabulary: Vocabulary, make: Callable[[np.ndarray, list[int]], list], most: int = CACHE_WORDS):
        super().__init__()
        self.vocabulary, self.make, self.most = vocabulary, make, most
        self.old: dict = {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            ids = np.array(self.vocabulary.word(word.encode()), np.int32)
            value = self.make(ids, [0, len(ids)])[0]
        if len(word) <= REMEMBERED:
            self.turn()
            self[word] = value
        return value

    def turn(self) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()

    def learn(self, runs: Iterable[list[str]]) -> None:
        """Works out all unknown short pre-tokens together, which is much cheaper than one at a time."""
        self.turn()
        new = set().union(*runs).difference(self)
        if self.old:
            old = self.old
            back = {w: old[w] for w in new if w in old}
            self.update(back)
            new.difference_update(back)
        words = [w for w in new if len(w) <= REMEMBERED]
        if words:
            ids, starts = self.vocabulary.words([w.encode() for w in words])
            self.update(zip(words, self.make(ids, starts.tolist())))


def _blocks(text: str) -> Iterator[str]:
    """The text in blocks that end at white space, so that no word is cut."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        gap = _SEPARATORS.search(text, at + BLOCK_CHARS)
        if not gap:
            break
        yield text[at : gap.end()]
        at = gap.end()
    yield text[at:] if at else text


_UNASSIGNED, _OTHER_NUMBER = 1, 2


@functools.cache
def _rare_kinds() -> np.ndarray:
    category = np.array(list(map(unicodedata.category, map(chr, range(0x110000)))))
    return np.where(category == "Cn", _UNASSIGNED, np.where((category == "Nl") | (category == "No"), _OTHER_NUMBER, 0)).astype(np.uint8)


def rare_kinds(text: str) -> int:
    """Whether a code point is unknown to Python's Unicode tables (the library may know a later version's), and whether one is a number but no digit."""
    return int(np.bitwise_or.reduce(_rare_kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)], initial=0))


def _pre_tokens(text: str, vocabulary: Vocabulary) -> list[str]:
    if text.isascii():
        return _ASCII_WORDS.findall(text.lower())
    rare = rare_kinds(text)
    if rare & _UNASSIGNED:
        library, byte_of = vocabulary.library, vocabulary.byte_of
        parts = _SEPARATORS.split(library.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in piece).decode() for part in parts if part for piece, _ in library.pre_tokenizer.pre_tokenize_str(part)]
    # A per-character mapping has no final sigma.
    return (_WORDS if rare else _PLAIN_WORDS).findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def runs(text: str, vocabulary: Vocabulary) -> Iterator[list[str] | int]:
    """Pre-tokens of a text in lists, and the ids of special tokens between them."""
    for block in _blocks(text):
        if vocabulary.special_pattern and "<|" in block:
            for k, part in enumerate(vocabulary.special_pattern.split(block)):
                if k % 2:
                    yield vocabulary.special[part]
                elif part:
                    yield _pre_tokens(part, vocabulary)
        else:
            yield _pre_tokens(block, vocabulary)


class TextDecoder:
    """Byte-to-text state machine: ids in, text out as soon as its bytes are complete.

    ``joined`` follows a tokenizer file without a decoder, whose library output is the tokens joined by
    one space; otherwise tokens become bytes, word ends become spaces, and broken UTF-8 is replaced.
    """

    def __init__(self, vocabulary: Vocabulary, joined: bool = False):
        self.vocabulary, self.joined, self.begun = vocabulary, joined, False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        tokens = [self.vocabulary.token[i] for i in ids]
        if self.joined:
            text = " ".join(tokens)
            text, self.begun = (" " + text if self.begun and tokens else text), self.begun or bool(tokens)
            return text
        out = []
        for t in tokens:
            if t in self.vocabulary.special:
                out.append(self.state.decode(b"", True) + t)
                continue
            body = t.removesuffix(WORD_END) or t
            out.append(self.state.decode(bytes(self.vocabulary.byte_of[c] for c in body)) + (" " if body != t else ""))
        return "".join(out)

    def finish(self) -> str:
        return "" if self.joined else self.state.decode(b"", True)


def gathered(texts: Iterable[str | None], vocabulary: Vocabulary, caches: list[Memo]) -> Iterator[list[list[str] | int]]:
    """The runs of each text, after the memos have learned those of some texts at a time."""
    held: list[list[list[str] | int]] = []
    size = 0

    def learned() -> list[list[list[str] | int]]:
        new = [run for own in held for run in own if not isinstance(run, int)]
        for cache in caches:
            cache.learn(new)
        return held

    for text in texts:
        if text and len(text) > BATCH_CHARS:  # block by block
            yield from learned()
            held, size = [], 0
            yield runs(text, vocabulary)
            continue
        held.append(list(runs(text or "", vocabulary)))
        size += len(text or "")
        if size > BATCH_CHARS:
            yield from learned()
            held, size = [], 0
    yield from learned()


def plain(text: str, vocabulary: Vocabulary) -> str | None:
    """The normalised text if white space divides it into parts that can be split into pre-tokens one by one; null for special tokens and the library's own splits."""
    if len(text) > BATCH_CHARS or (vocabulary.special_pattern and "<|" in text):
        return None
    if text.isascii():
        return text.lower()
    return None if rare_kinds(text) & _UNASSIGNED else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def distinct_parts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The distinct parts between ASCII white space of ``plain`` texts (a line each), the line of each part, and where each text's parts begin (and the last's end)."""
    parts = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    coded = parts.flatten().dictionary_encode()
    lines = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
    return pc.binary_join(lines, "\n")[0].as_py() + "\n", coded.indices.to_numpy(), parts.offsets.to_numpy()


def line_ids(lines: str, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all lines, one after the other, and where each line's begin (and the last's end); the memo's values are ids as bytes."""
    words = (_WORD_LINES if rare_kinds(lines) & _OTHER_NUMBER else _PLAIN_LINES).findall(lines)
    memo.learn([words])
    memo["\n"] = b""  # the end of a line; any pre-token has an id
    values = list(map(memo.__getitem__, words))
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    return np.frombuffer(b"".join(values), np.uint32), np.concatenate([[0], np.cumsum(sizes)[sizes == 0]])


def encode(text: str | None, vocabulary: Vocabulary) -> Iterator[int]:
    """Ids of a whole text, as a stream; null counts as empty."""
    for run in runs(text or "", vocabulary):
        if isinstance(run, int):
            yield run
        else:
            for word in run:
                yield from vocabulary.word(word.encode())
