"""Prediction by partial matching over bytes, with frozen counts.

A model is a tree of byte contexts of up to three bytes.  A symbol is coded in the longest context of the
tree; where it was not seen, an escape (method C: as likely as the context has distinct symbols) leads to
the next shorter one, whose counts leave out all symbols of the longer (symbol exclusion), and at last to
equal shares for bytes never seen.  Counts do not change while texts are scored, so the code length of
each symbol in each context is worked out once, and scoring is two array look-ups a byte.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

ORDER = 3
PAD = b"\0" * ORDER


def _batch(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer, each text after its padding, and the bounds of the texts in it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + ORDER)
    buffer = np.frombuffer(PAD + PAD.join(texts) if texts else b"", np.uint8)
    return buffer, np.stack([ends - sizes, ends], axis=1)


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, symbol) grams of ORDER + 1 bytes, big-endian in uint32, and their counts."""
    buffer, bounds = _batch(texts)
    if len(buffer) <= ORDER:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    b = buffer.astype(np.uint32)
    keys = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    inside = np.ones(len(keys), bool)
    for k in range(ORDER):  # padding itself is no symbol
        at = bounds[:, 0] - ORDER + k - ORDER
        inside[at[at >= 0]] = False
    return np.unique(keys[inside], return_counts=True)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)

#: Bytes scored at a time; their arrays take about 30 bytes each and some more per model.
SCORED_BYTES = 1 << 18
#: Grams whose code lengths a worker remembers.
KNOWN_GRAMS = 1 << 20


class Counts:
    """Counts of one corpus by order: order k has keys of k + 1 bytes; order 3 may hold only some contexts."""

    def __init__(self, by_order: list[tuple[np.ndarray, np.ndarray]]):
        self.by_order = by_order

    @classmethod
    def from_grams(cls, keys: np.ndarray, n: np.ndarray) -> Counts:
        orders = []
        for k in range(ORDER + 1):
            low = keys & np.uint32((1 << 8 * (k + 1)) - 1)
            short, where = np.unique(low, return_inverse=True)
            orders.append((short.astype(np.int64), np.bincount(where, n, len(short))))
        return cls(orders)

    @functools.cached_property
    def symbols(self) -> np.ndarray:
        return self.by_order[0][0].astype(np.int64)


@dataclass
class Model:
    """Frozen code lengths: ``row`` maps three context codes to a tree node, ``bits`` node and symbol to bits per model."""

    code: np.ndarray  # byte -> symbol code; the last code stands for all bytes never seen
    row: np.ndarray
    bits: np.ndarray  # (nodes * symbols, models)
    deep: int = 0  # first node of the longest contexts

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each model; whole texts, in slices of bounded size."""
        out = np.zeros((len(texts), self.bits.shape[1]))
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held > SCORED_BYTES or i + 1 == len(texts):
                self._score(texts[start : i + 1], out[start : i + 1])
                start, held = i + 1, 0
        return out

    def split(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bits of each text over the symbols whose longest context is a node, and the others as grams: text, gram, times."""
        out = np.zeros((len(texts), self.bits.shape[1]))
        start, held, rest = 0, 0, []
        for i, t in enumerate(texts):
            held += len(t)
            if held > SCORED_BYTES or i + 1 == len(texts):
                self._score(texts[start : i + 1], out[start : i + 1], rest, start)
                start, held = i + 1, 0
        keys, times = merge_counts(rest)
        return out, (keys >> 32).astype(np.int64), keys & 0xFFFFFFFF, times

    def _score(self, texts: list[bytes], out: np.ndarray, rest: list | None = None, first: int = 0) -> None:
        buffer, bounds = _batch(texts)
        a = int(self.code.max()) + 1
        c = self.code[buffer]
        step = SCORED_BYTES
        for at in range(0, max(0, len(c) - ORDER), step):
            d = c[at : at + step + ORDER]
            node = self.row[(d[:-3] * a + d[1:-2]) * a + d[2:-1]]
            bits = self.bits[node * a + d[3:]]
            if rest is not None:
                short = np.flatnonzero(node < self.deep)
                bits[short] = 0
                where = at + short
                which = np.searchsorted(bounds[:, 1] - ORDER, where, "right")
                inside = where >= np.append(bounds[:, 0], len(buffer) + ORDER)[which] - ORDER
                where, which = where[inside], which[inside]
                gram = sum(buffer[where + k].astype(np.int64) << 8 * (ORDER - k) for k in range(ORDER + 1))
                rest.append(np.unique((first + which) << 32 | gram, return_counts=True))
            lo = np.clip(bounds[:, 0] - ORDER - at, 0, len(bits))
            hi = np.clip(bounds[:, 1] - ORDER - at, 0, len(bits))
            some = np.flatnonzero(hi > lo)
            if len(some):
                pairs = np.stack([lo[some], hi[some]], axis=1).reshape(-1)
                tail = np.concatenate([bits, np.zeros((1, bits.shape[1]), bits.dtype)])
                out[some] += np.add.reduceat(tail, pairs, axis=0, dtype=np.float64)[::2]


def build(corpora: list[Counts], most_contexts: int = 1 << 16) -> Model:
    """A model per corpus over one tree, whose nodes are the contexts that any corpus holds.

    ``most_contexts`` bounds the nodes of orders 2 and 3 (the most frequent stay; others are coded in their
    shorter context), which bounds the size of what executors receive.
    """
    seen = np.unique(np.concatenate([[0], *(c.symbols for c in corpora)]).astype(np.int64))  # 0: padding, as a context
    code = np.full(256, len(seen), np.int32)
    code[seen] = np.arange(len(seen))
    a, others = len(seen) + 1, 256 - len(seen)
    code_of_other = len(seen)

    def coded(keys: np.ndarray, order: int) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for k in range(order, -1, -1):
            out = out * a + code[(keys >> (8 * k)) & 255]
        return out

    levels: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []  # by corpus and order: contexts, symbols, counts
    for corpus in corpora:
        levels.append([((x := coded(keys, k)) // a, x % a, n) for k, (keys, n) in enumerate(corpus.by_order)])
    nodes = [np.zeros(1, np.int64), np.arange(a, dtype=np.int64)]
    for k in (2, 3):
        contexts, where = np.unique(np.concatenate([x[k][0] for x in levels] or [np.empty(0, np.int64)]), return_inverse=True)
        weight = np.bincount(where, np.concatenate([x[k][2] for x in levels] or [np.empty(0)]), len(contexts))
        top = np.sort(np.argsort(-weight, kind="stable")[:most_contexts])
        nodes.append(contexts[top])
    row = np.repeat(np.tile(np.arange(a), 1)[None, :], a * a, axis=0).reshape(a, a, a).astype(np.int32)
    base = a
    row.reshape(a, a * a)[:, nodes[2]] = base + np.arange(len(nodes[2]))
    row.reshape(-1)[nodes[3]] = base + len(nodes[2]) + np.arange(len(nodes[3]))
    total = base + len(nodes[2]) + len(nodes[3])
    bits = np.empty((total, a, len(corpora)), np.float32)
    for m, own in enumerate(levels):
        sorted_levels = []
        for contexts, symbols, n in own:
            order = np.argsort(contexts, kind="stable")
            sorted_levels.append((contexts[order], symbols[order], n[order]))

        def counts(k: int, wanted: np.ndarray) -> np.ndarray:
            contexts, symbols, n = sorted_levels[k]
            lo, hi = np.searchsorted(contexts, wanted), np.searchsorted(contexts, wanted, "right")
            sizes = hi - lo
            dense = np.zeros((len(wanted), a))
            which = np.repeat(np.arange(len(wanted)), sizes)
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)
            dense[which, symbols[at]] = n[at]
            return dense

        first = 0
        for order in (1, 2, 3):
            for at in range(0, len(nodes[order]), 4096):
                contexts = nodes[order][at : at + 4096]
                bits[first + at : first + at + len(contexts), :, m] = _code_lengths([counts(k, contexts % a**k) for k in range(order, -1, -1)], code_of_other, others)
            first += len(nodes[order])
    return Model(code, row.reshape(-1), bits.reshape(total * a, len(corpora)), base + len(nodes[2]))


def _runs(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted ``keys`` and the sums of ``n`` over each."""
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else np.empty(0)


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``values`` at ``wanted`` among sorted ``keys``; zero where a key is absent."""
    at = np.searchsorted(keys, wanted)
    found = at < len(keys)
    found[found] = keys[at[found]] == wanted[found]
    out = np.zeros(len(wanted))
    out[found] = values[at[found]]
    return out


class Grams:
    """Code lengths straight from counts, for contexts too many to be nodes of a model.

    ``grams`` are all those whose contexts' last two bytes are of some group; ``pairs`` and ``singles`` are
    all counts of orders 1 and 0.  Symbols of a context are symbols of its suffixes too, so what exclusion
    takes from a suffix's counts is a sum over the symbols of the longer context.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray, pairs: np.ndarray, singles: np.ndarray):
        order = np.argsort(grams, kind="stable")
        self.grams, self.n = [grams[order]], [n[order].astype(np.float64)]
        low = self.grams[0] & 0xFFFFFF
        order = np.argsort(low, kind="stable")
        short, own = _runs(low[order], self.n[0][order])
        self.grams.append(short)
        self.n.append(own)
        taken = [_at(short, own, low), pairs[short >> 8 & 255, short & 255]]
        self.contexts = []  # per order 3 and 2: contexts, their counts, distinct symbols, and what exclusion takes below
        for keys, n_of, below in zip(self.grams, self.n, taken):
            contexts, whole = _runs(keys >> 8, n_of)
            self.contexts.append((contexts, whole, _runs(keys >> 8, np.ones(len(keys)))[1], _runs(keys >> 8, below)[1]))
        self.pairs, self.singles = pairs, singles
        self.ones = (pairs.sum(axis=1), (pairs > 0).sum(axis=1), (pairs > 0) @ singles)

    @classmethod
    def whole(cls, grams: np.ndarray, n: np.ndarray) -> Grams:
        """Of all the grams of a corpus."""
        counts = np.bincount(grams & 0xFFFF, n, 1 << 16).reshape(256, 256)
        return cls(grams.astype(np.int64), n, counts, counts.sum(axis=0))

    def bits(self, wanted: np.ndarray) -> np.ndarray:
        """Bits of each gram: its symbol in its context of three bytes."""
        levels = []
        for k, mask in enumerate((0xFFFFFFFF, 0xFFFFFF)):
            keys = wanted & mask
            levels.append((_at(self.grams[k], self.n[k], keys), *(_at(self.contexts[k][0], v, keys >> 8) for v in self.contexts[k][1:])))
        last, symbol = wanted >> 8 & 255, wanted & 255
        levels.append((self.pairs[last, symbol], *(v[last] for v in self.ones)))
        levels.append((self.singles[symbol], self.singles.sum(), (self.singles > 0).sum(), 0))
        out, spent, coded = np.zeros(len(wanted)), np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        gone, known = 0, 0  # counts and distinct symbols that longer contexts exclude
        with np.errstate(divide="ignore", invalid="ignore"):
            for n, whole, distinct, below in levels:
                fresh = distinct - known
                total = whole - gone + fresh
                here = ~coded & (n > 0)
                out = np.where(here, spent + np.log2(total) - np.log2(n), out)
                coded |= here
                spent = spent + np.where(fresh > 0, np.log2(total) - np.log2(fresh), 0)
                gone, known = below, distinct
        return np.where(coded, out, spent + np.log2(max(256 - int((self.singles > 0).sum()), 1)))


class Lengths:
    """Code lengths under several models, straight from their counts; those worked out are remembered up to a bound."""

    def __init__(self, models: list[Grams]):
        self.models = models
        self.known, self.bits = np.empty(0, np.uint32), np.empty((0, len(models)), np.float32)

    def __reduce__(self):
        return Lengths, (self.models,)

    def _bits(self, grams: np.ndarray) -> np.ndarray:
        """Bits of distinct sorted grams."""
        at = np.minimum(np.searchsorted(self.known, grams), max(len(self.known) - 1, 0))
        new = grams[self.known[at] != grams] if len(self.known) else grams
        if len(new):
            if len(self.known) + len(new) > KNOWN_GRAMS:
                self.known, self.bits, new = self.known[:0], self.bits[:0], grams
            bits = np.stack([m.bits(new.astype(np.int64)) for m in self.models], axis=1).astype(np.float32)
            known = np.concatenate([self.known, new])
            order = np.argsort(known, kind="stable")
            self.known, self.bits = known[order], np.concatenate([self.bits, bits])[order]
            at = np.searchsorted(self.known, grams)
        return self.bits[at]

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each model; whole texts, in slices of bounded size."""
        out = np.zeros((len(texts), len(self.models)))
        start, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held > SCORED_BYTES or i + 1 == len(texts):
                self._score(texts[start : i + 1], out[start : i + 1])
                start, held = i + 1, 0
        return out

    def _score(self, texts: list[bytes], out: np.ndarray) -> None:
        buffer, bounds = _batch(texts)
        for at in range(0, max(0, len(buffer) - ORDER), SCORED_BYTES):
            b = buffer[at : at + SCORED_BYTES + ORDER].astype(np.uint32)
            grams, where = np.unique((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:], return_inverse=True)
            bits = self._bits(grams)[where]
            lo = np.clip(bounds[:, 0] - ORDER - at, 0, len(bits))
            hi = np.clip(bounds[:, 1] - ORDER - at, 0, len(bits))
            some = np.flatnonzero(hi > lo)
            if len(some):
                pairs = np.stack([lo[some], hi[some]], axis=1).reshape(-1)
                tail = np.concatenate([bits, np.zeros((1, bits.shape[1]), bits.dtype)])
                out[some] += np.add.reduceat(tail, pairs, axis=0, dtype=np.float64)[::2]


def _code_lengths(levels: list[np.ndarray], other: int, others: int) -> np.ndarray:
    """Bits per context and symbol, from the counts in the longest context down to order 0."""
    shape = levels[0].shape
    bits, spent, excluded = np.zeros(shape), np.zeros((shape[0], 1)), np.zeros(shape, bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in levels:
            n = np.where(excluded, 0, n)
            fresh = n > 0
            distinct = fresh.sum(axis=1, keepdims=True)
            whole = n.sum(axis=1, keepdims=True) + distinct
            bits = np.where(fresh, spent + np.log2(whole) - np.log2(n), bits)
            spent = spent + np.where(distinct > 0, np.log2(whole) - np.log2(distinct), 0)
            excluded |= fresh
    left = (~excluded).sum(axis=1, keepdims=True) - 1 + others  # symbols of other corpora, and bytes seen in none
    return np.where(excluded, bits, spent + np.log2(np.maximum(left, 1)))


class Adaptive:
    """The same code with counts that grow with each text, for one text at a time; plain and slow."""

    def __init__(self, order: int = ORDER):
        self.order = order
        self.tree: dict[bytes, dict[int, int]] = {}

    def bits(self, text: bytes, learn: bool = True) -> float:
        total, data = 0.0, PAD[: self.order] + text
        for i in range(self.order, len(data)):
            symbol, excluded, coded = data[i], set(), False
            for k in range(self.order, -1, -1):
                n = {s: c for s, c in self.tree.get(data[i - k : i], {}).items() if s not in excluded}
                if n and not coded:
                    whole = sum(n.values()) + len(n)
                    coded = symbol in n
                    total += float(np.log2(whole) - np.log2(n[symbol] if coded else len(n)))
                    excluded |= n.keys()
            if not coded:
                total += float(np.log2(256 - len(excluded)))
            if learn:
                for k in range(self.order + 1):
                    node = self.tree.setdefault(data[i - k : i], {})
                    node[symbol] = node.get(symbol, 0) + 1
        return total
