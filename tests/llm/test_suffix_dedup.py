import hashlib
import random

import numpy as np

from scriptorium.llm import suffix_dedup


def plain(rows, n=100):
    """Removed bytes of each (id, text), by looking at every string of n bytes."""
    first = {}
    order = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in order:
        for p in range(len(b) - n + 1):
            w = b[p : p + n]
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for i, b in order:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < (i, p):
                gone[p : p + n] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def test_every_window_has_the_same_anchor_wherever_it_stands():
    rnd = np.random.default_rng(1)
    text = rnd.integers(97, 101, 4000).astype(np.uint8)
    pos, _ = suffix_dedup.anchors(text)
    for p in range(0, len(text) - 100, 37):
        own, _ = suffix_dedup.anchors(text[p : p + 100])
        assert len(own) and set((own + p).tolist()) <= set(pos.tolist())


def test_slices_change_nothing(monkeypatch):
    text = np.random.default_rng(2).integers(97, 99, 5000).astype(np.uint8)
    want = suffix_dedup.anchors(text)
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    got = suffix_dedup.anchors(text)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_repeats(docs, none, rows):
    want = sorted((str(r[0]), *p) for r, p in zip(rows, plain([(r[0], r[1]) for r in rows])))
    out = suffix_dedup.repeated_bytes(docs).collect()
    assert sorted((str(r["doc_id"]), *r[1:5]) for r in out) == want
    assert sum(r["n_removed"] for r in out) > 1000
    assert all(sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in out)
    assert suffix_dedup.repeated_bytes(none).count() == 0


def test_repeats_in_mixed_contexts(spark):
    rnd = random.Random(9)
    letters = "abcé "
    passages = ["".join(rnd.choice(letters) for _ in range(rnd.randint(60, 260))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [rnd.choice(passages)[rnd.choice([0, 0, 3, 31]) :] if rnd.random() < 0.6 else "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 120))) for _ in range(rnd.randint(1, 6))]
        rows.append((rnd.choice([i, i, i // 2]), "".join(parts)))
    rows += [(900, "ab" * 300), (901, "x" + "ab" * 200), (5, "z" * 99), (6, "z" * 100), (7, "z" * 101)]
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted((r[0], *r[1:5]) for r in got) == sorted((r[0], *p) for r, p in zip(rows, plain(rows)))


def test_without_repeats_keeps_columns(docs, rows):
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert sum(r["text"] is None for r in out.collect()) == sum(r[1] is None for r in rows)
