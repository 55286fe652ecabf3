import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import language_id, lm_score, ppm, topk


def counts_of(texts):
    return ppm.Counts.from_grams(*ppm.gram_counts(texts))


def test_probabilities_sum_to_one_and_equal_the_plain_coder():
    train = [b"the harbor the lantern the harbor", b"hello there", b"", b"zz"]
    model = ppm.build([counts_of(train)])
    plain = ppm.Adaptive()
    for t in train:
        plain.bits(t)
    for context in (b"the", b"xqz", b"\0\0\0", b"har", b"llo"):
        p = [2 ** -(model.score([context + bytes([s])]) - model.score([context]))[0, 0] for s in range(256)]
        assert sum(p) == pytest.approx(1, abs=1e-4)
    for t in (b"the harbor", b"a new text", b"", b"zzzz\xff"):
        assert model.score([t])[0, 0] == pytest.approx(plain.bits(t, learn=False), rel=1e-5)


def test_pruned_tree_still_is_a_code():
    model = ppm.build([counts_of([b"abcabcabdabeabf" * 20]), counts_of([b"xyzxyzxyw" * 30])], most_contexts=3)
    for context in (b"abc", b"xyz", b"cab"):
        p = np.array([2 ** -(model.score([context + bytes([s])]) - model.score([context]))[0] for s in range(256)])
        assert p.sum(axis=0) == pytest.approx([1, 1], abs=1e-4)


def test_scores_do_not_depend_on_the_batch(monkeypatch):
    texts = [b"alpha beta", b"", b"gamma", b"x" * 1000]
    model = ppm.build([counts_of(texts)])
    whole = model.score(texts)
    assert np.allclose(np.concatenate([model.score([t]) for t in texts]), whole)


def test_language_id_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.95
    assert out["score"].between(0, 1).all()


def test_language_id_odd_rows(docs, none, rows):
    out = language_id.identify(docs).collect()
    assert len(out) == len(rows)
    held = {str(r[0]): zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 3 == 1 for r in rows}
    unknown = Counter(str(r[0]) for r in rows if not any(c.isalpha() for c in r[1] or ""))
    assert all(r["held_out"] == held[str(r["doc_id"])] for r in out)
    assert Counter(str(r["doc_id"]) for r in out if r["lang_pred"] == "und") == unknown
    assert language_id.identify(none).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def lower(text):
    return (text or "").encode().lower()


def test_lm_score(docs, none, rows):
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 5 == 1 for r in rows]
    train = [lower(r[1]) for r, h in zip(rows, held) if not h]
    counts = Counter(w for t in train for w in t.split())
    counts[None] = len(train)
    n, v = sum(counts.values()), len(counts)
    plain = ppm.Adaptive()
    for t in train:
        plain.bits(t)
    want = []
    for r, h in zip(rows, held):
        words = [*lower(r[1]).split(), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        score = -plain.bits(lower(r[1]), learn=False) * math.log10(2) if len(r[1] or "") < 3000 else None
        want.append((str(r[0]), h, len(words), sum(counts[w] > 0 for w in words), n, base, score))
    got = lm_score.score_documents(docs).collect()
    key = lambda x: (x[0], x[2], x[5])
    for g, w in zip(sorted(((str(r[0]), *r[1:]) for r in got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert w[6] is None or g[6] == pytest.approx(w[6], rel=1e-4, abs=1e-6)
    assert lm_score.score_documents(none).count() == 0


def test_rare_words_meet_their_counts(docs, monkeypatch):
    key = lambda r: (str(r[0]), r[2], r[5])
    want = sorted(map(tuple, lm_score.score_documents(docs).collect()), key=key)
    monkeypatch.setattr(lm_score, "FREQUENT_SHARE", 40)  # nearly all words are exchanged
    got = sorted(map(tuple, lm_score.score_documents(docs).collect()), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_grams_equal_the_plain_coder():
    rnd = np.random.default_rng(6)
    train = [bytes(rnd.integers(97, 104, 60).tolist()) for _ in range(30)]
    plain = ppm.Adaptive()
    for t in train:
        plain.bits(t)
    counts = counts_of(train)
    singles, pairs = np.zeros(256), np.zeros(1 << 16)
    singles[counts.by_order[0][0]], pairs[counts.by_order[1][0]] = counts.by_order[0][1], counts.by_order[1][1]
    grams = ppm.Grams(*counts.by_order[3], pairs.reshape(256, 256), singles)
    model = ppm.build([counts], most_contexts=20)
    for t in (train[0], b"abcgfz", b"xyzxyz", b"", b"a", b"\xffabc\xfe"):
        bits, which, gram, times = model.split([b"abc", t])
        assert len(gram) or not t
        rare = np.bincount(which, times * grams.bits(gram), 2)
        assert (bits[:, 0] + rare).tolist() == pytest.approx([plain.bits(b"abc", learn=False), plain.bits(t, learn=False)], rel=1e-5)


@pytest.mark.parametrize("share", [40, 2000])
def test_rare_contexts_meet_their_counts(spark, monkeypatch, share):
    """Contexts below the share of what is sent to executors count as whole as the others, in every text."""
    rnd = np.random.default_rng(8)
    texts = ["".join(map(chr, rnd.choice(24, rnd.integers(1, 200), p=np.arange(24, 0, -1) / 300) + 97)) for _ in range(150)] + ["", None, "é zz", "abc" * 50]
    rows = [(i, t) for i, t in enumerate(texts)]
    plain = ppm.Adaptive()
    for i, t in rows:
        if not lm_score._is_held_out(i):
            plain.bits(lower(t))
    monkeypatch.setattr(lm_score, "FREQUENT_SHARE", share)
    monkeypatch.setattr(lm_score, "CHUNK_DOCS", 7)
    got = {r["doc_id"]: r["score"] for r in lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx([-plain.bits(lower(t), learn=False) * math.log10(2) for _, t in rows], rel=1e-5, abs=1e-6)


def plain_top(rows, is_query, k=5):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: (i, v) for i, v in vectors if is_query(i)}.values():
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q and len(b) == len(a))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(i), rnd.normal(0, 0.3, 6).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 40, 3)] + [(2000, None), (2050, []), (2100, [float("nan")] * 6), (2150, [None, *[1.0] * 5]), (2200, [1.0, 2.0]), (2250, [0.5, -1.0]), (None, [1.0] * 6), (2300, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, rank string").repartition(3)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == plain_top(rows, lambda i: i % 50 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = df.filter("vec_id < 3 or vec_id = 50")
    assert sorted(map(tuple, topk.top_k(few, F.col("vec_id") % 50 == 0).collect())) == plain_top([r for r in rows if r[0] is not None and (r[0] < 3 or r[0] == 50)], lambda i: i % 50 == 0)


def test_top_k_on_the_grid(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rnd.normal(size=5)]) for i in range(400)] + [(400 + i, [1e15 * float(v) for v in rnd.normal(size=3)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = F.col("vec_id") % 20 == 0
    want = sorted(map(tuple, topk.top_k(df.filter("vec_id < 400"), asked).collect()))
    assert want == plain_top(rows[:400], lambda i: i % 20 == 0)
    monkeypatch.setattr(topk, "BROADCAST_LIMIT", -1)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 64)
    assert sorted(map(tuple, topk.top_k(df.filter("vec_id < 400"), asked).collect())) == want
    assert "CartesianProduct" not in topk.top_k(df, asked)._jdf.queryExecution().executedPlan().toString()


def test_lists_are_read_in_order_and_bounds_stop_early():
    rnd = np.random.default_rng(6)
    x = np.floor(rnd.normal(size=(300, 4)) * 100)
    x[7] = 3000  # one candidate far ahead of all others
    for scale in (1, 1 << 18, 1 << 30):  # sums in single, double and whole numbers
        got = list(topk.block_top(np.array([1000]), x[7:8] * scale, np.arange(300), x * scale, 1))
        assert [(q, ids.tolist(), [int(s) for s in score]) for q, ids, score in got] == [(1000, [7], [4 * 9_000_000 * scale * scale])]


def test_language_equals_the_plain_coder(spark):
    """No context is left out: code lengths are those of a plain coder that learned the same rows."""
    rnd = np.random.default_rng(8)
    words = {lang: ["".join(rnd.choice(list(letters), rnd.integers(2, 7))) for _ in range(60)] for lang, letters in (("aa", "abcdeéf"), ("bb", "abcxyzß"), ("cc", "klmnoabñ"))}
    rows = [(i, " ".join(rnd.choice(words[lang], 25)), lang) for i, lang in enumerate(list(words) * 12)]
    rows.append((100, " ".join(rnd.choice(words["aa"], 9000)), "dd"))  # a language whose only text is long
    rows += [(200 + i, " ".join(rnd.choice(words[lang], 6)), None) for i, lang in enumerate(list(words) * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    held = {r["doc_id"] for r in language_id.identify(df).filter("held_out").collect()}
    coders = {}
    for i, t, lang in rows:
        if lang and i not in held:
            coders.setdefault(lang, ppm.Adaptive()).bits(t.encode())
    langs = sorted(coders)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(df).collect()}
    fit_langs, model = language_id.fit(df.filter(~language_id.held_out()))
    assert fit_langs == langs
    texts = [t.encode() for _, t, _ in rows if len(t) < 5000] + [b"zz \x00\xff", b""]
    bits = model.score(texts)
    for t, own in zip(texts, bits):
        assert np.allclose([coders[lang].bits(t, learn=False) for lang in langs], own, rtol=1e-5, atol=1e-3)
    for i, t, _ in rows:
        if len(t) < 5000:
            lengths = [coders[lang].bits(t.encode(), learn=False) for lang in langs]
            assert lengths[langs.index(got[i])] <= min(lengths) + 1e-2


def test_remembered_lengths_are_bounded(monkeypatch):
    keys, n = ppm.gram_counts([b"some words and other words, again and again"] * 3)
    model = ppm.Lengths([ppm.Grams.whole(keys, n.astype(float))])
    texts = [b"some words", b"other things entirely", b"again", b"zebra quiz"]
    want = [model.score([t])[0, 0] for t in texts]
    monkeypatch.setattr(ppm, "KNOWN_GRAMS", 4)
    assert [model.score([t])[0, 0] for t in texts] == want
