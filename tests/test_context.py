"""Phrase automaton and caption matching against nested loops in Python."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import fixed
from scriptorium.functions import text as t
from scriptorium.operators import caption_match as m
from scriptorium.operators import phrases, scans, stored


@pytest.mark.parametrize("shard", [phrases.SHARD_BYTES, 24])
@pytest.mark.parametrize("whole", [True, False])
def test_phrases(spark, monkeypatch, shard, whole):
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
    rnd = random.Random(1)
    known = ["art", "the art", "Ärt", "a", "(v.o.)", "long phrase here", "art of", "art", "", None, "x_y", "日本"]
    texts = [(i, "".join(rnd.choices(["art", "the ", "Art ", " of", "part", "ärt", "(V.O.)", " ", "_", "long phrase", " here", "x_y", "日本", "\n"], k=rnd.randint(0, 12)))) for i in range(80)]
    texts += [(80, None), (81, ""), (82, "art " * 20000)]
    rows = spark.createDataFrame(texts, "id int, body string").repartition(4)
    got = phrases.phrase_hits(rows, "id", "body", spark.createDataFrame([(p,) for p in known], "p string"), "p", whole)
    want = set()
    for i, t in texts:
        for p in {p.lower() for p in known if p}:
            if re.search(rf"(?<!\w){re.escape(p)}(?!\w)" if whole else re.escape(p), (t or "").lower()):
                want.add((i, p))
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(set(out)) and set(out) == want


def terms_of(text):
    words = (w.replace("’", "'").lower() for w in re.findall("[A-Za-z][A-Za-z'’-]*", text))
    return {w for w in words if len(w) >= 3 and w not in fixed.MATCH_STOP_WORDS}


def plain_score(source, event, terms):
    flat = lambda v: re.sub("[^a-z0-9]+", "", v.lower())
    event = re.sub(r"\s+", " ", event or "").strip()
    if not event or not re.sub(r"[^a-z0-9㐀-鿿]+", " ", (source or "").lower()).strip():
        return 0.0
    if len(flat(source)) >= 16 and flat(source) in flat(event):
        return 1.0
    hits = sum(en.lower() in source.lower() and zh in event for en, zh in terms)
    a, b = terms_of(source), terms_of(event)
    both = len(a & b)
    if not a or not b:
        return 0.72 if hits else 0.0
    if both < (2 if len(a) <= 4 else 3):
        return 0.72 if hits and both else 0.0
    if len(a) <= 4 and both < len(a):
        return 0.0
    value = both / min(len(a), len(b))
    value = max(value, 0.65) if both >= 3 else value
    return max(value, 0.72 + min(hits, 3) * 0.05) if hits else value


@pytest.mark.parametrize("small", [stored.SMALL_SIDE, 0])
def test_matching_equals_nested_loops(spark, monkeypatch, small):
    monkeypatch.setattr(stored, "SMALL_SIDE", small)
    if not small:
        monkeypatch.setattr(scans, "LARGE_KEY", 20)
        monkeypatch.setattr(scans, "CELL_ROWS", 9)
    rnd = random.Random(8)
    words = [f"{c}word{k}" for c in "abc" for k in range(12)] + ["the", "and", "ab", "don’t", "Harbor", "灯塔"]
    line = lambda n: " ".join(rnd.choices(words, k=n)) + rnd.choice(["", ".", "?!"])
    units = [(f"p{i % 3}", i, f"u{i}", line(rnd.randint(1, 9))) for i in range(140)]
    units += [("p0", 900, "blank", " ..."), ("p0", 901, "none", None), ("p1", 902, "chars", "灯塔"), ("p2", 903, "all", " ".join(words[:20]))]
    events = [(k, k * 2.0, k * 2.0 + 1, line(rnd.randint(1, 8))) for k in range(60)]
    events += [(100 + k, 300.0, 301.0, (u[3] or "").upper() + " tail") for k, u in enumerate(units[:12])] + [(200, 1.0, 2.0, "  "), (201, 1.0, 2.0, None), (202, None, None, "aword0 aword1 aword2 aword3"), (203, 5.0, 6.0, "灯塔")]
    terms = {p: [("aword1", "灯塔"), ("Harbor", "bword2"), ("bword", "cword3"), ("", "x"), ("aword1", "")][:n] for p, n in (("p0", 5), ("p1", 2))}
    want = {}
    for p, _, u, source in units:
        for k, start, end, text in events:
            value = plain_score(source, text, [x for x in terms.get(p, []) if all(x)])
            if value >= 0.6:
                want.setdefault(u, []).append((-value, start or 0, end or 0, re.sub(r"\s+", " ", text).strip(), k))
    us = spark.createDataFrame(units, "part string, at int, unit_id string, source string").repartition(3)
    es = spark.createDataFrame(events, "event long, start double, end double, text string").repartition(2)
    ts = spark.createDataFrame([(p, *x) for p, own in terms.items() for x in own], "part string, english string, chinese string")
    pairs = stored.Stored(m.scored_pairs(us.select("part", "unit_id", "source"), es, ts, ["part"])).df
    assert sorted((r.unit_id, r.event, round(r.score, 9)) for r in pairs.collect()) == sorted((u, x[4], round(-x[0], 9)) for u, own in want.items() for x in own)
    best = m.candidates(pairs)
    top = {u: sorted(own)[:2] for u, own in want.items()}
    assert sorted((r.unit_id, r.rank, r.event) for r in best.collect()) == sorted((u, k + 1, x[4]) for u, own in top.items() for k, x in enumerate(own))
    monkeypatch.setattr(m, "BUDGET", 25)
    sent, stamps = [], []
    for p in ("p0", "p1", "p2"):
        spent, deferred = 0, []
        for _, at, u, _ in sorted(x for x in units if x[0] == p):
            own = top.get(u, [])
            sent.append((p, u, len(own)))
            spent += len(own)
            if own and own[0][4] != 202:  # that event has no times
                deferred.append((u, own[0][4], len(own) == 1 and -own[0][0] >= 0.7))
            if spent >= 25:
                break
        claims = [k for _, k, alone in deferred if alone]
        stamps += [(p, u, k, "high" if alone and claims.count(k) == 1 else "low") for u, k, alone in deferred]
    out = m.emitted(us, best, ["part"], ["at"])
    assert sorted((r.part, r.unit_id, r.n_candidates) for r in out.collect()) == sorted(sent)
    assert sorted((r.part, r.unit_id, r.event, r.confidence) for r in m.timestamps(out, best, ["part"]).collect()) == sorted(stamps)


def test_dialogue_units(spark):
    kinds = "CDDPDA CPADHDACD".replace(" ", "")
    names = {"C": "character", "D": "dialogue", "P": "parenthetical", "A": "action", "H": "scene_heading"}
    rows = [(1, k, f"e{k}", k // 4, names[x], "" if k == 4 else f"{x}{k} ") for k, x in enumerate(kinds)]
    got = m.dialogue_units(spark.createDataFrame(rows, "doc int, at int, id string, page int, kind string, text string"), ["doc"]).orderBy("unit").collect()
    assert [(r.speaker, r.entry_ids, r.pages, r.source) for r in got] == [
        ("C0", ["e1", "e2"], [0], "D1 D2"), ("C6", ["e7", "e8", "e9"], [1, 2], "P7 A8 D9"), (None, ["e11"], [2], "D11"), ("C13", ["e14"], [3], "D14"),
    ]


def test_empty_tables(spark):
    us, es, ts = (spark.createDataFrame([], s) for s in ("part string, unit_id string, source string", "event long, start double, end double, text string", "part string, english string, chinese string"))
    assert m.scored_pairs(us, es, ts, ["part"]).collect() == []
    assert phrases.phrase_hits(us, "unit_id", "source", ts, "english", True).collect() == []
    assert scans.within_budget(us.withColumn("at", F.lit(1)), ["part"], ["at"], F.lit(1), 3).collect() == []


@pytest.mark.parametrize("shard", [phrases.SHARD_BYTES, 40])
def test_least_values(spark, monkeypatch, shard):
    """However many terms a text holds, n leave its task, and they are its first."""
    monkeypatch.setattr(phrases, "SHARD_BYTES", shard)
    rnd = random.Random(4)
    words = [a + b for a in "abcdefgh" for b in "xyz"]
    terms = [(k, rnd.choice(words)) for k in range(300)]
    texts = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 30))).upper()) for i in range(60)] + [(60, None), (61, "")]
    rows, known = spark.createDataFrame(texts, "id long, body string").repartition(3), spark.createDataFrame(terms, "term long, word string")
    for n in (1, 7, 1000):
        out = phrases.least_values(rows, "id", "body", known, "word", "term", n).collect()
        assert all(0 < len(r["values"]) <= n for r in out) and (shard == 40 or len(out) == len({r.id for r in out}))
        got = {}
        for r in out:
            got[r.id] = sorted(got.get(r.id, []) + r["values"])[:n]
        assert got == {i: own[:n] for i, text in texts if (own := [k for k, w in terms if w in (text or "").lower()])}


def test_few_keys(spark):
    """A task gives the pairs of a key once, not once a text."""
    rows = spark.createDataFrame([("en", "the art of it")] * 500 + [("de", "die art")] * 500, "part string, body string").coalesce(1)
    known = spark.createDataFrame([("art",), ("the",), ("die",)], "p string")
    out = phrases.phrase_hits(rows, "part", "body", known, "p", False, few_keys=True).collect()
    assert sorted(tuple(r) for r in out) == [("de", "art"), ("de", "die"), ("en", "art"), ("en", "the")]


def test_few_keys_and_many_phrases(spark):
    """More pairs than 2^18 are given once by a task, too: they were forgotten from there on, and held as objects."""
    words = [f"w{k:06d}" for k in range(70_000)]
    rows = spark.createDataFrame([(p, " ".join(words)) for _ in range(2) for p in ("de", "en", "es", "fr")], "part string, body string").coalesce(1)
    known = spark.createDataFrame([(" ".join(words),)], "p string").select(F.explode(F.split("p", " ")).alias("p"))
    out = phrases.phrase_hits(rows, "part", "body", known, "p", False, few_keys=True).groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("phrase").alias("d"))
    assert sorted(tuple(r) for r in out.collect()) == [(p, 70_000, 70_000) for p in ("de", "en", "es", "fr")]


def test_letters_meet_only_events_as_long(spark):
    """A unit that is longer than an event makes no pair with it, whatever grams they share; one that stands in it does."""
    units = spark.createDataFrame([("long", "a" * 40), ("fits", "a" * 18), ("short", "a" * 15), ("within", "b" * 60)], "unit_id string, flat string")
    events = spark.createDataFrame([(1, "a" * 20), (2, "b" * 30 + "c" * 40), (3, "xy" + "a" * 16)], "event long, flat string")
    assert {tuple(r) for r in m._by_letters(units, events).collect()} == {("fits", 1), ("fits", 3), ("within", 2)}
    assert m._by_letters(units, events.limit(0)).count() == 0


def test_letters_of_a_long_text_are_read_once(spark):
    """Grams of a text take time in proportion to its length: this pair took the square of 60,000 steps, some 15 seconds."""
    text = "".join(chr(97 + (i * i // 7 + i // 3) % 26) for i in range(60000))
    units, events = spark.createDataFrame([("u", text)], "unit_id string, flat string"), spark.createDataFrame([(1, f"x{text}y")], "event long, flat string")
    started = time.monotonic()
    assert [tuple(r) for r in m._by_letters(units, events).collect()] == [("u", 1)]
    assert time.monotonic() - started < 8


def test_match_terms_fold_ascii_letters_only(spark):
    """Signs outside ASCII whose lower case is an ASCII letter end a word, as they do before folding."""
    texts = ["The Kelvin\u212aSign", "\u0130stanbul A'B ab -abc-D", "Don\u2019t DON'T rock rock", "", None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", t.match_terms(F.col("x")).alias("w"), t.has_match_key(F.col("x")).alias("k"), (t.match_key(F.col("x")) != "").alias("want"))
    rows = sorted(rows.collect())
    assert [r["w"] for r in rows] == [["kelvin", "sign"], ["stanbul", "a'b", "abc-d"], ["rock"], [], None]
    assert [r["k"] for r in rows] == [r["want"] for r in rows]
