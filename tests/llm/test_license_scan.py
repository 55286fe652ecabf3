import random

from scriptorium.llm import license_scan as ls


def test_plain_edited_and_absent():
    index = ls.Index(ls.TEMPLATES)
    text = "Some words before. Licensed under the Apache License, Version 2.0. And after."
    (name, coverage, matched, start, stop), = ls.scan_text(text, index)
    assert name == "apache-2.0-line" and coverage == 1 and text[start:stop] == "Licensed under the Apache License, Version 2.0"
    words = ls.TEMPLATES["mit"].split()
    for k in (9, 17, 30):
        words[k] = "changed"
    words.insert(12, "extra")
    (name, coverage, *_), = ls.scan_text("x " * 500 + " ".join(words) + " y" * 500, index)
    assert name == "mit" and 0.9 < coverage < 1
    assert ls.scan_text("the licensed harbor under a version of the work", index) == []


def test_every_planted_notice_is_found():
    rnd, index = random.Random(3), ls.Index(ls.TEMPLATES)
    for name, notice in ls.TEMPLATES.items():
        noise = " ".join(rnd.choice(["the", "of", "version", "license", "lamp", "under"]) for _ in range(400))
        at = rnd.randint(0, 300)
        text = noise[:at] + "\n" + notice.upper() + "\n" + noise[at:]
        found = ls.scan_text(text, index)
        assert [(f[0], f[1]) for f in found] == [(name, 1.0)]


def test_one_changed_word_of_every_notice():
    index = ls.Index(ls.TEMPLATES)
    for name, notice in ls.TEMPLATES.items():
        words = ls.words_of(notice)[0]
        for k in range(len(words)):
            for edited in (words[:k] + ["changed"] + words[k + 1 :], words[:k] + words[k + 1 :]):
                (got, coverage, *_), = ls.scan_text("lamp " * 20 + " ".join(edited) + " lamp" * 20, index)
                assert got == name and coverage >= 0.7


def test_back_to_back_notices():
    index = ls.Index(ls.TEMPLATES)
    for name, notice in ls.TEMPLATES.items():
        for copies in (2, 3, 5):
            for glue in ("\n", " lamp "):
                text = "lamp " * 9 + glue.join([notice] * copies) + " lamp" * 9
                found = ls.scan_text(text, index)
                assert [f[:2] for f in found] == [(name, 1.0)] * copies
                assert all(a[4] <= b[3] for a, b in zip(found, found[1:]))
    short = ls.Index({"short": "all rights reserved here"})
    assert len(ls.scan_text("all rights reserved here " * 6, short)) == 6


def test_winnowing_keeps_one_gram_of_every_window():
    rnd = random.Random(4)
    words = [rnd.choice("abcdef") for _ in range(200)]
    at = sorted(i for _, i in ls.winnow(words))
    assert max(b - a for a, b in zip(at, at[1:])) <= ls.WINDOW


def test_alignment_equals_full_matrix():
    rnd = random.Random(5)
    for _ in range(40):
        template = [rnd.choice("abcdefgh") for _ in range(12)]
        words = [rnd.choice("abcdefgh") for _ in range(5)] + [w for w in template if rnd.random() < 0.85] + ["q"] * 4
        table = [[0] * (len(words) + 1) for _ in range(len(template) + 1)]
        for i, t in enumerate(template):
            for j, w in enumerate(words):
                table[i + 1][j + 1] = max(0, table[i][j] + (2 if t == w else -1), table[i][j + 1] - 1, table[i + 1][j] - 1)
        assert ls.align(template, words, 0, band=30)[0] == max(map(max, table))


def test_rows(docs, none, spark):
    assert ls.scan_licenses(docs).count() == 0
    assert ls.scan_licenses(none).count() == 0
    both = spark.createDataFrame([(None, ls.TEMPLATES["bsd"] + " " + ls.TEMPLATES["isc"]), (1, None)], "doc_id long, text string")
    assert [r["license"] for r in ls.scan_licenses(both).collect()] == ["bsd", "isc"]
    assert ls.scan_licenses(both, {}).count() == 0


def scan_by_full_alignment(text, templates, least=ls.LEAST_COVERAGE):
    """Whether each template is there: the best local alignment over the whole text, no index, no band."""
    words = ls.words_of(text)[0]
    found = set()
    for name, notice in templates.items():
        own = ls.words_of(notice)[0]
        if ls.align(own, words, 0, band=len(words)).matched / len(own) >= least:
            found.add(name)
    return found


def test_recall_of_edited_notices():
    """Random changes, losses and insertions of single words: all that full alignment finds, down to the least coverage."""
    rnd, index = random.Random(9), ls.Index(ls.TEMPLATES)
    there = found = 0
    for name, notice in ls.TEMPLATES.items():
        words = ls.words_of(notice)[0]
        if len(words) > 80:
            continue
        for _ in range(12):
            edited = []
            for w in words:
                x = rnd.random()
                edited += [w] if x > 0.24 else ["changed"] if x > 0.12 else [] if x > 0.06 else [w, "extra"]
            text = "lamp " * 15 + " ".join(edited) + " lamp" * 15
            if name in scan_by_full_alignment(text, {name: notice}):
                there += 1
                found += name in {r[0] for r in ls.scan_text(text, index, ls.LEAST_COVERAGE)} or len(ls.scan_text(text, index)) > 0
    assert there > 60 and found / there >= 0.97, (found, there)


def test_words_put_in_at_one_or_two_places():
    index = ls.Index(ls.TEMPLATES)
    for name, notice in ls.TEMPLATES.items():
        words = ls.words_of(notice)[0]
        if len(words) < 20:
            continue
        for n in (1, 9, 12, 40, 100):
            for cuts in ((len(words) // 2,), (len(words) // 3, 2 * len(words) // 3)):
                edited, last = [], 0
                for c in cuts:
                    edited += words[last:c] + [f"holder{k}" for k in range(n)]
                    last = c
                edited += words[last:]
                got = ls.scan_text("lamp " * 30 + " ".join(edited) + " lamp" * 30, index)
                assert (name, 1.0) in [r[:2] for r in got], (name, n, cuts, got)


def test_chains_add_up_and_never_too_much():
    a, b, c = ls.Piece(20, 10, 0, 10, 0, 10), ls.Piece(20, 10, 30, 40, 10, 20), ls.Piece(16, 8, 38, 46, 18, 26)
    best = max(ls.chains([a, b, c, a]))
    assert best[0] == 26 and best[1] == [a, b, c]
    far = ls.Piece(20, 10, 500, 510, 10, 20)
    assert max(m for m, _ in ls.chains([a, far])) == 10
    assert max(m for m, _ in ls.chains([b, ls.Piece(20, 10, 60, 70, 0, 10)])) == 10  # the wrong way round
