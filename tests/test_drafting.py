"""Draft entries against a walk over lines and markers."""

import random

import pytest

from scriptorium.operators import drafting
from scriptorium.operators.drafting import draft_entries

LINES = "doc int, page int, at int, kind string, text string, y double, zone string"
MARKERS = "doc int, page int, marker_no int, type string, text string, scene_key string, x double, y double"


def walk(lines, markers):
    out = []
    for doc in {r[0] for r in lines} | {m[0] for m in markers}:
        own = sorted((r for r in lines if r[0] == doc and r[6] != "page_number"), key=lambda r: r[2])
        mine = sorted((m for m in markers if m[0] == doc), key=lambda m: m[2])
        high = lambda ms: tuple((m[3], m[4]) for m in sorted(ms, key=lambda m: (-m[7], m[6], m[2])))
        used = set()
        for k, (_, page, _, kind, text, y, _) in enumerate(own):
            met = [m for m in mine if m[1] == page and abs(m[7] - y) <= 3]
            used |= {m[2] for m in met}
            out.append((doc, page, f"p{page:03d}-e{k + 1:03d}", kind, text, drafting.PLACEHOLDERS.get(kind, drafting.OTHER) + "：" + text, high(met) or None))
        groups = {}
        for m in mine:
            if m[2] not in used:
                key = (m[1], m[3], m[5] or m[4], round(m[7] / 3) * 3) if m[3] in drafting.SCENE_TYPES else ("#", m[2])
                groups.setdefault(key, []).append(m)
        for k, g in enumerate(sorted(groups.values(), key=lambda g: (g[0][1], -g[0][7], g[0][6], g[0][2]))):
            kind = "scene_heading" if g[0][3] in drafting.SCENE_TYPES else "format_marker"
            texts = " / ".join(x[1] for x in high(g))
            out.append((doc, g[0][1], f"p{g[0][1]:03d}-m{len(own) + 1 + k:03d}", kind, "STRUCTURE MARKER: " + texts, drafting.PLACEHOLDERS[kind] + "：" + texts, high(g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc, r.page, r.id, r.kind, r.source, r.translation, tuple(tuple(m) for m in r.markers) if r.markers is not None else None) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_walk(spark, seed):
    rnd = random.Random(seed)
    kinds = [*drafting.PLACEHOLDERS, "other"]
    lines = [(d, k // 6 + 1, k, rnd.choice(kinds), f"t{k}", 700 - k % 6 * rnd.choice([5, 12]) + 0.5, rnd.choice(["body", "margin", "page_number", None])) for d in (1, 2) for k in range(30)]
    markers = [(d, rnd.randint(1, 6), k, rnd.choice(["scene_no", "split_scene", "contd", "omitted"]), rnd.choice("ABC"), rnd.choice([None, "K"]), rnd.choice([36.0, 560.0]), 700 - rnd.randint(0, 40) * 1.0) for d in (1, 2, 3) for k in range(60)]
    df, ms = spark.createDataFrame(lines, LINES).repartition(3), spark.createDataFrame(markers, MARKERS).repartition(3)
    assert got(draft_entries(df, ms, ["doc"])) == walk(lines, markers)


def test_empty(spark):
    lines, markers = spark.createDataFrame([], LINES), spark.createDataFrame([], MARKERS)
    assert draft_entries(lines, markers, ["doc"]).collect() == []
    one = spark.createDataFrame([(1, 1, 0, "action", "x", 1.0, None)], LINES)
    assert got(draft_entries(one, markers, ["doc"])) == walk([(1, 1, 0, "action", "x", 1.0, None)], [])
