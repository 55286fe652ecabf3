import ast
import importlib

import pytest

import corpus_pipeline
from scriptorium.llm import queries


def test_stages_on_odd_rows(spark, docs, rows, none):
    now = docs
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.Written(stage(spark, now, None), name).df
        assert now.columns == docs.columns
        texts[name] = [r["text"] for r in now.collect()]
        assert len(texts[name]) <= before.count()
    letters = [r[1] for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(texts["language_id"]) == sorted(letters)
    assert sorted(texts["exact_dedup"]) == sorted(set(letters))
    assert len(texts["suffix_dedup"]) == len(texts["simhash"]) > 40
    assert sum(map(len, texts["suffix_dedup"])) < sum(map(len, texts["simhash"]))
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, None)
    assert pieces.count() >= now.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, None).count() == 0


def test_rows_without_an_id_of_their_own(spark):
    """Null ids, one id on several texts, and the id that once stood for null: only copies go."""
    texts = ["".join(chr(97 + (7 * i + k * k) % 26) + " " * (k % 4 == 3) for k in range(160)) for i in range(8)]
    least = -(1 << 63)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    made = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema).repartition(3)
    left = lambda stage, rows: sorted(((r["doc_id"], r["text"]) for r in stage(spark, made(rows), None).collect()), key=str)
    a, b, c, d, e, f, *_ = texts
    rows = [(None, a), (None, b), (None, b), (None, c), (5, c), (7, a), (7, d), (9, a), (None, e), (least, e), (least, f), (None, f + " x")]
    want = [(None, b), (5, c), (7, d), (9, a), (least, e), (least, f), (None, f + " x")]
    assert left(corpus_pipeline.drop_exact_copies, rows) == sorted(want, key=str)
    near = lambda t: t.upper()  # the same words, so the same fingerprint
    rows = [(None, a), (None, near(a)), (None, b), (4, near(b)), (None, c), (7, d), (7, near(d)), (7, e), (3, near(e)), (7, f), (7, f)]
    got = left(corpus_pipeline.drop_near_copies, rows)
    assert sorted(t.lower() for _, t in got) == sorted([a, b, c, d, e, f])
    assert {(4, near(b)), (None, c), (3, near(e)), (7, f)} < set(got)


OWN_NAMES = ["__null", "__lang_pred", "__lang_score", "row", "key", "sha", "bucket", "block", "pred", "score", "others", "none", "root", "fp", "n", "kept", "a b`c"]


def test_int_ids_and_columns_named_like_the_operators_own(spark, rows):
    made = spark.createDataFrame([(i, t, lang, s, n, *range(len(OWN_NAMES))) for i, t, lang, s, n, *_ in rows], "doc_id int, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c.replace('`', '``')}` int" for c in OWN_NAMES[:-1]) + ", last int")
    now = made = made.withColumnRenamed("last", OWN_NAMES[-1].replace("`", "")).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.Written(stage(spark, now, None), name).df
        assert now.dtypes == made.dtypes
        assert now.select(OWN_NAMES[0], OWN_NAMES[5]).distinct().collect() == [(0, 5)]
    assert corpus_pipeline.STAGES[-1][1](spark, now, None).count() >= now.count() > 40


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100


def test_registered_names():
    assert [int(n[2:].split("_")[0]) for n in list(queries.QUERIES)[:-1]] == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_gives_the_same(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = list(want.columns)
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, want[key].values.tolist()))


def test_nothing_else_imports_the_subpackage():
    import pathlib

    top = pathlib.Path(corpus_pipeline.__file__).parent / "scriptorium"
    for path in top.rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n for n in names)
    assert importlib.import_module("__spark_entry__").queries()["op9_exact_dedup"]
