"""Batches that arrive one by one, a gate that stops, and what is there after each restart."""

import json
import os
import time

import pytest

from scriptorium.sources import batches as b
from scriptorium.streaming import arriving as a


def batch(path, start, end, n=11, translation="译文", at=None):
    entries = [{"id": f"p{start:03d}-e{k:03d}", "type": "action" if k % 3 else "dialogue", "pdf_page": start, "display_page": start, "source": "s", "translation": translation} for k in range(n)]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"version": 1, "batch_id": path.stem, "source_pages": {"start": start, "end": end}, "has_subtitles": False, "entries": entries}, ensure_ascii=False))
    os.utime(path, (at, at))  # the order of arrival


@pytest.fixture
def folders(tmp_path):
    return {k: f"file://{tmp_path}/{k}" for k in ("accepted", "findings", "gate", "tails", "state")}


def run(spark, tmp_path, folders):
    query = a.gate(a.arriving(spark, f"file://{tmp_path}/in/*"), folders["accepted"], folders["findings"], folders["gate"])
    query.awaitTermination()
    query = a.tails(spark, folders["accepted"], folders["tails"], folders["state"])
    query.awaitTermination()


def test_stops_resumes_and_equals_the_batch_query(spark, tmp_path, folders):
    now = time.time() - 1000
    one, two = tmp_path / "in" / "one", tmp_path / "in" / "two"
    batch(one / "translated-p001-005.json", 1, 5, at=now)
    batch(two / "translated-p001-004.json", 1, 4, 3, at=now + 1)
    run(spark, tmp_path, folders)
    assert spark.read.schema(a.TAILS).parquet(folders["tails"]).count() == 2
    batch(one / "translated-p006-010.json", 6, 10, translation=" ", at=now + 2)
    batch(one / "translated-p011-013.json", 11, 13, at=now + 3)
    with pytest.raises(Exception, match="batch.translation"):
        run(spark, tmp_path, folders)
    accepted = lambda: spark.read.schema(a.ACCEPTED).option("recursiveFileLookup", True).parquet(folders["accepted"])
    assert accepted().count() == 2  # the failing batch and what is behind it do not count
    with pytest.raises(Exception, match="batch.translation"):
        run(spark, tmp_path, folders)  # still the same batch
    batch(one / "translated-p006-010.json", 6, 10, at=now + 2)
    run(spark, tmp_path, folders)
    batch(two / "translated-p005-009.json", 5, 9, 9, at=now + 4)
    run(spark, tmp_path, folders)
    run(spark, tmp_path, folders)  # nothing new
    got = sorted(tuple(r) for r in spark.read.schema(a.TAILS).parquet(folders["tails"]).collect())
    texts = spark.createDataFrame([(f"{p.parent}/{p.name}", p.read_text()) for p in sorted((tmp_path / "in").glob("*/*.json"))], "path string, text string")
    want = sorted(tuple(r) for r in a.tails_at_once(a.summaries(b.parse_batches(texts))).collect())
    key = lambda rows: sorted(rows, key=str)
    assert key(got) == key(want) and len(got) == 5
    assert dict((r[1], r[2]) for r in got if r[0] == "one") == {"translated-p001-005": None, "translated-p006-010": "translated-p001-005", "translated-p011-013": "translated-p006-010"}
    assert [r[3].count(",") + 1 for r in got if r[1] == "translated-p006-010"] == [8]
    assert accepted().groupBy("batch_id").count().filter("count > 1").count() == 0
