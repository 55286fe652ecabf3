import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, owner string, fp double, body string"


def documents() -> list[tuple]:
    """Odd rows beside plain ones: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""
    rnd = random.Random(7)
    words = ["the", "of", "harbor", "lantern", "Winter", "é́cole", "señor", "straße", "quiet", "x9", "stone,", "river.", "Über", "and"]
    prose = [" ".join(rnd.choice(words) + str(rnd.randint(0, 40)) * (rnd.random() < 0.5) for _ in range(rnd.randint(1, 160))) for _ in range(60)]
    passage = " ".join(f"shared{k} passage" for k in range(14))
    texts = prose + prose[:9] + [prose[3] + " tail", prose[4].replace("the", "a", 1), prose[5] + "\n"]
    texts += [None, "", None, "", " \t\n", "...", "word", "two words", "a" * 5000, "ab " * 4000, "<|endoftext|> x <|startoftext|>", "日本語 テキスト ΑΣ"]
    texts += [passage + " " + p for p in prose[10:14]] + [p + " " + passage + " " + passage for p in prose[20:23]] + [" ".join(prose) * 3]
    rows = [(3 * i + 1, t, "en" if i % 3 else None, "s", i, "h", "o", 1.0, "b") for i, t in enumerate(texts)]
    rows += rows[5:7] + [(None, prose[0], "de", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
