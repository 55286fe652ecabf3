import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scriptorium.llm import bpe, bpe_codec, packing, token_counts

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def test_random_words_equal_the_library(library):
    rnd, vocabulary = random.Random(1), bpe.load(NAME)
    pieces = [t.replace("</w>", "") for t in vocabulary.token.values() if t.replace("</w>", "").isascii() and t.replace("</w>", "").isalpha()]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 300))) for _ in range(120)]
    texts += ["".join(rnd.choice("aeths'5!") for _ in range(rnd.randint(1, 2500))) for _ in range(40)]
    texts += ["a" * 5000, "ΑΣ ΣΟΦΟΣ", "I'll DON'T x²½", "a\x1cb <|endoftext|>c", "naïve café é", "a b　c"]
    for text in texts:
        assert list(bpe.encode(text, vocabulary)) == library.encode(text, add_special_tokens=False).ids


def test_any_code_points_equal_the_library(library):
    rnd, vocabulary = random.Random(5), bpe.load(NAME)
    texts = ["".join(chr(rnd.randint(0x20, 0x2FFF)) for _ in range(60)) for _ in range(300)]
    texts += ["".join(chr(rnd.choice([rnd.randint(0x20, 0xD7FF), rnd.randint(0xE000, 0x1FFFF), 0x301, 0x130])) for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert list(bpe.encode(text, vocabulary)) == library.encode(text, add_special_tokens=False).ids


def test_stream_holds_little_and_emits_early():
    vocabulary, seen = bpe.load(NAME), 0

    def pieces():
        nonlocal seen
        for _ in range(200):
            seen += 100
            yield b"thelanternofwinter" * 5 + b"abcdefghij"

    stream = vocabulary.stream(pieces())
    next(stream)
    assert seen < 3 * (vocabulary.lookahead + bpe.STRIDE)


def test_decoder_is_incremental():
    vocabulary = bpe.load(NAME)
    ids = list(bpe.encode("größe naïve 日本 end", vocabulary))
    machine = bpe.TextDecoder(vocabulary)
    assert "".join(machine.feed([i]) for i in ids) + machine.finish() == "größe naïve 日本 end "


def test_codec_digests(docs, none, rows, library):
    got = sorted(map(tuple, bpe_codec.codec_digests(docs).collect()), key=str)
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe_codec.codec_digests(none).count() == 0


def test_encode_and_decode_documents(docs, library):
    out = bpe_codec.decode_documents(bpe_codec.encode_documents(docs)).collect()
    assert all(r["decoded"] == library.decode(library.encode(r["text"] or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in out)


def test_cuts_are_the_best():
    rnd = random.Random(3)
    for _ in range(30):
        ends = np.unique(np.array([rnd.randint(1, 120) for _ in range(8)] + [120]))
        at, fee = packing.candidates(ends, np.array([5, 50]), 120)
        cuts, limit = packing.best_cuts(at, fee, 32 if np.diff(at, prepend=0).max() <= 32 else 64), 32 if np.diff(at, prepend=0).max() <= 32 else 64
        place, cost = [0, *at], [0.0]

        def pad(n):
            return 0 if n & (n - 1) == 0 else limit - n

        for i in range(1, len(place)):
            cost.append(min(cost[j] + pad(place[i] - place[j]) + fee[i - 1] for j in range(i) if place[i] - place[j] <= limit))
        fees = dict(zip(at.tolist(), fee))
        assert sum(pad(b - a) + fees[b] for a, b in zip([0, *cuts], cuts)) == pytest.approx(cost[-1])


def test_pieces_cover_every_id_once(docs, none, rows, library):
    import zlib

    pieces = packing.pack_documents(docs).collect()
    sequences = defaultdict(list)
    total = 0
    by_doc = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
        by_doc[p["doc_id"]].append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 2048
    wanted = defaultdict(list)
    for r in rows:
        wanted[r[0]].append(library.encode(r[1] or "", add_special_tokens=False).ids + [1])
        total += len(wanted[r[0]][-1])
    assert sum(p["length"] for p in pieces) == total
    for doc, texts in wanted.items():
        if len(texts) == 1:
            ids, at = np.array(texts[0], "<u4"), 0
            for p in sorted(by_doc[doc], key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(ids)
    assert packing.pack_documents(none).count() == 0


def test_little_padding(spark, sf_dir):
    from pyspark.sql import functions as F

    out = packing.pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    used = sum(r["n"] for r in out)
    held = sum(r["n"] if r["n"] & (r["n"] - 1) == 0 else 2048 for r in out)
    assert used / held > 0.97


def test_edits_equal_counting_again():
    rnd = random.Random(5)
    for trial in range(25):
        text = " ".join(rnd.choice(["harbor", "the", "don't", "x9y", "größe", "a" * 30, "wow!!"]) for _ in range(rnd.randint(0, 300)))
        tree = token_counts.CountTree(text, leaf_chars=40)
        for _ in range(12):
            a = rnd.randint(0, len(text) + 2)
            b = a + rnd.choice([0, 1, 5, 90, 400])
            new = rnd.choice(["", " ", "word", "two words ", "glue" * 20, " end. " * 30])
            lo = min(a, len(text))
            text = text[:lo] + new + text[max(lo, min(b, len(text))) :]
            assert tree.edit(a, b, new) == token_counts.count_tokens(text)
            assert tree.text == text


def test_edit_touches_few_leaves():
    tree = token_counts.CountTree("some plain words here " * 2000)
    before = tree.encoded
    tree.edit(20_000, 20_004, "other")
    assert tree.encoded - before <= 3 and before > 50


def test_count_with_edits(docs, none, rows, library):
    out = token_counts.count_with_edits(docs, token_counts.standing_edits()).collect()

    def edited(t):
        n = len(t)
        t = t[: n // 2] + " inserted words, here" + t[n // 2 :]
        q = n // 4
        t = t[:q] + t[q + 24 :]
        a = max(0, n - 10)
        return t[:a] + "edited end." + t[max(a, n + 24) :]

    def count(t):
        return len(library.encode(t, add_special_tokens=False).ids)

    want = sorted((str(r[0]), count(r[1] or ""), count(edited(r[1] or ""))) for r in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_tokens_edited"]) for r in out) == want
    assert token_counts.count_with_edits(none, token_counts.standing_edits()).count() == 0


def test_memo_keeps_counting_right_when_it_turns_over():
    """More pre-tokens than the memo holds, long texts included: the counts are those of the plain encoder."""
    vocabulary = bpe.load(NAME)
    memo = bpe.Memo(vocabulary, lambda ids, starts: [b - a for a, b in zip(starts, starts[1:])], most=8)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}ish" for i in range(60)] * 3 + ["x" * 100]
    memo.learn([words[:40]])
    memo.learn([words[30:60]])
    assert [memo[w] for w in words] == [len(vocabulary.word(w.encode())) for w in words]
    text = " ".join(words * 700)
    assert len(text) > token_counts.TOGETHER_CHARS
    tree = token_counts.CountTree(text, NAME)
    assert tree.tokens[1] == sum(1 for _ in bpe.encode(text, vocabulary))
    assert tree.edit(len(text) // 2, len(text) // 2 + 9, "a new one ") == sum(1 for _ in bpe.encode(tree.text, vocabulary))


def test_packing_encodes_a_part_once_for_all_texts(library, monkeypatch):
    """The words of texts that repeat are split and looked up once a batch, not wherever they stand; ids stay the library's."""
    looked = []

    class Counting(bpe.Memo):
        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(packing.bpe, "Memo", Counting)
    packing._tools.cache_clear()
    odd = [None, "", " \n", "a\x1cb\x85c", "<|endoftext|>ab cd", "ΑΣ Ⅷ ½ x²", "͸ don't", "é é"]
    texts = [f"It's the {w}, of all." for w in ("one", "two", "ñandú") * 400] + odd
    try:
        found = [ids.tolist() for ids in packing.document_ids(iter(texts))]
    finally:
        packing._tools.cache_clear()
    assert found == [[*library.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for t in texts]
    assert len(looked) < 100
