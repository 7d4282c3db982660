import random
import tracemalloc

import pytest
from helpers import AWKWARD, documents, empty
from tokenizers import Tokenizer

from rollbook.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.vocabulary_path())


def same(library, codec, text):
    ids, decoded = codec.encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids == expected, text
    assert decoded == library.decode(expected, skip_special_tokens=False)


def test_random_texts_equal_the_library(library, codec):
    dice = random.Random(1)
    letters = "abcdefghinrst'THE ABΣσςİıẞß日本語0123456789١²½é éñ\t\n\x1c\x1f\x85 ​﻿😀!!..<|endoftext|></w>"
    words = ["<|endoftext|>", "<|startoftext|>", "the", "'ll", "'S", "</w>", "aaa", "aaaaaaaaaaa", "ΑΣ", "ſ", "K", "é"]
    for _ in range(5000):
        same(library, codec, "".join(dice.choice(letters) if dice.random() < .8 else dice.choice(words) for _ in range(dice.randint(0, 30))))


def test_every_token_alone(library, codec):
    for token in list(codec.encoder.text.values())[::37]:
        same(library, codec, token.removesuffix("</w>"))


def test_caches_that_overflow_change_nothing(library, codec, monkeypatch):
    small = bpe.Codec(bpe.vocabulary_path())
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 5)
    cache = bpe.RunCache(small, 1000)
    texts = ["the quick brown fox jumps over the lazy dog the quick fox", "tokenization internationalization tokenization", "", "the\x1c<|endoftext|>\x1cfox"] * 3
    for text in texts:
        same(library, small, text)
        ids, decoded = cache.encode([text, text])
        assert ids.to_pylist() == [small.encode(text)[0]] * 2 and decoded.to_pylist() == [small.encode(text)[1]] * 2


def test_long_unbroken_runs_are_bounded(library, codec):
    """Base64 and texts without blanks: a run as long as its text, which no cache keeps beyond its bytes."""
    dice = random.Random(4)
    texts = ["".join(dice.choice("ABCDabcd0123+/") for _ in range(20_000)) for _ in range(6)] + ["日本語" * 5000, "a" * 20_000]
    cache = bpe.RunCache(codec, 400_000)
    for text in texts:
        ids, decoded = cache.encode([text])
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.to_pylist() == [expected] and decoded.to_pylist() == [library.decode(expected, skip_special_tokens=False)]
        assert cache.size < 400_000 + 16 * len(text.encode()) + bpe.RUN_BYTES


def test_rows(spark, library):
    got = bpe.encode(documents(spark)).collect()
    assert len(got) == len(AWKWARD)
    expected = sorted((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in AWKWARD)
    assert sorted((r["doc_id"], r["token_ids"]) for r in got) == expected
    assert bpe.encode(empty(spark)).count() == 0


def test_query_equals_the_library(spark, library):
    import hashlib
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op6_bpe_codec"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_a_batch_does_not_copy_the_cache(codec):
    cache = bpe.RunCache(codec)
    cache.encode([" ".join(f"word{i}" for i in range(20_000))])
    tracemalloc.start()
    cache.encode(["the word1 fox"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(cache.number)
    ids, decoded = cache.encode(["a new run after the views ended"])
    assert (ids.to_pylist()[0], decoded.to_pylist()[0]) == codec.encode("a new run after the views ended")
