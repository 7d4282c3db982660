import random

import pytest
from helpers import AWKWARD, documents, empty
from tokenizers import Tokenizer

from rollbook.llm import queries, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.vocabulary_path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def used():
    return token_counts.counter(token_counts.vocabulary_path(token_counts.VOCABULARY)), token_counts.vocabulary(
        token_counts.vocabulary_path(token_counts.VOCABULARY))


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def counted(used, text):
    counter, words = used
    found, special = words.pre_tokens(text)
    return special + sum(n * counter.count(p) for p, n in found.items())


def test_random_texts_equal_the_library(library, used):
    dice = random.Random(1)
    letters = "abcdefghinrst'THE ABΣσςİıẞß日本語0123456789١²½é éñ\t\n\x1c\x1f\x85 ​﻿😀!!..\x00<|endoftext|>  𝅘𝟘𖿀𱍐"
    words = ["<|endoftext|>", " the", "'ll", "'S", "aaa", "aaaaaaaaaaa", "ſ", "  ", " \n", "ՠ", "ꟍ"]
    for _ in range(4000):
        text = "".join(dice.choice(letters) if dice.random() < .8 else dice.choice(words) for _ in range(dice.randint(0, 30)))
        assert counted(used, text) == expected(library, text), text


def test_classes_of_signs_equal_the_library(library, used):
    signs = [chr(i) for i in range(0, 0x110000, 7) if not 0xD800 <= i < 0xE000]
    for start in range(0, len(signs), 500):
        for form in ("a{}a", " {}", "1{} x"):
            text = "\n".join(form.format(s) for s in signs[start:start + 500])
            assert used[1].cut(text) == [text[s:e] for _, (s, e) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_long_unbroken_texts(library, used):
    for text in ("ab" * 20_000, " " * 30_000, "é" * 20_000, "!" * 20_000, "1" * 20_000):
        assert counted(used, text) == expected(library, text)


@pytest.mark.parametrize("block_bytes", [token_counts.BLOCK_BYTES, 30])
def test_rows(spark, library, block_bytes):
    """A row for each row, whatever the blocks; null and empty texts, repeated rows, rows without an id."""
    rows = AWKWARD + [(None, "no id"), (11, "a<|endoftext|>b <|endoftext|>")]
    got = token_counts.count_tokens(documents(spark, rows), block_bytes=block_bytes).collect()
    wanted = [(i, len((t or "").encode()), expected(library, t)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_empty_table_and_texts(spark):
    assert token_counts.count_tokens(empty(spark)).count() == 0
    got = token_counts.count_tokens(documents(spark, [(1, None), (2, "")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0), (2, 0, 0)]


def test_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op12_token_counts"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = expected(library, texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)
