import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from studylake.llm import bpe
from studylake.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(file.read())


def expected(library, text):
    return library.encode(text, add_special_tokens=False).ids


def unpacked(ids):
    return np.frombuffer(ids, "<u4").tolist()


def test_all_rows_of_the_table_match_the_library(spark, small, table, library):
    rows = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, small).collect()}
    for doc in table("documents"):
        ids = expected(library, doc["text"] or "")
        found = rows[doc["doc_id"]]
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert found["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark, documents, odd_rows, library):
    df = bpe.decode(bpe.encode(documents(odd_rows), PATH), PATH)
    rows = df.collect()
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "ids", "decoded"]
    assert len(rows) == len(odd_rows)
    for row in rows:
        ids = expected(library, row["text"] or "")
        assert unpacked(row["ids"]) == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_round_trip_equals_both_directions(spark, documents, odd_rows):
    df = documents(odd_rows)
    one = bpe.round_trip(df, PATH)
    assert one.columns == ["doc_id", "lang", "source", "n_chars", "key", "ids", "decoded"]
    two = bpe.decode(bpe.encode(df, PATH), PATH).drop("text").select(one.columns)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_full_memories_change_nothing(library, encoder, monkeypatch):
    """Words and pieces are asked for again after both generations have gone."""
    monkeypatch.setattr(encoder._words, "limit", 3)
    monkeypatch.setattr(encoder._pieces, "limit", 2)
    monkeypatch.setattr(encoder._fits, "limit", 5)
    texts = ["one two three", "", "four, five; one", "two " + "x" * 200 + " six <|endoftext|>seven", "one two"] * 3
    for start in range(0, len(texts), 2):
        found = encoder.encode_all(texts[start:start + 2])
        assert [unpacked(i) for i in found] == [expected(library, t) for t in texts[start:start + 2]]
    assert len(encoder._words.now) + len(encoder._words.old) < 30


def test_empty_table(spark, documents):
    assert bpe.decode(bpe.encode(documents([]), PATH), PATH).count() == 0


@given(st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_any_text(library, encoder, text):
    assert unpacked(encoder.encode(text)) == expected(library, text)


@given(st.text(alphabet="abeinrst'!", max_size=30))
@settings(max_examples=400, deadline=None)
def test_frequent_letters(library, encoder, text):
    ids = unpacked(encoder.encode(text))
    assert ids == expected(library, text)
    assert encoder.decode(encoder.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_every_token_string(library, encoder):
    words = [t.replace("</w>", "") for t in library.get_vocab()]
    assert all(unpacked(encoder.encode(w)) == expected(library, w) for w in words)
