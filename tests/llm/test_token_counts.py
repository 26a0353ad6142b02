import public_tokenizers
import pytest

from studylake.llm import token_counts
from studylake.llm.queries import QUERIES


def greedy(word: bytes, pieces: set[bytes], longest: int) -> int:
    word, n = b" " + word, 0
    while word:
        size = next(k for k in range(min(longest, len(word)), 0, -1) if word[:k] in pieces)
        word, n = word[size:], n + 1
    return n


@pytest.fixture(scope="module")
def pieces():
    return set(token_counts.byte_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


def test_query_equals_greedy_matching(spark, small, table, pieces):
    longest = max(map(len, pieces))
    rows = {r["doc_id"]: r for r in QUERIES["op1_token_counts"](spark, small).collect()}
    for doc in table("documents"):
        words = (doc["text"] or "").encode().split()
        assert rows[doc["doc_id"]]["n_words"] == len(words)
        assert rows[doc["doc_id"]]["n_tokens"] == sum(greedy(w, pieces, longest) for w in words)


def test_failure_links():
    singles = [bytes([b]) for b in range(256)]
    pieces = {*singles, b"ab", b"abcd", b"bc", b"cdx", b"aaa", b" a", b" abcda"}
    automaton = token_counts.Automaton(pieces)
    import itertools
    for n in range(1, 8):
        for letters in itertools.product(b"abcdx", repeat=n):
            word = bytes(letters)
            assert automaton.count(word) == greedy(word, pieces, 6), word


def test_missing_single_bytes_are_refused():
    with pytest.raises(ValueError):
        token_counts.Automaton([b"ab"])


def test_odd_rows(spark, documents, odd_rows, pieces):
    longest = max(map(len, pieces))
    for row in token_counts.count_tokens(documents(odd_rows), pieces).collect():
        words = (row["text"] or "").encode().split()
        assert (row["n_words"], row["n_tokens"]) == (
            len(words), sum(greedy(w, pieces, longest) for w in words))
    assert token_counts.count_tokens(documents([]), pieces).count() == 0
