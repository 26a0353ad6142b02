import random

import pytest
from pyspark.sql import functions as F

from studylake.llm import line_dedup


def n_words(text):
    return len(text.encode().split())


def brute(rows, cut=None):
    """{key: (removed, text)} from the chunks that ``cut`` gives; distinct non-NULL keys."""
    cut = cut or python_chunks
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        chunks = cut(text) if text is not None else []
        kept = []
        for c in chunks:
            use = ("\n" in c and n_words(c)) or n_words(c) >= line_dedup.LONG_LINE
            if not (use and c in seen):
                kept.append(c)
            if use:
                seen.add(c)
        out[key] = len(chunks) - len(kept), "\n".join(kept)
    return out


_M = (1 << 64) - 1
_P = [0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
      0x27D4EB2F165667C5]


def _rotl(x, r):
    return (x << r | x >> (64 - r)) & _M


def _long_hash(value, seed):
    """XXH64 of one 8-byte value."""
    h = (seed + _P[4] + 8) & _M
    h ^= _rotl((value & _M) * _P[1] & _M, 31) * _P[0] & _M
    h = (_rotl(h, 27) * _P[0] + _P[3]) & _M
    h ^= h >> 33
    h = h * _P[1] & _M
    h ^= h >> 29
    h = h * _P[2] & _M
    return h ^ h >> 32


def python_chunks(text):
    """Chunk texts by the documented rule, line by line."""
    import xxhash

    lines = text.split("\n")
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    long = [n_words(x) >= line_dedup.LONG_LINE for x in lines]
    chunks, start = [], 0
    for i in range(len(lines)):
        rolled = _long_hash(hashes[i], 42)
        if i:
            rolled = _long_hash(hashes[i - 1], rolled)
        signed = rolled - (1 << 64) if rolled >> 63 else rolled
        if i + 1 == len(lines) or long[i] or long[i + 1] or signed % line_dedup.DIVISOR == 0:
            chunks.append("\n".join(lines[start:i + 1]))
            start = i + 1
    return chunks


def test_chunks_join_to_the_text(spark, documents, odd_rows):
    df = line_dedup.with_chunks(documents(odd_rows))
    for r in df.collect():
        assert "\n".join(r["chunks"]) == (r["text"] or "")
        assert r["chunks"] == python_chunks(r["text"] or "")


@pytest.fixture
def passages():
    draw = random.Random(4)
    line = lambda: " ".join(f"w{draw.randrange(5000)}" for _ in range(draw.randrange(3, 12)))
    shared = [line() for _ in range(14)]
    rows = [(i, "\n".join([line() for _ in range(draw.randrange(0, 6))] + shared
                          + [line() for _ in range(3)])) for i in range(40)]
    long = " ".join(f"p{i}" for i in range(60))
    rows += [(100 + i, f"{line()}\n{long}\n{line()}") for i in range(5)]
    rows += [(200 + i, "a short line\n" + line()) for i in range(5)]
    return rows


def test_shared_passages_stay_once(spark, documents, passages):
    found = line_dedup.remove_repeated_chunks(documents(passages))
    assert found.columns[:7] == documents(passages).columns
    rows = {r["doc_id"]: r for r in found.collect()}
    assert {k: (r["n_removed"], r["text"]) for k, r in rows.items()} == brute(passages)
    long = passages[40][1].split("\n")[1]
    assert [k for k, r in rows.items() if long in r["text"]] == [100]
    # shift-resistant: whatever stands before it, most of a passage goes
    assert sum(rows[i]["n_removed"] for i in range(1, 40)) >= 39 * 2
    # short common lines are no passages
    assert all(rows[200 + i]["n_removed"] == 0 for i in range(5))


def test_odd_rows(spark, documents, odd_rows):
    rows = line_dedup.remove_repeated_chunks(documents(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(repr(r["text"]) for r in rows) == sorted(repr(t) for _, t in odd_rows)
    assert {r["n_chunks"] for r in rows if r["text"] is None} == {0}
    assert line_dedup.remove_repeated_chunks(documents([])).count() == 0


def test_repeats_within_one_text_and_equal_rows(spark, documents):
    block = "first line here\nsecond line here\nthird line here\nfourth line here"
    text = "\n".join([block] * 6)
    rows = line_dedup.remove_repeated_chunks(documents([(1, text), (1, text), (None, text)])).collect()
    alone = brute([(1, text)])[1]
    by_key = {r["doc_id"]: r["text"] for r in rows}
    assert by_key[None] == alone[1]  # NULL keys come first
    assert n_words(by_key[1]) < n_words(text)


def test_unequal_chunks_of_one_hash_stay(spark, documents, monkeypatch):
    """With a hash that is always the same, only the byte comparison decides."""
    rows = [(i, f"line {i % 3}\nand more {i % 3}\nand an end") for i in range(9)]
    real = F.xxhash64
    monkeypatch.setattr(line_dedup, "_chunk_hash", lambda c: F.lit(7).cast("long"))
    found = line_dedup.remove_repeated_chunks(documents(rows)).collect()
    assert F.xxhash64 is real
    kept = [r for r in found if r["text"]]
    assert {r["text"] for r in kept} >= {rows[1][1], rows[2][1]}
