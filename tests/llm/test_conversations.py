import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from studylake.llm import conversations
from studylake.llm.queries import QUERIES

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
KIND = "conv_id long, turn long, role string, text string, part int, codes string"
LEGAL = re.compile("(s?(ua)+)?")


def damaged(rows):
    """(conv_id, turn, role, text) after damage, and every conversation."""
    kept = defaultdict(list)
    for r in rows:
        kept[r["conv_id"]]
        fields = [" " if r[c] is None else str(r[c]) for c in ("conv_id", "turn", "role", "text")]
        role, text = fields[2:]
        fault = zlib.crc32(":".join(fields[:2]).encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept[r["conv_id"]] += [(r["turn"], "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return kept


def classify(rows):
    """Rows in order and the fault of each."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults = []
    for k, (_, role, text) in enumerate(rows):
        body = text.strip(" \t\n\x0b\x0c\r")
        if not body:
            faults.append("blank")
        elif (role, text) in [r[1:] for r in rows[:k]]:
            faults.append("duplicate")
        else:
            faults.append("" if body[-1] in ".!?" else "truncated")
    return rows, faults


def cheapest(initials, faults):
    """(cost, letters) by the definition: all cheapest edits per (rows done, state), as strings."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(row, state, inserts):
        found = []
        if row == len(initials):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            cost, rest = best(row + 1, state, 2)
            found.append((4 + cost, "D" + rest))
            if faults[row] not in ("blank", "duplicate"):
                extra = 3 * (faults[row] == "truncated")
                if (state, initials[row]) in step:
                    cost, rest = best(row + 1, step[state, initials[row]], 2)
                    found.append((cost + extra, "K" + rest))
                for role in "ua":
                    if (state, role) in step:
                        cost, rest = best(row + 1, step[state, role], 2)
                        found.append((cost + extra + 3, "R" + rest))
        if inserts:
            for role in "ua":
                if (state, role) in step:
                    cost, rest = best(row, step[state, role], inserts - 1)
                    found.append((cost + 3, "I" + rest))
        return min(found, default=(10 ** 9, ""))

    return best(0, "", 2)


def replay(audit, rows):
    out, row = [], 0
    give = lambda: "assistant" if out and out[-1].startswith("u") else "user"
    for letter in audit:
        if letter == "I":
            out.append(f"{give()}:")
            continue
        if letter == "K":
            out.append(f"{rows[row][1]}:{rows[row][2]}")
        if letter == "R":
            out.append(f"{give()}:{rows[row][2]}")
        row += 1
    assert row == len(rows) and LEGAL.fullmatch("".join(o[:1] for o in out))
    return out


def wanted(rows):
    rows, faults = classify(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit = cheapest(initials, faults)
    text = "\n".join(replay(audit, rows))
    return (gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def test_query_equals_brute_force(spark, small, table):
    df = QUERIES["op12_conversation_repair"](spark, small)
    assert df.columns == ["conv_id", *COLUMNS]
    rows = {r["conv_id"]: tuple(r)[1:] for r in df.collect()}
    kept = damaged(table("conversations"))
    assert rows == {conv: wanted(kept[conv]) for conv in kept}
    assert df.count() == len(kept)


@given(st.text("suaoSUAd", max_size=14), st.integers(1, 5))
@settings(max_examples=400, deadline=None)
def test_edits_equal_all_edits(code, span):
    faults = ["blank" if c == "d" else "truncated" if c.isupper() else "" for c in code]
    before, conversations.SPAN = conversations.SPAN, span
    try:
        assert conversations.edits(code) == cheapest(code.lower(), faults)
    finally:
        conversations.SPAN = before


def test_prices_are_feasible_and_tight():
    draw = random.Random(5)
    for _ in range(200):
        code = "".join(draw.choices("suaoSUAd", k=draw.randrange(17)))
        price, arcs = conversations._auction(code, conversations.END)
        for row in range(len(code)):
            for state in range(4):
                offers = [cost + price[to][then] for _, cost, to, then in arcs[row][state]]
                assert price[row][state] <= min(offers)
        assert price[0][0] == conversations.edits(code)[0]


def random_rows(draw, conv, n):
    words = ["Yes.", "No!", "cut off", "", " \n", "What?", None, "long " * 9 + "."]
    return [(conv, draw.choice([None, k, k, k, k + 1]), draw.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]),
             draw.choice(words) if draw.random() < .5 else f"text {draw.randrange(60)}.", 1, "x") for k in range(n)]


@pytest.mark.parametrize("limit", [3, 50])
def test_long_conversations_in_chunks(spark, limit):
    """A third of all rows in one conversation, NULL ids, faults of every kind, cut anywhere."""
    draw = random.Random(limit)
    rows = random_rows(draw, 1, 120) + random_rows(draw, None, 30)
    for conv in range(2, 40):
        rows += random_rows(draw, conv, draw.randrange(1, 9))
    found = conversations.repair_conversations(spark.createDataFrame(rows, KIND), limit=limit)
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    results = {r["conv_id"]: tuple(r)[1:] for r in found.conversations.collect()}
    assert results == {conv: wanted(by_conv[conv]) for conv in by_conv}
    texts = defaultdict(list)
    for r in found.pieces.orderBy("part", "chunk").collect():
        texts[r["conv_id"]] += [f"{t['role']}:{t['text']}" for t in r["repaired"]]
    for conv, lines in texts.items():
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == results[conv][-1]


def test_repeated_rows_and_absent_conversations(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "Again.", 1, "x")] * 40 + [(2, 0, "user", "Gone.", 0, "x")]
    df = spark.createDataFrame(rows, KIND)
    found = conversations.repair_conversations(df, present=F.col("part") == 1, limit=7).conversations
    results = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    assert results == {1: wanted([(0, "user", "Again.")] * 40),
                       2: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert conversations.repair_conversations(df.limit(0)).conversations.collect() == []
    assert conversations.repair_conversations(df.limit(0)).pieces.collect() == []


def test_damage(spark):
    rows = [(c, t, r, x, 1, "x") for c in (1, 2, None) for t in (None, *range(30)) for r, x in [(None, "A. b!?"), ("system", None)]]
    df, left = conversations.damage(spark.createDataFrame(rows, KIND))
    found = defaultdict(list)
    for r in df.filter(left).collect():
        found[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    kept = damaged([dict(zip(["conv_id", "turn", "role", "text"], r)) for r in rows])
    assert {c: sorted(v, key=repr) for c, v in found.items()} == {c: sorted(v, key=repr) for c, v in kept.items() if v}
