"""Repair of conversations whose turns break the pattern ``(system? (user assistant)+)?``.

The edits of a conversation are a walk over an integer-cost lattice. Its nodes are
(row, state); the state is what has been given so far: nothing, a system turn, a
user turn last, an assistant turn last. Keep, rerole and delete lead over a row,
insert changes the state before one. The cheapest walk is found by the auction
algorithm for shortest paths: every node has a price, a path starts at the origin,
and its last node either takes the best arc (extension) or, where its price is
below the best offer, raises the price to it and leaves the path (contraction).
The prices start from what each row costs at least and never rise above the
distance to the end, so at last every arc of a cheapest walk is tight: its cost
is the difference of its ends' prices. Tight arcs that lead on to the end are
followed from the origin, the least letter first. Auctions run over ``SPAN`` rows
each, the last ones first; the prices before a span are the ends of the one before.

Rows are put in order by one range shuffle, so a task holds a run of the order and
not a conversation. A conversation of up to ``LIMIT`` rows inside a run is repaired
there. Longer ones, and those at the borders of a run, are cut into chunks of bounded
size: repeated rows are found by an aggregate over their digests, each chunk gives its
cost for every pair of first and last state, these are added up from the last chunk to
the first, and every chunk is repaired by itself against the prices behind it. Such
scans, and the digest of the repaired text, which SHA-256 requires to be taken in
order, pass over a conversation's chunks in one task and hold one chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from studylake.llm.shipping import map_batches
from studylake.session import materialize

#: Rows and characters of text that a chunk holds; one longer row is a chunk of its own.
LIMIT = 4096
LIMIT_CHARS = 4 << 20
#: Rows of one auction.
SPAN = 16

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
FAR = 1 << 40

#: White space in a blank text.
_SPACE = " \t\n\x0b\x0c\r"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a system, user or assistant turn, by the state before.
_NEXT = {
    NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
#: The turn that a rerole or insert gives, by the state before.
_GIVES = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_ROLE = {"u": "user", "a": "assistant"}
#: Inserts after the last row that end the conversation, by its state, and their cost.
_TAIL = ("", "II", "I", "")
END = tuple(INSERT * len(letters) for letters in _TAIL)

# A row's code: "d" if it must go, else its role's initial ("o" for any other), upper case if cut off.


def _arcs(code: str, row: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, row, state) of the edits at a node, letters ascending."""
    if row == len(code):
        return []
    here, given = code[row], _NEXT[state][_GIVES[state]]
    found = [("D", DELETE, row + 1, state), ("I", INSERT, row, given)]
    if here != "d":
        extra = CUT_OFF if here.isupper() else 0
        kept = _NEXT[state].get(here.lower())
        if kept is not None:
            found.append(("K", KEEP + extra, row + 1, kept))
        found.append(("R", REROLE + extra, row + 1, given))
    return found


def _lost(arcs: list, behind: tuple[int, ...]) -> list[tuple[int, int]]:
    """The nodes from which no walk leads out; an auction would raise their prices for ever."""
    lost, out = [], {state for state in range(4) if behind[state] < FAR}
    for row in range(len(arcs) - 1, -1, -1):
        if row < len(arcs) - 1:
            ahead, out = out, set()
            for _ in range(4):  # inserts lead through at most three other states
                out |= {state for state in range(4) for _, _, to_row, to_state in arcs[row][state]
                        if to_state in (ahead if to_row > row else out)}
        lost += [(row, state) for state in range(4) if state not in out]
    return lost


def _auction(code: str, behind: tuple[int, ...]) -> tuple[list, list]:
    """Prices and arcs of every node; the prices of the four first nodes are their distances."""
    rows = len(code)
    arcs = [[_arcs(code, row, state) for state in range(4)] for row in range(rows + 1)]
    price = [[min(min(behind), FAR)] * 4 for _ in range(rows + 1)]
    for row in range(rows - 1, -1, -1):
        here = code[row]
        floor = DELETE if here == "d" else CUT_OFF if here.isupper() else KEEP
        price[row] = [price[row + 1][0] + floor] * 4
    for row, state in _lost(arcs, behind):
        price[row][state] = FAR
    for origin in range(4):
        path = [(0, origin)] if price[0][origin] < FAR else []
        while path:
            row, state = path[-1]
            best, ahead = behind[state] if row == rows else FAR, None
            for _, cost, to_row, to_state in arcs[row][state]:
                offer = cost + price[to_row][to_state]
                if offer < best:
                    best, ahead = offer, (to_row, to_state)
            if price[row][state] < best:
                price[row][state] = best
                if len(path) > 1:
                    path.pop()
            elif ahead is None:
                break
            else:
                path.append(ahead)
    return price, arcs


@lru_cache(maxsize=1 << 13)
def _span(code: str, behind: tuple[int, ...]) -> tuple[tuple[int, ...], tuple]:
    """The prices of the four first states, and (letters, last state) of the least walk from each."""
    price, arcs = _auction(code, behind)
    rows = len(code)
    ends = {(rows, state) for state in range(4) if price[rows][state] == behind[state] < FAR}
    into: dict = {}
    for row in range(rows):
        for state in range(4):
            for letter, cost, to_row, to_state in arcs[row][state]:
                if price[row][state] == cost + price[to_row][to_state] < FAR:
                    into.setdefault((to_row, to_state), []).append((letter, (row, state)))
    leads, tight, reached = set(ends), {}, list(ends)
    while reached:
        node = reached.pop()
        for letter, source in into.get(node, ()):
            tight.setdefault(source, []).append((letter, node))
            if source not in leads:
                leads.add(source)
                reached.append(source)
    walks = []
    for state in range(4):
        node, letters = (0, state), []
        while node in tight:
            letter, node = min(tight[node])
            letters.append(letter)
        walks.append(("".join(letters), node[1]) if node in ends else None)
    return tuple(price[0]), tuple(walks)


def _solve(code: str, behind: tuple[int, ...]) -> tuple[tuple[int, ...], tuple]:
    """``_span`` with prices counted from the least one behind, so that equal spans are solved once."""
    base = min(behind)
    prices, walks = _span(code, tuple(b - base if b < FAR else FAR for b in behind))
    return tuple(p + base if p < FAR else FAR for p in prices), walks


def _spans(code: str) -> list[str]:
    return [code[i:i + SPAN] for i in range(0, len(code), SPAN)]


def prices(code: str, behind: tuple[int, ...] = END) -> list[tuple[int, ...]]:
    """The least cost from each of the four states, before every span of ``code`` and behind the last."""
    found = [tuple(behind)]
    for span in reversed(_spans(code)):
        found.append(_solve(span, found[-1])[0])
    return found[::-1]


def walk(
    code: str, behind: tuple[int, ...] = END, state: int = NOTHING, known: list | None = None,
) -> tuple[str, int]:
    """(letters of the cheapest edits of ``code`` from ``state``, the state they end in)."""
    known = known or prices(code, behind)
    letters = []
    for place, span in enumerate(_spans(code)):
        found = _solve(span, known[place + 1])[1][state]
        if found is None:
            return "", -1
        letters.append(found[0])
        state = found[1]
    return "".join(letters), state


def edits(code: str) -> tuple[int, str]:
    """(cost, letters of the edits) of a whole conversation."""
    known = prices(code)
    letters, state = walk(code, known=known)
    return known[0][NOTHING], letters + _TAIL[state]


def apply_edits(
    letters: str, roles: list[str], texts: list[str], state: int = NOTHING,
) -> list[dict[str, str]]:
    """The turns that the edits give, from ``state`` on."""
    out, row = [], 0
    for letter in letters:
        initial = roles[row][:1] if letter == "K" else _GIVES[state]
        if letter == "I":
            out.append({"role": _ROLE[initial], "text": ""})
        elif letter == "K":
            out.append({"role": roles[row], "text": texts[row]})
        elif letter == "R":
            out.append({"role": _ROLE[initial], "text": texts[row]})
        if letter != "D":
            state = _NEXT[state][initial]
        row += letter != "I"
    return out


def _code(role: str, text: str) -> tuple[str, str]:
    """A row's code, and its fault (b blank, t truncated, - none), as long as it repeats no other."""
    body = text.rstrip(_SPACE)
    if not body:
        return "d", "b"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (initial, "-") if body[-1] in ".!?" else (initial.upper(), "t")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _counts(faults: str) -> dict[str, int]:
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t")}


def _turns(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """(least, greatest, number of different) turns of rows in order."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _text(turns: list[dict[str, str]]) -> bytes:
    return "\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()


_RESULT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string")
_REPAIRED = "repaired array<struct<role:string,text:string>>"
_PLACE = "conv string, part int, chunk int"

#: One row per finished conversation, or per chunk (``part`` is then set).
_RUNS = (
    f"{_RESULT}, part int, chunk int, {_REPAIRED}, turns array<long>, codes string, faults string, "
    "roles array<string>, texts array<string>, digests array<string>")


class _Runs:
    """Turns a run of the order into finished conversations and chunks."""

    def __init__(self, part: int, limit: int, limit_chars: int):
        self.part, self.limit, self.limit_chars = part, limit, limit_chars
        self.conv: str | None = None
        self.begun = self.cut = False
        self.first = True
        self.chunk = 0
        self.out: list[dict] = []
        self.clear()

    def clear(self) -> None:
        self.turns, self.roles, self.texts, self.digests, self.chars = [], [], [], [], 0

    def add(self, conv, present: bool, turn, role: str, text: str, digest: str) -> None:
        if not self.begun or conv != self.conv:
            self.close()
            self.conv, self.begun = conv, True
        if not present:
            return
        if self.texts and (len(self.texts) >= self.limit or self.chars + len(text) > self.limit_chars):
            self.flush()
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.digests.append(digest)
        self.chars += len(text)

    def close(self, last: bool = False) -> None:
        """The conversation ends here; at a border of the run it may go on in another one."""
        if self.begun:
            if self.first or last or self.cut:
                self.flush()
            else:
                self.finish()
            self.first = self.cut = False

    def flush(self) -> None:
        """What is held of a conversation becomes a chunk."""
        coded = [_code(role, text) for role, text in zip(self.roles, self.texts)]
        self.out.append(dict(
            conv=self.conv, part=self.part, chunk=self.chunk, turns=self.turns, roles=self.roles,
            texts=self.texts, digests=self.digests, codes="".join(c for c, _ in coded),
            faults="".join(f for _, f in coded)))
        self.chunk += 1
        self.cut = True
        self.clear()

    def finish(self) -> None:
        seen: set = set()
        codes, faults = [], []
        for role, text, digest in zip(self.roles, self.texts, self.digests):
            code, fault = _code(role, text)
            if fault != "b" and (role, digest) in seen:
                code, fault = "d", "d"
            seen.add((role, digest))
            codes.append(code)
            faults.append(fault)
        cost, audit = edits("".join(codes))
        low, high, different = _turns(self.turns)
        repaired = apply_edits(audit, self.roles, self.texts)
        self.out.append(dict(
            conv=self.conv, gaps=high - low + 1 - different if different else 0, **_counts("".join(faults)),
            illegal=_illegal([r[:1] for r in self.roles]), cost=cost, audit=audit, repaired=repaired,
            repaired_sha256=hashlib.sha256(_text(repaired)).hexdigest()))
        self.clear()


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _batches(rows: Iterator[dict], schema: pa.Schema, limit: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(t) for t in row.get("texts") or ()) + sum(len(t["text"]) for t in row.get("repaired") or ())
        if len(held) >= limit or size >= LIMIT_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def _map(df: DataFrame, step: Callable[[Iterator[dict]], Iterator[dict]], ddl: str) -> DataFrame:
    schema = _arrow(ddl)

    def run(batches):
        return _batches(step(_rows(batches)), schema)

    return map_batches(df, run, ddl)


def _in_order(df: DataFrame, backwards: bool = False) -> DataFrame:
    """All chunks of a conversation in one task, one after the other."""
    order = [F.col(c).desc() if backwards else F.col(c).asc() for c in ("conv", "part", "chunk")]
    return df.repartition("conv").sortWithinPartitions(*order)


def _cut(limit: int, limit_chars: int):
    def step(rows):
        runs = _Runs(TaskContext.get().partitionId(), limit, limit_chars)
        for r in rows:
            runs.add(r["conv"], r["present"], r["turn"], r["role"], r["text"], r["digest"])
            yield from runs.out
            runs.out = []
        runs.close(last=True)
        yield from runs.out

    return step


_STATES = (
    f"{_PLACE}, codes string, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first string, final string, low long, high long, different long")


def _states(rows: Iterator[dict]) -> Iterator[dict]:
    """Per chunk: its codes with repeated rows, counts, and its cost for every pair of states."""
    for r in rows:
        codes, faults = list(r["codes"]), list(r["faults"])
        for row in r["repeated"] or ():
            if faults[row] != "b":
                codes[row], faults[row] = "d", "d"
        code = "".join(codes)
        ends = [tuple(0 if state == end else FAR for state in range(4)) for end in range(4)]
        low, high, different = _turns(r["turns"])
        initials = [role[:1] for role in r["roles"]]
        yield dict(
            conv=r["conv"], part=r["part"], chunk=r["chunk"], codes=code,
            costs=[cost for end in ends for cost in prices(code, end)[0]],
            **_counts("".join(faults)), illegal=_illegal(initials),
            first=initials[0] if initials else None, final=initials[-1] if initials else None,
            low=low, high=high, different=different)


_BEHIND = f"{_PLACE}, codes string, behind array<long>, cost long"


def _behind(rows: Iterator[dict]) -> Iterator[dict]:
    """From the last chunk to the first: the prices behind each, and the cost from its start."""
    conv, price = object(), END
    for r in rows:
        if r["conv"] != conv:
            conv, price = r["conv"], END
        costs = r["costs"]
        before = tuple(
            min(FAR, *(costs[4 * end + state] + price[end] for end in range(4))) for state in range(4))
        yield dict(r, behind=list(price), cost=before[NOTHING])
        price = before


_LEADS = f"{_PLACE}, codes string, behind array<long>, cost long, leads array<int>"


def _leads(rows: Iterator[dict]) -> Iterator[dict]:
    """The state at the end of a chunk, by the state before it."""
    for r in rows:
        behind = tuple(r["behind"])
        known = prices(r["codes"], behind)
        yield dict(r, leads=[walk(r["codes"], behind, state, known)[1] for state in range(4)])


_ENTERED = f"{_PLACE}, codes string, behind array<long>, cost long, state int"


def _entered(rows: Iterator[dict]) -> Iterator[dict]:
    """From the first chunk to the last: the state before each."""
    conv, state = object(), NOTHING
    for r in rows:
        if r["conv"] != conv:
            conv, state = r["conv"], NOTHING
        yield dict(r, state=state)
        state = r["leads"][state]


_PIECES = f"{_PLACE}, cost long, audit string, {_REPAIRED}"


def _pieces(rows: Iterator[dict]) -> Iterator[dict]:
    for r in rows:
        behind = tuple(r["behind"])
        audit, state = walk(r["codes"], behind, r["state"])
        if r["tail"]:
            audit += _TAIL[state]
        yield dict(r, audit=audit, repaired=apply_edits(audit, r["roles"], r["texts"], r["state"]))


def _sums(rows: Iterator[dict]) -> Iterator[dict]:
    """One result per conversation from its chunks in order."""
    result = None
    for r in rows:
        if result is None or r["conv"] != result["conv"]:
            if result is not None:
                yield _closed(result)
            result = dict(
                conv=r["conv"], cost=r["cost"], blank=0, duplicate=0, truncated=0, illegal=0, audit=[],
                low=None, high=None, different=0, final=None, hash=hashlib.sha256(), given=False)
        for name in ("blank", "duplicate", "truncated", "illegal", "different"):
            result[name] += r[name]
        if r["first"] is not None:
            if result["final"] is not None:
                result["illegal"] += _illegal([result["final"], r["first"]])
            result["final"] = r["final"]
        if r["low"] is not None:
            result["different"] -= r["low"] == result["high"]
            result["low"] = r["low"] if result["low"] is None else result["low"]
            result["high"] = r["high"]
        result["audit"].append(r["audit"])
        if r["repaired"]:
            result["hash"].update((b"\n" if result["given"] else b"") + _text(r["repaired"]))
            result["given"] = True
    if result is not None:
        yield _closed(result)


def _closed(result: dict) -> dict:
    gaps = result["high"] - result["low"] + 1 - result["different"] if result["different"] else 0
    return dict(result, gaps=gaps, audit="".join(result["audit"]), repaired_sha256=result["hash"].hexdigest())


class Repair(NamedTuple):
    """``conversations``: one row each. ``pieces``: their repaired turns, in order of part and chunk."""

    conversations: DataFrame
    pieces: DataFrame


def repair_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: Column | None = None,
    limit: int = LIMIT,
    limit_chars: int = LIMIT_CHARS,
) -> Repair:
    """Cheapest edits that bring every conversation into the pattern ``(s?(ua)+)?`` of role initials.

    A conversation's rows are taken by turn (NULL first), then role, then the SHA-256 of the text. A row's
    first fault counts: blank (nothing but white space), duplicate (role and text of an earlier row), truncated
    (the last character that is no white space is none of ``.!?``). Keep costs 0, rerole to user or assistant 3,
    delete 4 (the only edit of blank and duplicate rows), insert of an empty user or assistant turn 3; a
    truncated row that stays costs 3 more. Of several cheapest edits the ASCII-least letters (K, R, D, I) are
    taken. ``conversations`` has ``gaps`` (missing turn numbers), ``blank``, ``duplicate``, ``truncated``,
    ``illegal`` (neighbours other than su, ua, au), ``cost``, ``audit`` and ``repaired_sha256`` (of ``role:text``
    lines); ``pieces`` has the repaired turns as (role, text). NULL is a conversation of its own, and a NULL role
    or text is one space. Rows where ``present`` does not hold are left out, but their conversation is
    returned: without rows it has zeros, no edits and no text. Further columns are ignored; an empty table
    has no conversations.
    """
    kind = turns.schema[conv].dataType
    here = F.coalesce(present, F.lit(False)) if present is not None else F.lit(True)
    body = F.when(here, F.coalesce(F.col(text).cast("string"), F.lit(" ")))
    rows = turns.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), body.alias("text"),
        F.sha2(body, 256).alias("digest"), here.alias("present"),
        F.monotonically_increasing_id().alias("_copy"))
    order = [
        F.col("_conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"),
        F.col("_copy")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.col("_conv").cast("string").alias("conv"), "present", "turn", "role", "text", "digest")
    runs = materialize(_map(ordered, _cut(limit, limit_chars), _RUNS))

    chunks = runs.filter(F.col("part").isNotNull())
    place = F.struct("part", "chunk", "pos")
    entries = chunks.select(
        "conv", "part", "chunk", F.posexplode(F.arrays_zip("roles", "digests")).alias("pos", "entry")).select(
        "conv", "part", "chunk", "pos", place.alias("place"), "entry.roles", "entry.digests")
    firsts = entries.groupBy(F.col("conv").alias("_conv"), "roles", "digests").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    repeated = entries.join(
        firsts.withColumnsRenamed({"roles": "_roles", "digests": "_digests"}),
        F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("roles") == F.col("_roles"))
        & (F.col("digests") == F.col("_digests"))).filter(F.col("place") != F.col("first"))
    # at most one chunk's rows
    repeated = repeated.groupBy("part", "chunk").agg(F.collect_list("pos").alias("repeated"))
    coded = chunks.select("conv", "part", "chunk", "turns", "codes", "faults", "roles").join(
        repeated, ["part", "chunk"], "left")
    states = materialize(_map(coded, _states, _STATES))
    behind = _map(_in_order(states.select("conv", "part", "chunk", "codes", "costs"), True), _behind, _BEHIND)
    entered = materialize(_map(_in_order(_map(behind, _leads, _LEADS)), _entered, _ENTERED))
    tails = entered.groupBy("conv").agg(F.max(F.struct("part", "chunk")).alias("end")).select(
        "end.part", "end.chunk", F.lit(True).alias("tail"))
    solved = chunks.select("part", "chunk", "roles", "texts").join(entered, ["part", "chunk"]).join(
        tails, ["part", "chunk"], "left")
    pieces = materialize(_map(solved, _pieces, _PIECES))
    summed = _map(
        _in_order(pieces.join(states.drop("conv", "codes", "costs"), ["part", "chunk"])), _sums, _RESULT)

    def named(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(F.col("conv").cast(kind).alias(conv), *columns)

    finished = runs.filter(F.col("part").isNull())
    columns = [f.name for f in T.StructType.fromDDL(_RESULT)][1:]
    return Repair(
        named(finished.unionByName(summed, allowMissingColumns=True), *columns),
        named(finished.select("conv", "part", "chunk", "repaired").unionByName(
            pieces.select("conv", "part", "chunk", "repaired")), "part", "chunk", "repaired"))


def damage(turns: DataFrame) -> tuple[DataFrame, Column]:
    """``turns`` with faults by crc32 of ``conv_id:turn`` modulo 20, and which rows are left.

    0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4 makes its role user.
    NULL counts as one space in every column.
    """
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"])) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(filled["text"], ".!?", "")).otherwise(filled["text"])
    damaged = turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(filled["role"]).alias("role"),
        text.alias("text"), fault.alias("fault"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"))
    return damaged.drop("copy"), F.col("fault") != 0
