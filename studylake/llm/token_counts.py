r"""Word-piece counts by one pass of a longest-match automaton.

The vocabulary becomes a trie. Where greedy matching would stop at a node, it
has popped a fixed number of pieces and goes on at another node, which both
depend on the node alone; they are computed once, as failure links and counts of
popped pieces. A word is then read byte by byte without ever going back and
without building its pieces.

Words are runs of ``[^\x20\x09-\x0D]``. Each is read with the vocabulary's mark for
a word start in front, so pieces with the mark begin words and others go on.
"""

from __future__ import annotations

import json
import uuid
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from studylake.llm.shipping import map_batches
from studylake.llm.words import blocks

MEMORY = 1_000_000


def byte_of_character() -> dict[str, int]:
    """How byte-level vocabularies write each byte as a printable character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_vocabulary(path: str) -> list[bytes]:
    """The pieces of a byte-level ``tokenizers`` file as bytes; a blank marks a word start."""
    table = byte_of_character()
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    return [bytes(table[c] for c in piece) for piece in vocab if all(c in table for c in piece)]


class Automaton:
    """Greedy longest-match counts over a vocabulary that spells every single byte."""

    def __init__(self, pieces: Iterable[bytes], start: bytes = b" "):
        step: dict[int, int] = {}  # node << 8 | byte -> node; the root is 0
        piece_at = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                edge = node << 8 | byte
                if edge not in step:
                    step[edge] = len(piece_at)
                    piece_at.append(False)
                node = step[edge]
            piece_at[node] = bool(piece)
        missing = [b for b in range(256) if not (b in step and piece_at[step[b]])]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        children: list[list[tuple[int, int]]] = [[] for _ in piece_at]
        for edge, node in step.items():
            children[edge >> 8].append((edge & 255, node))
        fail, popped = [0] * len(piece_at), [0] * len(piece_at)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in children[parent]:
                queue.append(node)
                if piece_at[node]:
                    popped[node] = 1  # the whole node is a piece
                    continue
                back, count = fail[parent], popped[parent]
                while back << 8 | byte not in step:
                    count += popped[back]
                    back = fail[back]
                fail[node], popped[node] = step[back << 8 | byte], count
        self.step, self.fail, self.popped = step, fail, popped
        self.begin, self.begun = self._run(0, 0, start)

    def _run(self, node: int, count: int, data: bytes) -> tuple[int, int]:
        step, fail, popped = self.step, self.fail, self.popped
        for byte in data:
            while (after := step.get(node << 8 | byte)) is None:
                count += popped[node]
                node = fail[node]
            node = after
        return node, count

    def count(self, word: bytes) -> int:
        """Pieces of a word that is not empty."""
        node, count = self._run(self.begin, self.begun, word)
        while node:
            count += self.popped[node]
            node = self.fail[node]
        return count


class _Counts(dict):
    """Counts of recent words, at most ``MEMORY``."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = self.automaton.count(word)
        return value


#: The counts of the vocabulary that the worker used last.
_COUNTS: dict[str, _Counts] = {}


def count_tokens(
    docs: DataFrame, pieces: Iterable[bytes], text: str = "text", start: bytes = b" "
) -> DataFrame:
    """Adds ``n_words`` and ``n_tokens``: words of ``text`` and their pieces.

    ``pieces`` must hold every single byte, so that each word can be spelled. NULL,
    empty and blank texts have none. Other columns pass unchanged; columns of the
    added names are replaced. The vocabulary is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sorted(set(pieces)))
    name = uuid.uuid4().hex
    names = ("n_words", "n_tokens")
    carried = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*carried, *[T.StructField(c, T.LongType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _COUNTS:
            _COUNTS.clear()
            _COUNTS[name] = _Counts(Automaton(shared.value, start))
        counts = _COUNTS[name].__getitem__
        for batch in batches:
            for block in blocks(batch, text):
                words = [t.split() if t else [] for t in block.column(text).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[block.column(f.name) for f in carried],
                     pa.array(map(len, words), pa.int64()),
                     pa.array((sum(map(counts, w)) for w in words), pa.int64())],
                    names=[*[f.name for f in carried], *names])

    return map_batches(docs, run, schema)
