"""BPE token ids by dynamic programming over prefixes, and back to text.

For every prefix of a piece exactly one token can come last in its encoding. An
Aho-Corasick automaton of the vocabulary yields the tokens that end at each
place; the one that is compatible with the last token of the prefix before it is
stored, and back-pointers from the end give the ids. Two tokens are compatible
when no merge across their border would have come first, which is decided by
undoing merges on both sides of the border in reverse order.

The vocabulary file is read once on the driver and broadcast (one to two MB).
Normalising and splitting a text into pieces is left to the components that the
file describes, for the new words of a block at once. A worker keeps the encodings
of recent words and pieces and the answers for recent pairs, each within ``MEMORY`` bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.llm.shipping import map_batches
from studylake.llm.words import blocks

#: Bytes that each memory of a worker may take, about: of words, pieces and pairs of tokens.
MEMORY = 72 << 20
#: Longer words are encoded each time.
LONG = 64

_NEVER = 1 << 40
_END = "\n"  # marks the end of a word; no byte is written as this character
#: Token numbers fit into so many bits; the last one stands for no token.
_BITS = 24
_NONE = (1 << _BITS) - 1
_PAIR_BYTES = 100
_WORD_BYTES = 200


class _Memo(dict):
    """A dict that computes what it lacks and starts anew when it has ``limit`` entries."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class _Recent:
    """What was asked for last: a full generation becomes the old one, and answers move up from there."""

    def __init__(self, limit: int):
        self.limit, self.now, self.old = limit, {}, {}

    def turn(self) -> dict:
        if len(self.now) >= self.limit:
            self.now, self.old = {}, self.now
        return self.now


class Encoder:
    """Encodes and decodes with the BPE model of a ``tokenizers`` file."""

    def __init__(self, description: str):
        import ahocorasick
        from tokenizers import Tokenizer

        parts = json.loads(description)
        model = parts["model"]
        plain = {"dropout": None, "continuing_subword_prefix": None, "byte_fallback": False,
                 "ignore_merges": False}
        if model["type"] != "BPE" or any(model.get(k) not in (v, "", None) for k, v in plain.items()):
            raise ValueError("only plain BPE models are supported")
        if parts.get("decoder") is not None:
            raise ValueError("only files without a decoder are supported")
        suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        tokenizer = Tokenizer.from_str(description)
        self._normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self._split = tokenizer.pre_tokenizer.pre_tokenize_str
        self._marked = bool(suffix)
        self._text = {i: s for s, i in vocab.items()}
        self._text.update((t["id"], t["content"]) for t in parts["added_tokens"])

        self._special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
               for t in parts["added_tokens"]):
            raise ValueError("only literal added tokens are supported")
        longest_first = sorted(self._special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") \
            if longest_first else None

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._rank: dict[int, int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self._joins: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            halves, token = (vocab[left], vocab[right]), vocab[left + right]
            self._joins.setdefault(halves, (rank, token))
            if token not in self._rank:
                self._rank[token], self._halves[token] = rank, halves
        self._symbols = {t: i for t, i in vocab.items()}
        self._suffix = suffix
        self._automaton = ahocorasick.Automaton()
        for string, token in vocab.items():
            ends = suffix and string.endswith(suffix)
            spelled = string[:-len(suffix)] + _END if ends else string
            self._automaton.add_word(spelled, len(spelled) << _BITS | token)
        self._automaton.make_automaton()
        if len(vocab) >= _NONE:
            raise ValueError("too many tokens")
        self._fits = _Memo(self._may_follow, MEMORY // _PAIR_BYTES)
        self._words = _Recent(MEMORY // (2 * _WORD_BYTES))
        self._pieces = _Recent(MEMORY // (2 * _WORD_BYTES))
        top = max(self._text)
        self._tokens = pa.array([self._text.get(i) for i in range(top + 1)], pa.string())

    def _merged(self, symbols: list[int]) -> list[int]:
        """All merges in order of rank, leftmost first."""
        while True:
            known = [(self._joins[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:]))
                     if p in self._joins]
            if not known:
                return symbols
            _, i = min(known)
            symbols[i:i + 2] = [self._joins[symbols[i], symbols[i + 1]][1]]

    def _is_sound(self, token: int) -> bool:
        """Whether the token's own string is encoded as this token."""
        string = self._text[token]
        body = string[:-len(self._suffix)] if self._suffix and string.endswith(self._suffix) else string
        symbols = list(body)
        if len(body) < len(string):
            symbols[-1] += self._suffix
        return all(s in self._symbols for s in symbols) and \
            self._merged([self._symbols[s] for s in symbols]) == [token]

    def _may_follow(self, pair: int) -> bool:
        """Whether the second token of a packed pair is sound and compatible with the first, if any."""
        left, right = pair >> _BITS, pair & _NONE
        if left == _NONE:
            return self._is_sound(right)
        return self._is_compatible(left, right) and (
            self._fits[_NONE << _BITS | right])

    def _is_compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens before they are complete."""
        joins, rank = self._joins.get, self._rank.get
        left_until = right_until = _NEVER
        while True:
            crossing = joins((left, right))
            if crossing and crossing[0] < left_until and crossing[0] <= right_until:
                return False
            made_left, made_right = rank(left, -1), rank(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left, left_until = self._halves[left][1], made_left
            else:
                right, right_until = self._halves[right][0], made_right

    def _encode_piece(self, piece: str) -> bytes:
        """The packed ids of one piece."""
        spelled = piece + _END if self._marked else piece
        fits, size = self._fits, len(spelled)
        last, before = [-1] * (size + 1), [0] * (size + 1)
        last[0] = _NONE
        for end, match in self._automaton.iter(spelled):
            end += 1
            if last[end] < 0:
                start = end - (match >> _BITS)
                left = last[start]
                if left >= 0 and fits[left << _BITS | match & _NONE]:
                    last[end], before[end] = match & _NONE, start
        if last[size] < 0:
            raise ValueError(f"the vocabulary cannot spell {piece!r}")
        ids = []
        while size:
            ids.append(last[size])
            size = before[size]
        return _packed(ids[::-1])

    def _encode_plain(self, text: str) -> bytes:
        pieces = self._split(self._normalize(text)) if text else []
        return b"".join(self._encode_piece(piece) for piece, _ in pieces)

    def _encode_alone(self, text: str) -> bytes:
        """The packed ids of any string; added tokens in it are recognised first."""
        if self._cut is None or not self._cut.search(text):
            return self._encode_plain(text)
        return b"".join(
            _packed([self._special[part]]) if part in self._special else self._encode_plain(part)
            for part in self._cut.split(text))

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Every word's packed ids; normalised and split in one call, with a blank between words.

        The normaliser and the splitter see no further than a blank. Where they make other words
        of the row of them, each is encoded alone.
        """
        plain = [w for w in words if self._cut is None or not self._cut.search(w)]
        row = self._normalize(" ".join(plain))
        parts = row.split(" ") if plain else []
        if len(parts) != len(plain):
            return {w: self._encode_alone(w) for w in words}
        split = self._split(row)
        known, old = self._pieces.turn(), self._pieces.old
        asked = {piece for piece, _ in split}
        ids = {piece: known.get(piece) or old.get(piece) for piece in asked}
        new = [piece for piece in asked if ids[piece] is None]
        ids.update((piece, self._encode_piece(piece)) for piece in new)
        known.update((piece, i) for piece, i in ids.items() if len(piece) <= LONG)
        found: list[bytes] = [b""] * len(plain)
        place, end = 0, len(parts[0]) if parts else 0
        for piece, (start, _) in split:
            while start > end:
                place += 1
                end += 1 + len(parts[place])
            found[place] += ids[piece]
        encoded = dict(zip(plain, found))
        encoded.update((w, self._encode_alone(w)) for w in words if w not in encoded)
        return encoded

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers."""
        split = [None if _UNUSUAL.search(text) else text.split() for text in texts]
        known, old = self._words.turn(), self._words.old
        new = {w for words in split if words for w in words if w not in known}
        known.update((w, old[w]) for w in new if w in old)
        encoded = self._encode_words([w for w in new if w not in old])
        known.update((w, ids) for w, ids in encoded.items() if len(w) <= LONG)
        find = {**encoded, **known}.__getitem__ if any(len(w) > LONG for w in encoded) else known.__getitem__
        return [
            self._encode_alone(text) if words is None else b"".join(map(find, words))
            for text, words in zip(texts, split)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode_all(self, ids: list[bytes]) -> pa.Array:
        """The texts of packed ids: their tokens joined by blanks, as without a decoder."""
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        bounds = np.cumsum([0, *(len(i) // 4 for i in ids)])
        tokens = self._tokens.take(pa.array(flat))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), tokens), " ")

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0].as_py()


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


#: White space to Python alone; a text with these is not cut at blanks beforehand.
_UNUSUAL = re.compile("[\x1c-\x1f]")

_ENCODERS: dict[str, Encoder] = {}


def _encoder(description: str) -> Encoder:
    name = hashlib.blake2b(description.encode(), digest_size=16).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(description)
    return _ENCODERS[name]


def _shared(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _mapped(docs: DataFrame, path: str, source: str, made: list[tuple[str, T.DataType]], steps) -> DataFrame:
    """``docs`` with the columns ``made`` by ``steps`` (encoder, block) from the column ``source``."""
    shared = _shared(docs, path)
    names = [name for name, _ in made]
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *(T.StructField(*m) for m in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for block in blocks(batch, source):
                yield pa.RecordBatch.from_arrays(
                    [*[block.column(f.name) for f in kept], *steps(encoder, block.column(source))],
                    names=schema.names)

    return map_batches(docs, run, schema)


def _ids(encoder: Encoder, texts: pa.Array) -> list[bytes]:
    return encoder.encode_all([t or "" for t in texts.to_pylist()])


def encode(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Adds ``name``: the token ids of ``text``, packed as little-endian unsigned 32-bit.

    Equal to the ids of the library for the file at ``path`` without special
    tokens around the text. A NULL text counts as empty and has no ids. Other
    columns pass unchanged; a column called ``name`` is replaced.
    """
    return _mapped(
        docs.withColumn(text, F.col(text).cast("string")), path, text, [(name, T.BinaryType())],
        lambda encoder, texts: [pa.array(_ids(encoder, texts), pa.binary())])


def decode(docs: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds ``name``: the text of the packed token ids in ``ids``; NULL ids count as none."""
    return _mapped(
        docs, path, ids, [(name, T.StringType())],
        lambda encoder, packed: [encoder.decode_all([i or b"" for i in packed.to_pylist()])])


def round_trip(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
) -> DataFrame:
    """``encode`` and then ``decode`` in one pass, without ``text``."""
    hidden = "_llm_text"
    texts = docs.withColumn(hidden, F.col(text).cast("string")).drop(text)

    def steps(encoder: Encoder, column: pa.Array) -> list[pa.Array]:
        packed = _ids(encoder, column)
        return [pa.array(packed, pa.binary()), encoder.decode_all(packed)]

    return _mapped(
        texts, path, hidden, [(ids, T.BinaryType()), (decoded, T.StringType())], steps).drop(hidden)
