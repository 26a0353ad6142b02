r"""Benchmark passages in documents, found by winnowed fingerprints.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z. Of
every window of 10 words the least 5-word hash is kept, the first of equal ones,
once per place: these are a text's fingerprints, about two for seven words. Texts
that share 10 words in a row share a fingerprint inside them, at the same place
of the passage. An item of fewer words is its own fingerprint.

Fingerprints of documents and of the benchmark are joined by that hash. A hit is
then extended over the words around it: its reaches are the runs of 10 words that
hold it, five words to either side at most, and one counts where the benchmark
has an equal reach. Reaches meet by two independent 64-bit hashes of their words,
so a phrase that stands in many contexts never pairs them all. Longer passages
are the union of the reaches of the fingerprints along them.

A bitmap of the benchmark's fingerprints, of at most 16 MB, keeps most of a
document's from leaving their task; it only saves work, the join decides.
Everything that grows, with the documents or with the benchmark, is joined. Texts
are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.shipping import map_batches
from studylake.llm.words import ALPHANUMERIC, WordHasher, blocks, combine, lists
from studylake.session import materialize

WINDOW = 10
GRAM = 5

_LEAST_BITS, _MOST_BITS = 20, 27
_FOUND = ("marks", "places", "sizes", "leads", "arounds")
_SPANS = "array<struct<start:int,size:int>>"
_REACH = ("size", "reach", "check")


def _winnow(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) of a block of texts, each place once and in order."""
    n = max(0, len(hashes) - WINDOW + 1)
    grams = combine(hashes, GRAM)
    least, at = grams[:n].copy(), np.arange(n)
    for k in range(1, WINDOW - GRAM + 1):
        lower = grams[k:k + n] < least
        least[lower] = grams[k:k + n][lower]
        at[lower] = np.flatnonzero(lower) + k
    ends = np.repeat(bounds[1:], np.diff(bounds))[:n]
    places = np.unique(at[np.arange(n) + WINDOW <= ends])
    return places, grams[places]


def _around(hashes: np.ndarray, bounds: np.ndarray, places: np.ndarray,
            sizes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(words before the place, hashes of the words that a reach can hold) per fingerprint."""
    owner = np.searchsorted(bounds, places, side="right") - 1
    arm = np.where(sizes == WINDOW, WINDOW - GRAM, 0)
    first = np.maximum(places - arm, bounds[:-1][owner])
    last = np.minimum(places + arm + np.where(sizes == WINDOW, GRAM, sizes), bounds[1:][owner])
    edges = np.concatenate([[0], np.cumsum(last - first)])
    chosen = np.arange(edges[-1]) + np.repeat(first - edges[:-1], last - first)
    return places - first, lists(hashes[chosen].view(np.int64), edges, pa.int64())


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, size, mark, lead, around) for every fingerprint of every item."""
    hasher = WordHasher(ALPHANUMERIC)
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, bounds = hasher(block.column("text"))
            found = [(*_winnow(hashes, bounds), WINDOW)]
            for size in range(1, WINDOW):
                short = bounds[:-1][np.diff(bounds) == size]
                if len(short):
                    found.append((short, combine(hashes, size)[short], size))
            for places, marks, size in found:
                sizes = np.full(len(places), size)
                lead, around = _around(hashes, bounds, places, sizes)
                owner = np.searchsorted(bounds, places, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [block.column("item").take(pa.array(owner)), pa.array(sizes, pa.int32()),
                     pa.array(marks.view(np.int64)), pa.array(lead, pa.int32()), around],
                    names=["item", "size", "mark", "lead", "around"])


def _marked(sizes: Sequence[int], bitmap: np.ndarray):
    """(key, body, n_words, found): the fingerprints that the bitmap knows."""
    mask = np.uint64(len(bitmap) * 64 - 1)

    def known(hashes: np.ndarray, size: int, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        if size == WINDOW:
            places, marks = _winnow(hashes, bounds)
        else:
            marks = combine(hashes, size)
            ends = np.repeat(bounds[1:], np.diff(bounds))[:len(marks)]
            places = np.flatnonzero(np.arange(len(marks)) + size <= ends)
            marks = marks[places]
        low = (marks & mask).astype(np.int64)
        hit = (bitmap[low >> 6] >> (low & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return places[hit], marks[hit], np.full(int(hit.sum()), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALPHANUMERIC)
        for batch in batches:
            for block in blocks(batch, "text"):
                hashes, bounds = hasher(block.column("text"))
                parts = [known(hashes, s, bounds) for s in sizes] or [known(hashes[:0], 1, bounds * 0)]
                places, marks, widths = (np.concatenate(p) for p in zip(*parts, strict=True))
                order = np.argsort(places, kind="stable")
                places, marks, widths = places[order], marks[order], widths[order]
                rows = np.searchsorted(places, bounds)
                lead, around = _around(hashes, bounds, places, widths)
                found = [lists(marks.view(np.int64), rows, pa.int64()),
                         lists(places - np.repeat(bounds[:-1], np.diff(rows)), rows, pa.int32()),
                         lists(widths, rows, pa.int32()), lists(lead, rows, pa.int32()),
                         pa.ListArray.from_arrays(pa.array(rows, pa.int32()), around)]
                yield pa.RecordBatch.from_arrays(
                    [block.column("key"), block.column("body"), pa.array(np.diff(bounds), pa.int64()),
                     *found], names=["key", "body", "n_words", *_FOUND])
    return run


def _reaches() -> Column:
    """The runs of ``size`` words in ``around`` that hold the fingerprint: (size, reach, check, shift)."""
    last = F.least(F.col("lead"), F.size("around") - F.col("size"))

    def reach(i: Column) -> Column:
        run = F.slice("around", i + 1, F.col("size"))
        return F.struct(F.col("size").alias("size"), F.xxhash64(run).alias("reach"),
                        F.xxhash64(F.lit(GRAM), run).alias("check"), (i - F.col("lead")).alias("shift"))

    return F.transform(F.sequence(F.lit(0), last), reach)


def _bitmap(known: DataFrame) -> np.ndarray:
    """The low bits of all fingerprints in ``known``; 128 KB to 16 MB by their number."""
    marks = known.select("mark").distinct()
    wanted = 16 * marks.count()
    bits = min(max(wanted.bit_length(), _LEAST_BITS), _MOST_BITS)
    low = marks.select(F.col("mark").bitwiseAND(F.lit((1 << bits) - 1)).alias("low"))
    slots = low.groupBy(F.shiftright("low", 6).alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(low & 63 as int)))").alias("set")).toArrow()
    out = np.zeros(1 << bits - 6, dtype=np.uint64)
    out[slots.column("slot").to_numpy()] = slots.column("set").to_numpy().view(np.uint64)
    return out


def covered_words(spans: Column) -> Column:
    """Words inside at least one of the spans, which are sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans, zero,
        lambda state, s: F.struct(
            F.greatest(state["end"], s["start"] + s["size"]).alias("end"),
            (state["n"] + F.greatest(
                F.lit(0), s["start"] + s["size"] - F.greatest(state["end"], s["start"]))
             ).cast("long").alias("n")),
        lambda state: state["n"])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, n_words, n_hit, spans, items) for every row of ``docs``.

    ``spans`` are the benchmark windows in the text as (start, size) in words,
    sorted; ``n_hit`` counts the words inside them; ``items`` are the distinct
    non-NULL items with such a window, sorted as strings. NULL and empty texts
    have no words; so have such items, which match nothing. Equal texts share
    their findings, so repeated rows and NULL keys do no harm. Other columns of
    both tables are ignored.
    """
    bodies = docs.select(
        F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("body"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = bodies.schema["key"].dataType.simpleString()
    asked = benchmark.select(F.col(item).cast("string").alias("item"),
                             F.col(item_text).cast("string").alias("text"))
    known = materialize(map_batches(
        asked, _items, "item string, size int, mark bigint, lead int, around array<bigint>").distinct())

    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most ten
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _marked(sizes, bitmap.value)(batches)

    marked = materialize(map_batches(
        bodies, run, f"key {kind}, body string, n_words bigint, marks array<bigint>, places array<int>, "
                     "sizes array<int>, leads array<int>, arounds array<array<bigint>>"))
    # fingerprints meet, then what reaches around them
    hits = (
        marked.select("body", F.explode(F.arrays_zip(*_FOUND)).alias("f"))
        .select("body", F.col("f.marks").alias("mark"), F.col("f.places").alias("place"),
                F.col("f.sizes").alias("size"), F.col("f.leads").alias("lead"),
                F.col("f.arounds").alias("around"))
        .join(known.select("mark", "size").distinct(), ["mark", "size"], "left_semi"))
    asked_reaches = materialize(
        known.select("item", F.explode(_reaches()).alias("r"))
        .select("item", *[f"r.{c}" for c in _REACH]).distinct())
    windows = materialize(
        hits.select("body", "place", F.explode(_reaches()).alias("r"))
        .select("body", *[f"r.{c}" for c in _REACH], (F.col("place") + F.col("r.shift")).alias("start"))
        .join(asked_reaches.select(*_REACH).distinct(), [*_REACH], "left_semi").distinct())
    spans = windows.groupBy("body").agg(
        F.sort_array(F.collect_set(F.struct("start", "size"))).cast(_SPANS).alias("spans"))
    # reaches of the same items are one group, so a passage meets its items once and not word by word
    named = asked_reaches.filter(F.col("item").isNotNull())
    grouped = materialize(named.groupBy(*_REACH).agg(
        F.bit_xor(F.xxhash64("item")).alias("one"), F.bit_xor(F.xxhash64(F.lit(GRAM), "item")).alias("two"),
        F.count(F.lit(1)).alias("n")))
    group = ["one", "two", "n"]
    shown = grouped.groupBy(*group).agg(F.min(F.struct(*_REACH)).alias("r")).select(
        *group, *[f"r.{c}" for c in _REACH])
    items = (
        windows.select("body", *_REACH).distinct().join(grouped, [*_REACH])
        .select("body", *group).distinct()
        .join(shown.join(named, [*_REACH]).select(*group, "item"), group)
        .select("body", "item").distinct()
        .groupBy("body").agg(F.sort_array(F.collect_list("item")).alias("items")))
    found = materialize(spans.join(items, "body", "left"))
    return marked.drop(*_FOUND).join(found, "body", "left").select(
        F.col("key").alias(key), "n_words",
        F.coalesce(covered_words(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of the benchmark."""
    marker = F.struct(F.col(key).alias("key"), F.md5(F.col(text)).alias("body"))
    found = find_contamination(
        docs.select(marker.alias("_llm_row"), F.col(text).alias("_llm_text")), benchmark,
        "_llm_row", "_llm_text", item, item_text)
    gone = materialize(
        found.filter(F.col("n_hit") > 0).select("_llm_row.key", "_llm_row.body").distinct()
        .withColumnsRenamed({"key": "_llm_key", "body": "_llm_body"}))
    hashed = docs.withColumn("_llm_hash", F.md5(F.col(text)))
    return hashed.join(
        gone.hint("shuffle_hash"), (F.col("_llm_hash") == F.col("_llm_body")) & F.col(key).eqNullSafe(F.col("_llm_key")),
        "left_anti").drop("_llm_hash")
