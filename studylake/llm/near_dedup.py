r"""Near-duplicate groups by HyperMinHash sketches, banding and exact verification.

A text's set holds the hashes of its distinct word shingles (words are runs of
``[^\x20\x09-\x0D]`` after lower-casing A-Z; a text with fewer words than a
shingle is one shingle). Its sketch has 256 buckets by the top bits of the hash;
a register stores the leading-zero count (6 bits) and 10 mantissa bits of the
least hash in the bucket. An empty bucket borrows from the first filled one in a
fixed random order of its own.

1. Texts with equal sets are one class, named by its least key.
2. 32 bands of five registers give candidates: two sets of similarity 0.8 miss
   all bands with probability 3e-6, more similar ones less.
3. In a band's bucket every member is paired with one hub, drawn by hash, so a
   group of n gives n - 1 pairs. Members that the links leave in different
   components are paired with the bucket's most common member, and at last by a
   positional prefix filter on their rarest shingles, which is exact and in a group
   of near copies leaves few pairs. No link is lost and no group is expanded.
4. A pair must first pass the Jaccard estimate, corrected for registers that
   agree by chance (six standard errors of slack; small sets skip it), and is
   then confirmed on the full sets.
5. Links become components in tables.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.components import components
from studylake.llm.shipping import map_batches
from studylake.llm.words import NOT_SPACE, WordHasher, blocks, combine, lists, mix
from studylake.session import materialize

BUCKETS = 256
BANDS = 32
ROWS = 5
SHINGLE = 5
PERCENT = 80
#: Hubs that a group of near copies is compared with, about.
HUBS = 4
#: Ratio of the sizes at the borders of a band.
BAND_STEP = 1.05
#: Cells of the table that orders shingles by frequency (8 MB).
CELLS = 1 << 20

_SHIFT = np.uint64(64 - 8)
_SLACK = 6.0
#: Sets below this go to verification without an estimate.
_SMALL = 64
#: Registers of unrelated sets agree by chance with about this probability.
_CHANCE = 2.0 ** -10 / 3


def _borrow_order() -> np.ndarray:
    """Row i: the place of every bucket in the order in which bucket i tries them."""
    i, j = np.meshgrid(*[np.arange(BUCKETS, dtype=np.uint64)] * 2, indexing="ij")
    order = (mix(i * np.uint64(BUCKETS) + j + np.uint64(1)) >> np.uint64(40)).astype(np.int64)
    np.fill_diagonal(order, -1)
    return order


_ORDER = _borrow_order()


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a sorted array of distinct 64-bit hashes, 256 16-bit registers."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if not len(found):
        return out
    bucket = (found >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    filled = bucket[first]
    rest = found[first] << np.uint64(8)
    # a float has the position of the leading one as its exponent and what follows as its mantissa
    bits = rest.astype(np.float64).view(np.uint64)
    zeros = np.where(rest == 0, 63, 1086 - (bits >> np.uint64(52)).astype(np.int64)).clip(0, 63)
    mantissa = ((bits >> np.uint64(42)) & np.uint64(1023)).astype(np.int64)
    out[filled] = (zeros << 10 | mantissa).astype(np.uint16)
    if len(filled) < BUCKETS:
        empty = np.setdiff1d(np.arange(BUCKETS), filled, assume_unique=True)
        out[empty] = out[filled[_ORDER[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity per row of two register matrices, less what agrees by chance."""
    share = (a == b).mean(axis=1)
    return (share - _CHANCE) / (1 - _CHANCE)


def _sets(batch: pa.RecordBatch, hasher: WordHasher, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for the rows of a batch (key, text)."""
    row = 0
    for block in blocks(batch, "text"):
        hashes, bounds = hasher(block.column("text"))
        joined = combine(hashes, shingle)
        for i in range(block.num_rows):
            start, stop = int(bounds[i]), int(bounds[i + 1])
            if stop - start >= shingle:
                yield row, np.unique(joined[start:stop - shingle + 1])
            else:
                yield row, combine(hashes[start:stop], stop - start) if stop > start else hashes[:0]
            row += 1


def _described(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_SPACE)
        for batch in batches:
            sizes, names, sketches = [], [], []
            for _, found in _sets(batch, hasher, shingle):
                sizes.append(len(found))
                names.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sketches.append(registers(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()),
                 pa.array(names, pa.binary()), pa.array(sketches, pa.binary())],
                names=["key", "n", "set_id", "sketch"])
    return run


def _listed(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_SPACE)
        for batch in batches:
            found = [s.tobytes() for _, s in _sets(batch, hasher, shingle)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found, pa.binary())], names=["key", "hashes"])
    return run


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, shingles in it) over the sets of a task, for the cells that it met."""
    table = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        for found in batch.column("hashes"):
            np.add.at(table, _cell(np.frombuffer(found.as_py(), np.uint64)), 1)
    cells = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int32()), pa.array(table[cells])], names=["cell", "n"])


def _rarest(table: np.ndarray, percent: int):
    """(key, n, commonness, shingles): the prefix of every set, the rarest shingle first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, means, prefixes = [], [], []
            for found in batch.column("hashes"):
                hashes = np.frombuffer(found.as_py(), np.uint64)
                size = len(hashes)
                # a linked set shares at least this many
                common = -(-percent * size // 100)
                often = table[_cell(hashes)]
                order = np.lexsort((hashes, often))
                sizes.append(size)
                means.append(float(often.mean()) if size else 0.0)
                prefixes.append(hashes[order[:size - common + 1]].view(np.int64))
            bounds = np.cumsum([0, *map(len, prefixes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(means, pa.float64()),
                 lists(np.concatenate([np.empty(0, np.int64), *prefixes]), bounds, pa.int64())],
                names=["key", "n", "commonness", "shingles"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = _matrix(batch.column("sketch"))[:, :BANDS * ROWS].astype(np.uint64)
        keys = np.broadcast_to(bands, (len(regs), BANDS)).copy()
        for k in range(ROWS):
            keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + regs[:, k::ROWS])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("n"),
             lists(keys.ravel().view(np.int64), np.arange(len(regs) + 1) * BANDS, pa.int64())],
            names=["key", "n", "bands"])


def _plausible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = percent / 100
        slack = _SLACK * (share * (1 - share) / BUCKETS) ** 0.5
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            near = estimate(_matrix(batch.column("sa")), _matrix(batch.column("sb"))) >= share - slack
            fits = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            keep = fits & (near | (np.minimum(na, nb) < _SMALL))
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _confirmed(percent: int):
    def linked(one: bytes, other: bytes) -> bool:
        x, y = (np.frombuffer(s, dtype=np.uint64) for s in (one, other))
        if len(x) > len(y):
            x, y = y, x
        if not len(x):
            return False
        places = np.searchsorted(y, x)
        shared = int((y[np.minimum(places, len(y) - 1)] == x).sum())
        return 100 * shared >= percent * (len(x) + len(y) - shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x.as_py(), y.as_py())
                    for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


class _Linker:
    """Confirms candidate pairs (a, b) of class names."""

    def __init__(self, texts: DataFrame, classes: DataFrame, shingle: int, percent: int):
        self.texts, self.classes, self.shingle, self.percent = texts, classes, shingle, percent
        self.kind = texts.schema["key"].dataType.simpleString()

    def _sides(self, pairs: DataFrame, facts: DataFrame, **names: str) -> DataFrame:
        for side in ("a", "b"):
            renamed = facts.select(F.col("key").alias(side), *[
                F.col(c).alias(f"{short}{side}") for c, short in names.items()])
            pairs = pairs.join(renamed, side)
        return pairs

    def __call__(self, pairs: DataFrame) -> DataFrame:
        pair = f"a {self.kind}, b {self.kind}"
        sketched = self._sides(pairs, self.classes, n="n", sketch="s")
        plausible = materialize(
            map_batches(sketched, _plausible(self.percent), pair).distinct())
        needed = materialize(plausible.select(F.col("a").alias("key")).unionByName(
            plausible.select(F.col("b").alias("key"))).distinct())
        # texts are shuffled whatever the number of candidates
        sets = materialize(map_batches(
            self.texts.join(needed.hint("shuffle_hash"), "key", "left_semi"),
            _listed(self.shingle), f"key {self.kind}, hashes binary"))
        full = self._sides(plausible, sets, hashes="h")
        return materialize(map_batches(full, _confirmed(self.percent), pair).distinct())


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, percent: int = PERCENT,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``.

    ``component_id`` is the least key among the texts reachable by links of at
    least ``percent`` % Jaccard similarity, the row's own included; ``kept`` says
    that it is the row's own key. A NULL, empty or blank text has no shingles and
    links with nothing. Rows that share a key count as one document. A row
    without a key is never linked: its component is NULL and it is kept. Other
    columns of ``docs`` are ignored.
    """
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    described = materialize(map_batches(
        texts, _described(shingle), f"key {kind}, n bigint, set_id binary, sketch binary"))

    named = described.filter(F.col("key").isNotNull() & (F.col("n") > 0))
    least = materialize(named.groupBy("set_id").agg(F.min("key").alias("key")))
    classes = materialize(named.join(least, ["set_id", "key"]).select("key", "n", "sketch"))
    banded = materialize(
        map_batches(classes, _banded, f"key {kind}, n bigint, bands array<bigint>")
        .select("key", "n", F.posexplode("bands").alias("place", "band")))
    shared = materialize(
        banded.groupBy("band").agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") > 1).select("band"))
    members = materialize(banded.join(shared, "band", "left_semi"))
    draw = F.xxhash64("key", F.col("place") % HUBS)
    hubs = materialize(
        members.groupBy("band").agg(F.min(F.struct(draw.alias("draw"), "key"))["key"].alias("hub")))
    stars = materialize(_pairs(
        members.join(hubs, "band").filter(F.col("key") != F.col("hub")), "hub", "key"))

    linker = _Linker(texts, classes, shingle, percent)
    labels = components(linker(stars))
    ranked, tried = _ranked(members, labels, linker), stars
    for pairs_of in (_central_pairs, _prefix_pairs):
        pairs = materialize(pairs_of(members, labels, ranked, linker).join(
            tried, ["a", "b"], "left_anti"))
        labels = _merged(labels, linker(pairs))
        tried = tried.unionByName(pairs)

    whole = materialize(least.join(labels, least["key"] == labels["node"], "left").select(
        "set_id", F.coalesce("label", "key").alias("component_id")))
    placed = described.join(whole, "set_id", "left")
    own = F.when((F.col("n") > 0) & F.col("key").isNotNull(), F.col("component_id")).otherwise(
        F.col("key"))
    return placed.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"))


def _pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links, of nodes with or without a label."""
    if links.isEmpty():
        return labels
    named = labels.select(F.col("node").alias("key"), "label")
    for side in ("a", "b"):
        renamed = named.select(F.col("key").alias(side), F.col("label").alias("_label"))
        links = links.join(renamed, side, "left").withColumn(
            side, F.coalesce("_label", side)).drop("_label")
    joined = components(links).select(F.col("node").alias("label"), F.col("label").alias("_final"))
    grown = named.unionByName(joined.select(F.col("label").alias("key"), "label")).distinct()
    return materialize(grown.join(joined, "label", "left").groupBy(F.col("key").alias("node")).agg(
        F.min(F.coalesce("_final", "label")).alias("label")))


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with several components: (band, key, label)."""
    named = labels.select(F.col("node").alias("key"), "label")
    labelled = materialize(members.join(named, "key", "left").select(
        "band", "key", F.coalesce("label", "key").alias("label")))
    mixed = materialize(labelled.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"))
        .filter(F.col("low") != F.col("high")).select("band"))
    return materialize(labelled.join(mixed, "band", "left_semi"))


def _ranked(members: DataFrame, labels: DataFrame, linker: _Linker) -> DataFrame:
    """(key, n, commonness, shingles) for the members of mixed buckets.

    ``shingles`` is the prefix, the rarest first; ``commonness`` the mean frequency
    of all. Shingles are ordered by how many of these members have one of the
    same cell, then by hash; the cells are a table of fixed size.
    """
    apart = _mixed(members, labels).select("key").distinct()
    texts = linker.texts.join(apart.hint("shuffle_hash"), "key", "left_semi")
    sets = materialize(map_batches(
        texts, _listed(linker.shingle), f"key {linker.kind}, hashes binary"))
    counted = map_batches(sets, _cells, "cell int, n bigint").groupBy("cell").agg(
        F.sum("n").alias("n")).toArrow()  # at most one row per cell
    table = np.zeros(CELLS, dtype=np.int64)
    table[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    shared, percent = members.sparkSession.sparkContext.broadcast(table), linker.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rarest(shared.value, percent)(batches)

    return materialize(map_batches(
        sets, run, f"key {linker.kind}, n bigint, commonness double, shingles array<bigint>"))


def _central_pairs(
    members: DataFrame, labels: DataFrame, ranked: DataFrame, linker: _Linker
) -> DataFrame:
    """Per mixed bucket, its most common member with those of other components."""
    mixed = _mixed(members, labels).join(
        ranked.groupBy("key").agg(F.max("commonness").alias("commonness")), "key")
    hubs = materialize(mixed.groupBy("band").agg(
        F.max(F.struct("commonness", "key", "label")).alias("best")).select(
        "band", F.col("best.key").alias("hub"), F.col("best.label").alias("hub_label")))
    return _pairs(mixed.join(hubs, "band").filter(F.col("label") != F.col("hub_label")), "hub", "key")


def _prefix_pairs(
    members: DataFrame, labels: DataFrame, ranked: DataFrame, linker: _Linker
) -> DataFrame:
    """Members of different components whose prefixes leave room for a link.

    At the first shingle that two sets share in the common order, at places i and j,
    they can share no more than 1 + min(n - i - 1, m - j - 1); a link needs
    ``percent`` / (100 + ``percent``) of n + m. So a row at place i can only be linked
    with sets of at least ``percent`` % of n and at most
    (n - i) * (100 + ``percent``) / ``percent`` - n shingles; sizes fall into bands, and
    the band is part of the join key, so that sets which share words too common for a link
    do not meet. Per shingle, the rows outside its most frequent component meet
    the rows of every other one.
    """
    percent = linker.percent
    apart = _mixed(members, labels).select("key", "label").distinct()
    prefixes = materialize(
        ranked.join(apart, "key").select(
            "key", "n", "label", F.posexplode("shingles").alias("place", "shingle"))
        .select("key", "label", "shingle", "n", (F.col("n") - F.col("place")).alias("room")))
    several = materialize(prefixes.groupBy("shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"))
        .filter(F.col("low") != F.col("high")).select("shingle"))
    rows = materialize(prefixes.join(several, "shingle", "left_semi"))
    major = materialize(
        rows.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("shingle").agg(F.max(F.struct("_n", "label"))["label"].alias("major")))
    few = materialize(_fitting_bands(
        rows.join(major, "shingle").filter(F.col("label") != F.col("major"))
        .select("shingle", F.col("key").alias("x"), F.col("n").alias("nx"),
                F.col("room").alias("rx"), F.col("label").alias("lx")), percent))
    met = rows.withColumn("band", _size_band(F.col("n"))).join(few, ["shingle", "band"]).filter(
        (F.col("lx") != F.col("label"))
        & (F.least("rx", "room") * (100 + percent) >= (F.col("nx") + F.col("n")) * percent))
    return _pairs(met, "x", "key")


def _size_band(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / math.log(BAND_STEP)).cast("int")


def _fitting_bands(rows: DataFrame, percent: int) -> DataFrame:
    """One row per band of the sizes that a set of ``nx`` shingles with ``rx`` left may be linked with."""
    least = F.greatest(F.ceil(F.col("nx") * percent / 100), F.lit(1))
    most = F.least(
        F.floor(F.col("rx") * (100 + percent) / percent) - F.col("nx"),
        F.floor(F.col("nx") * 100 / percent))
    return rows.withColumn("_least", least).withColumn("_most", most).filter(
        F.col("_least") <= F.col("_most")).withColumn(
        "band", F.explode(F.sequence(_size_band(F.col("_least")), _size_band(F.col("_most"))))).drop(
        "_least", "_most")


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` without those of a group's documents other than its first."""
    found = near_duplicates(docs, key, text, shingle, percent)
    gone = materialize(found.filter(~F.col("kept")).select(key).distinct())
    return docs.join(gone.hint("shuffle_hash"), key, "left_anti")
