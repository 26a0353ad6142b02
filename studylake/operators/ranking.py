"""Exact global positions and NTILE without gathering rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.session import materialize

_ROW_BITS = 33  # fixed by monotonically_increasing_id: partition above, row below


def with_position(
    df: DataFrame,
    ordering: Sequence[Column],
    name: str = "position",
    total: str | None = None,
    ties: bool = False,
) -> DataFrame:
    """Add the 0-based rank of each row in the total order ``ordering``.

    One range shuffle puts the rows in order across partitions, and a key that
    holds any share of the rows is split wherever the later order columns
    differ. Rows that may be equal in all of them need ``ties``: every row then
    gets an id, written before use, as the last order column, so that even a
    third of all rows being one row repeated is split.

    The stamped rows are written once because partition numbers must not change
    between counting and ranking. What is gathered afterwards is one count per
    partition, so both the single-task sum and the broadcast are bounded by the
    number of shuffle partitions.
    """
    stamp, part, offset, whole, row_id = "_stamp", "_part", "_offset", "_whole", "_row_id"
    columns = df.columns
    if ties:
        df = materialize(df.withColumn(row_id, F.monotonically_increasing_id()))
        ordering = [*ordering, F.col(row_id).asc()]
    stamped = materialize(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .select(*columns, F.monotonically_increasing_id().alias(stamp))
    )
    part_of = F.shiftright(F.col(stamp), _ROW_BITS)
    row_of = F.col(stamp).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = stamped.groupBy(part_of.alias(part)).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(part).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        part,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(offset),
        F.sum("_n").over(everything).alias(whole),
    )
    extra = [F.col(whole).alias(total)] if total else []
    return (
        stamped.withColumn(part, part_of)
        .join(F.broadcast(offsets), part)
        .select(*columns, (F.col(offset) + row_of).alias(name), *extra)
    )


def ntile_bucket(position: Column, total: Column, buckets: int) -> Column:
    """NTILE number of a 0-based position: the first buckets take the remainder."""
    size = F.floor(total / buckets)
    larger = total % buckets
    boundary = larger * (size + 1)
    return (
        F.when(position < boundary, F.floor(position / (size + 1)) + 1)
        .otherwise(larger + F.floor((position - boundary) / F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def with_ntile(
    df: DataFrame, buckets: int, ordering: Sequence[Column], name: str = "ntile"
) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY ordering)`` as a distributed job.

    ``ordering`` must be a total order for the result to be repeatable.
    """
    placed = with_position(df, ordering, name="_position", total="_total")
    bucket = ntile_bucket(F.col("_position"), F.col("_total"), buckets)
    return placed.select(*df.columns, bucket.alias(name))


#: Borders that split the rows between two known borders in one pass, and the rows that need no more passes.
_BORDERS = 63
_FEW = 50_000
#: Passes after which rows count as equal; a total order needs six for 10 ** 14 rows.
_DEEP = 40


def _literal(row: Row, fields: Sequence[T.StructField]) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def _bin(row: Column, borders: Sequence[Column], first: int = 0) -> Column:
    """How many of the ascending ``borders`` lie below ``row``, by halving."""
    if not borders:
        return F.lit(first)
    middle = len(borders) // 2
    return F.when(row <= borders[middle], _bin(row, borders[:middle], first)).otherwise(
        _bin(row, borders[middle + 1:], first + middle + 1))


def _first_ranks(total: int, buckets: int) -> list[int]:
    """The 0-based rank at which each bucket after the first begins, where it has rows."""
    size, larger = divmod(total, buckets)
    return [r for b in range(1, buckets) if (r := b * size + min(b, larger)) < total]


def _fetch(parts: Sequence[tuple[int, DataFrame, int]], order: Sequence[str]) -> dict[int, tuple[Row, bool]]:
    """Per (rank, part, rank within it): the row, and whether the one before it in the part is equal."""
    found = None
    for rank, part, inside in parts:
        rows = part.orderBy(*order).offset(max(inside - 1, 0)).limit(2 if inside else 1).select(
            F.lit(rank).alias("rank"), F.struct(*order).alias("row"))
        found = rows if found is None else found.unionByName(rows)
    taken: dict[int, list[Row]] = {}
    for r in found.orderBy("rank", "row").collect() if found is not None else []:
        taken.setdefault(r["rank"], []).append(r["row"])
    return {rank: (rows[-1], len(rows) == 2 and rows[0] == rows[1]) for rank, rows in taken.items()}


def _rows_at(
    df: DataFrame, order: Sequence[str], ranks: Sequence[int], total: int, few: int
) -> list[tuple[Row, bool]] | None:
    """The rows of ``df`` (the order columns alone) at the given ranks, and whether the one before is equal.

    The rows between two known borders are split by borders drawn from them (those whose hash is
    least) and counted per part; the part that holds a rank is split in turn, until it has few rows.
    A pass multiplies the parts by up to ``_BORDERS``; ranks in the same part share it. The answer is
    None where a part cannot be split because its rows are equal.
    """
    fields, me = df.schema.fields, F.struct(*order)
    small: list[tuple[int, DataFrame, int]] = []
    waiting = [(None, None, 0, total, list(ranks), 0)]
    while waiting:
        low, high, below, size, asked, depth = waiting.pop()
        part = df
        if low is not None:
            part = part.filter(me > _literal(low, fields))
        if high is not None:
            part = part.filter(me <= _literal(high, fields))
        if size <= few:
            small += [(r, part, r - below) for r in asked]
            continue
        drawn = part.distinct() if depth > 2 else part
        drawn = drawn.orderBy(F.xxhash64(F.lit(depth), *order)).limit(min(_BORDERS, 3 + 3 * size // few))
        borders = drawn.agg(F.array_sort(F.collect_set(me))).first()[0]
        if depth > _DEEP or (depth > 2 and borders == [high]):
            return None
        counted = dict(part.groupBy(_bin(me, [_literal(b, fields) for b in borders]).alias("bin")).agg(
            F.count(F.lit(1))).collect())
        edges = [low, *borders, high]
        for place in range(len(borders) + 1):
            n = counted.get(place, 0)
            inside = [r for r in asked if below <= r < below + n]
            if inside:
                waiting.append((edges[place], edges[place + 1], below, n, inside, depth + 1))
            below += n
    found = _fetch(small, order)
    return [found[r] for r in ranks]


def with_ntile_by_selection(
    df: DataFrame, buckets: int, order: Sequence[str], name: str = "ntile", few: int = _FEW
) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order)`` (ascending, NULL first) without moving a row.

    The first row of every bucket after the first is selected by narrowing histograms over the order
    columns, all of them compared as one, so a value that many rows share is split by the columns after it.
    Each pass reads the order columns alone and brings at most ``_BORDERS`` rows to the driver. A row's
    bucket is then a comparison with those first rows. Where the order is not total and a bucket begins
    among equal rows, rows are placed by ``with_ntile`` instead. ``df`` is read several times.
    """
    keys = df.select(*order)
    total = keys.count()
    cuts = _rows_at(keys, order, _first_ranks(total, buckets), total, few)
    if cuts is None or any(tied for _, tied in cuts):
        return with_ntile(df, buckets, [F.col(c).asc_nulls_first() for c in order], name)
    bucket, me = F.lit(1), F.struct(*order)
    for row, _ in cuts:
        bucket = bucket + (me >= _literal(row, keys.schema.fields)).cast("int")
    return df.withColumn(name, bucket.cast("int"))
