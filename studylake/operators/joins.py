"""Join shapes the layers share.

Adaptive execution splits a hot key of a sort-merge join only where both sides
come straight from a shuffle. A side that was just aggregated by the join key has
no such shuffle. ``lookup`` therefore compares null-safe: that partitions both
sides anew, and the grouped side is small next to the rows it serves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    gate: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """LEFT JOIN to a frame with one row per key; a NULL key finds nothing.

    With ``how="inner"`` rows that find nothing are left out.

    ``on`` names the key columns, or maps left to right columns. ``gate`` is a
    further condition on the left row. All columns of the left side stay, and
    those of the right side except its key.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    keyed = right.dropna(subset=list(pairs.values())).select(
        *[F.col(theirs).alias(f"_key_{theirs}") for theirs in pairs.values()],
        *[c for c in right.columns if c not in pairs.values()],
    )
    condition = F.lit(True) if gate is None else gate
    for mine, theirs in pairs.items():
        condition = condition & left[mine].eqNullSafe(keyed[f"_key_{theirs}"])
    return left.join(keyed, condition, how).drop(
        *[f"_key_{theirs}" for theirs in pairs.values()]
    )


def flag_matches(
    left: DataFrame, right: DataFrame, on: Sequence[str], flag: str
) -> DataFrame:
    """``left`` with ``flag`` true where ``right`` holds the key, else NULL."""
    return lookup(left, right.select(*on).distinct().withColumn(flag, F.lit(True)), on)


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a NULL key has none."""
    return child.join(parent.select(*on), list(on), "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows that have a parent."""
    return child.join(parent.select(*on), list(on), "left_semi")


def orphan_count(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Number of orphans, counted per key before the join so that a hot key is one row."""
    per_key = child.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return orphans(per_key, parent, on).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")
    )
