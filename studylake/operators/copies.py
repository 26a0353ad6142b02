"""Several rows per key: keep the latest, count them, number them, find conflicts.

None of these puts all rows of a key into one task: keeping and counting use
aggregates that combine before the shuffle, and numbering uses a range shuffle
that splits a large key by its order columns.

``latest_per_key`` and ``keep_agreeing_latest`` are one aggregate over whole rows.
``latest_by_key_facts`` and ``agreeing_by_key_facts`` give the same rows, but learn
from the keys alone which of them have copies, so that other rows never move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.operators.ranking import with_position
from studylake.session import materialize


def _order_fields(
    columns: Sequence[str], keys: Sequence[str], order: Sequence[str]
) -> list[str]:
    """Order columns followed by every other column, so that the order is total."""
    return [*order, *[c for c in columns if c not in keys and c not in order]]


#: Types whose greatest value a hash aggregate can hold.
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _numbers_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys, numbers before texts: rows are sorted by them, and texts share long prefixes."""
    return sorted(keys, key=lambda k: not isinstance(df.schema[k].dataType, _FIXED_WIDTH))


def descending(columns: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """The total order, newest first, in which copies of a key are numbered."""
    return [F.col(c).desc_nulls_last() for c in _order_fields(columns, keys, order)]


def collapse_copies(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fingerprint: Column | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: its greatest row by ``order`` (descending, NULLs last).

    ``columns`` are kept (default all) and break ties in their order. Adds
    ``n_copies`` and, with ``fingerprint``, ``key_conflict``: whether the copies
    disagree. One shuffle, combined before it.
    """
    columns = df.columns if columns is None else list(columns)
    fields = _order_fields(columns, keys, order)
    aggregates = [
        F.max(F.struct(*fields)).alias("_best"),
        F.count(F.lit(1)).alias("n_copies"),
    ]
    if fingerprint is not None:
        df = df.withColumn("_content", fingerprint)
        aggregates.append((F.min("_content") != F.max("_content")).alias("key_conflict"))
    grouped = df.groupBy(*_numbers_first(df, keys)).agg(*aggregates)
    flags = [c for c in grouped.columns if c not in keys and c != "_best"]
    payload = [F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in columns]
    return grouped.select(*payload, *flags)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key, with a repeatable survivor under ties."""
    return collapse_copies(df, keys, order).select(*df.columns)


def keep_agreeing_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fingerprint: Column,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of each key whose copies agree; other keys are refused whole."""
    columns = df.columns if columns is None else list(columns)
    kept = collapse_copies(df, keys, order, fingerprint, columns)
    return kept.filter(~F.col("key_conflict")).select(*columns)


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, NULL equal to NULL; the right side's are named ``_<key>``."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"_{k}"])
    return condition


#: Share of rows with a repeated key from which one aggregate over whole rows costs less.
MANY_COPIES = 0.5


def _repeated_keys(
    df: DataFrame, keys: Sequence[str], moment: str | None, content: Column | None
) -> tuple[DataFrame, bool]:
    """Facts about keys with several rows, written, and whether such rows are many.

    The keys are renamed to ``_<key>``. ``_n`` counts the rows, ``_best`` is the greatest
    ``moment``, ``_low`` and ``_high`` are the extremes of the content's 64-bit hash; all have a
    fixed width, so a hash aggregate combines them before the shuffle and sorts nothing.
    """
    facts = [F.count(F.lit(1)).alias("_n")]
    if moment is not None:
        facts.append(F.max(moment).alias("_best"))
    if content is not None:
        hashed = F.when(content.isNotNull(), F.xxhash64(content))
        facts += [F.min(hashed).alias("_low"), F.max(hashed).alias("_high")]
    counted = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*facts)
    repeated = materialize(counted.filter(F.col("_n") > 1))
    several = repeated.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return repeated, several > 0 and several > MANY_COPIES * df.count()


def latest_by_key_facts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` where most keys have one row: such rows are read, not moved.

    Starts a job: the repeated keys and their greatest first order column are written from the
    narrow columns. Their table has a known size, so it is broadcast where it is small and shuffled where
    it is not. Of a repeated key only the rows with that greatest value are aggregated. ``df`` is read
    again after that job. Where more than ``MANY_COPIES`` of the rows have copies, it is
    ``latest_per_key``.
    """
    moment = order[0] if isinstance(df.schema[order[0]].dataType, _FIXED_WIDTH) else None
    repeated, many = _repeated_keys(df, keys, moment, None)
    if many:
        return latest_per_key(df, keys, order)
    same = same_key(df, repeated, keys)
    newest = same if moment is None else same & df[moment].eqNullSafe(repeated["_best"])
    latest = latest_per_key(df.join(repeated, newest, "left_semi"), keys, order)
    return df.join(repeated, same, "left_anti").unionByName(latest)


def agreeing_by_key_facts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fingerprint: Column,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``keep_agreeing_latest`` where most keys have one row: such rows are read, not moved.

    As ``latest_by_key_facts``. Copies whose content hashes differ disagree for certain, so their rows
    are left where they are; where the hashes agree, the texts themselves are compared.
    """
    columns = df.columns if columns is None else list(columns)
    repeated, many = _repeated_keys(df, keys, None, fingerprint)
    if many:
        return keep_agreeing_latest(df, keys, order, fingerprint, columns)
    singles = df.filter(fingerprint.isNotNull())
    singles = singles.join(repeated, same_key(singles, repeated, keys), "left_anti").select(*columns)
    likely = repeated.filter(F.col("_low") == F.col("_high"))
    several = df.join(likely, same_key(df, likely, keys), "left_semi")
    return singles.unionByName(keep_agreeing_latest(several, keys, order, fingerprint, columns))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as ``_n``, keys renamed to ``_<key>``."""
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n")
    )


def with_key_occurrences(
    df: DataFrame, keys: Sequence[str], name: str = "key_occurrences"
) -> DataFrame:
    """Add the number of rows that share the key, NULL keys counting as one key.

    Only repeated keys are joined back. They are written by a job of their own, so their
    size is known when the wide rows are planned: few of them are broadcast, and the
    rows are not shuffled.
    """
    repeated = materialize(key_counts(df, keys).filter(F.col("_n") > 1))
    return df.join(repeated, same_key(df, repeated, keys), "left").select(
        *[df[c] for c in df.columns],
        F.coalesce(F.col("_n"), F.lit(1)).alias(name),
    )


def number_counted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fingerprint: Column | None = None,
    count: str = "_n",
) -> DataFrame:
    """``number_copies`` for rows that already carry the row count of their key.

    Keys with one row get 1 at once. Rows of repeated keys are placed in one
    global order; their number is the distance to the first position of the key.
    """
    columns, content = [c for c in df.columns if c != count], "_content"
    compared = fingerprint is not None
    singles = df.filter(F.col(count) == 1).select(
        *columns,
        F.lit(1).cast("bigint").alias("row_num"),
        *([F.lit(False).alias("key_conflict")] if compared else []),
    )
    several = df.filter(F.col(count) > 1)
    if compared:
        several = several.withColumn(content, fingerprint)
    ordering = [F.col(k).asc() for k in keys] + descending(columns, keys, order)
    placed = with_position(several.drop(count), ordering, name="_position", ties=True)
    starts = placed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min("_position").alias("_start"),
        *([(F.min(content) != F.max(content)).alias("key_conflict")] if compared else []),
    )
    numbered = placed.join(starts, same_key(placed, starts, keys)).select(
        *columns,
        (F.col("_position") - F.col("_start") + 1).alias("row_num"),
        *(["key_conflict"] if compared else []),
    )
    return singles.unionByName(numbered)


def number_copies(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fingerprint: Column | None = None,
) -> DataFrame:
    """Add ``row_num`` within each key and, with ``fingerprint``, ``key_conflict``.

    Equals ROW_NUMBER over the key by ``order`` descending, with every further
    column as tie-break, but no task holds the rows of one key.
    """
    counted = with_key_occurrences(df, keys, "_n")
    return number_counted(counted, keys, order, fingerprint)
