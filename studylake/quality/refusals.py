"""What did not reach silver, why, and whether the books balance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studylake import schemas
from studylake.functions import columns as fx
from studylake.operators import copies, joins
from studylake.plans.silver import CleanSpec
from studylake.quality.report import one_row
from studylake.session import materialize


#: Keys fall into so many buckets by hash; in a bucket with more rows than this, keys may be hot.
_BUCKETS = 1 << 16
MOST_ROWS = 1_000_000


def _as_received(bronze: DataFrame, spec: CleanSpec) -> DataFrame:
    """The raw columns beside those that parsing replaces."""
    return bronze.withColumns({f"_raw_{c}": F.col(c) for c in schemas.RAW_COLUMNS[spec.table]})


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))


def _number_by_window(received: DataFrame, present: DataFrame, spec: CleanSpec) -> DataFrame:
    """Parsed rows with ``_found``, ``row_num`` and ``key_conflict``.

    One shuffle by key serves all three, of the rows as received; they are parsed after it.
    """
    mine, theirs = [f"_mine_{k}" for k in spec.keys], [f"_theirs_{k}" for k in spec.keys]
    keyed = spec.parse(received).select(
        *[F.col(k).alias(m) for k, m in zip(spec.keys, mine)],
        *[F.col(f"_raw_{c}").alias(c) for c in schemas.RAW_COLUMNS[spec.table]],
        "ingestion_timestamp",
    ).repartition(*mine)
    rows = spec.parse(_as_received(keyed, spec)).withColumn("_content", spec.content())
    columns = [c for c in rows.columns if c not in (*mine, "_content")]
    whole = Window.partitionBy(*mine)
    conflict = F.min("_content").over(whole) != F.max("_content").over(whole)
    numbered = rows.select(
        *mine, *columns,
        F.row_number().over(
            whole.orderBy(*copies.descending(columns, spec.keys, spec.order))
        ).cast("bigint").alias("row_num"),
        F.when(F.count(F.lit(1)).over(whole) == 1, False).otherwise(conflict).alias("key_conflict"),
    )
    known = present.select(*[F.col(k).alias(x) for k, x in zip(spec.keys, theirs)], "_found")
    same = F.lit(True)
    for m, x in zip(mine, theirs):
        same = same & (F.col(m) == F.col(x))
    return numbered.join(known, same, "left").drop(*mine, *theirs)


def _number_by_position(received: DataFrame, present: DataFrame, spec: CleanSpec) -> DataFrame:
    """As ``_number_by_window``, where a key may hold any number of rows."""
    rows = spec.parse(received)
    names = {f"_{k}": k for k in spec.keys}
    counts = copies.key_counts(rows, spec.keys)
    concerned = materialize(
        joins.lookup(counts, present, names).filter(
            F.col("_found").isNull() | (F.col("_n") > 1)
        )
    )
    met = rows.join(concerned, copies.same_key(rows, concerned, spec.keys)).drop(*names)
    return copies.number_counted(met, spec.keys, spec.order, spec.content())


def refused_rows(
    bronze: DataFrame, silver: DataFrame, spec: CleanSpec, most: int = MOST_ROWS
) -> DataFrame:
    """Bronze rows, as received, that are absent from silver or surplus copies of a key.

    Membership follows from the outcome. The reason restates the spec's rules in
    order; ``other_unspecified`` would mean that the two have drifted apart.
    Rows are shuffled once by key and numbered there. Keys in a bucket of more than
    ``most`` rows, found by a job that counts buckets, are numbered by position
    instead, which splits a hot key. ``bronze`` is read twice.
    """
    if spec.content is None:
        raise ValueError(f"{spec.table}: copies are not compared, so none is refused as such")
    raw = schemas.RAW_COLUMNS[spec.table]
    received = _as_received(bronze.select(*raw, "ingestion_timestamp"), spec)
    present = silver.select(*spec.keys).distinct().withColumn("_found", F.lit(True))
    buckets = spec.parse(received).select(_bucket(spec.keys).alias("_full"))
    full = buckets.groupBy("_full").agg(F.count(F.lit(1)).alias("_n"))
    full = materialize(full.filter(F.col("_n") > most).select("_full"))
    if full.isEmpty():
        numbered = _number_by_window(received, present, spec)
    else:
        bucketed = spec.parse(received).select(
            *[F.col(f"_raw_{c}").alias(c) for c in raw], "ingestion_timestamp",
            _bucket(spec.keys).alias("_bucket"))
        cold, hot = [
            _as_received(bucketed.join(
                F.broadcast(full), F.col("_bucket") == F.col("_full"), how).drop("_bucket"), spec)
            for how in ("left_anti", "left_semi")
        ]
        numbered = _number_by_window(cold, present, spec).unionByName(
            _number_by_position(hot, present, spec))
    lost = numbered.filter(F.col("_found").isNull() | (F.col("row_num") > 1))
    about_key = {r.reason: r.violated() for r in spec.rules if r.about_key}
    about_row = {r.reason: r.violated() for r in spec.rules if not r.about_key}
    order = {
        **about_key,
        "key_conflict": F.col("key_conflict"),
        "duplicate_key_dropped": F.col("row_num") > 1,
        **about_row,
    }
    return lost.withColumn("refusal_reason", fx.first_reason(order)).select(
        *[F.col(f"_raw_{c}").alias(c) for c in raw],
        "ingestion_timestamp", "row_num", "key_conflict", "refusal_reason",
    )


def refusal_summary(refused: DataFrame) -> DataFrame:
    return (
        refused.groupBy("refusal_reason")
        .agg(F.count(F.lit(1)).alias("rows_refused"))
        .orderBy(F.desc("rows_refused"), "refusal_reason")
    )


def top_refused(refused: DataFrame, order: Sequence[str | Column], n: int = 200) -> DataFrame:
    """The first ``n`` refused rows of an order, for correction at the source."""
    return refused.orderBy(*order).limit(n)


def refused_count(parsed: DataFrame, silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of refused rows: both tables meet as one count per key, and no row is numbered.

    A NULL key of silver stands for no row.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    sides = parsed.select(*keys, F.lit(1).alias("_n"), F.lit(False).alias("_found")).union(
        silver.select(*keys, F.lit(0), F.lit(True)))
    per_key = sides.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.max("_found").alias("_found"))
    kept = F.when(F.col("_found") & complete & (F.col("_n") > 0), 1).otherwise(0)
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - kept), F.lit(0)).alias("refused_records"))


def row_accounting(bronze: DataFrame, silver: DataFrame, refused: DataFrame) -> DataFrame:
    """Bronze must equal silver plus refused; ``refused`` is a one-row count."""
    counts = one_row(
        bronze.agg(F.count(F.lit(1)).alias("bronze_records")),
        silver.agg(F.count(F.lit(1)).alias("silver_records")),
        refused,
    )
    gap = F.col("bronze_records") - F.col("silver_records") - F.col("refused_records")
    return counts.withColumn("imbalance", gap).withColumn(
        "status", F.when(F.col("imbalance") == 0, "PASS").otherwise("FAIL")
    )


def rejected_rows(
    evaluated: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]
) -> DataFrame:
    """Silver rows that break a rule, once each, with every reason.

    The filter asks the rules, so that the reasons are put together once and not for it too.
    """
    broken = F.lit(False)
    for rule in rules.values():
        broken = broken | fx.present(rule)
    return evaluated.filter(broken).select(*keep, fx.reasons(rules).alias("reject_reasons"))
