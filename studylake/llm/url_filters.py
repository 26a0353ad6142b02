r"""URL verdicts from host and path rules and a tree of path templates per host.

Rules judge first: a rule fits its host and all subdomains where the path starts
with the rule's path, and the longest that fits wins. The urls that rules judge
are the labelled ones. Level by level, the paths of a host become templates:

- a segment that looks variable (digits, hexadecimal, a date, a long token), or
  whose siblings are nearly all distinct, becomes ``*``;
- labelled siblings whose share of blocked urls does not differ significantly
  from that of the other labelled siblings are merged into ``*`` too;
- other segments stay, and so does a branch without labels: there is nothing to
  compare it by.

A template is rejected where its smoothed share of blocked urls reaches
``purity``; the urls that no rule judges follow their template. Only built-in
functions are used. Distinct (host, path) pairs are judged once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.session import materialize

#: One group: what stands before the host; then host and path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_VARIABLE = (
    r"^(\d+|[0-9a-fA-F]{8,}|[0-9a-fA-F-]{16,}|\d{4}-\d{2}(-\d{2})?|\S{32,})(\.\w{1,5})?$"
)

PURITY = 0.9
#: Siblings are nearly all distinct from this many on, at this share of the urls.
MANY = 20
DISTINCT = 0.5
#: Two-sided 5 % point of the normal distribution.
SIGNIFICANT = 1.96


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: Mapping[str, str]) -> DataFrame:
    """Rules like ``{"net/": "block"}`` as a table (rule, verdict)."""
    return spark.createDataFrame(sorted(rules.items()), "rule string, rule_verdict string")


def _suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(
        F.slice(parts, i, F.size(parts)), "."))


def _with_rule(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds rule and rule_verdict, NULL where none fits."""
    split = rules.select(
        "rule", "rule_verdict",
        F.regexp_extract("rule", "(?s)^[^/]*", 0).alias("_domain"),
        F.regexp_extract("rule", "(?s)/.*$", 0).alias("_start"))
    fitting = (
        places.select("host", "path", F.explode(_suffixes(F.col("host"))).alias("_domain"))
        .join(split, "_domain").filter(F.startswith("path", "_start"))
        .groupBy("host", "path").agg(F.max(F.struct(
            F.length("rule").alias("size"), "rule", "rule_verdict")).alias("best")))
    fitting = materialize(fitting.select("host", "path", "best.rule", "best.rule_verdict"))
    return places.join(fitting, ["host", "path"], "left")


def _shapes(path: Column) -> Column:
    """The segments of a path, variable ones as ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike(_VARIABLE), F.lit("*")).otherwise(s))


def _past_common(tree: DataFrame, node: list[str]) -> DataFrame:
    """Every url past the segments that all unfinished urls of its node go on with.

    No branch varies there, so nothing could be merged: a node with one url is done at once.
    """
    going = F.size("_rest") > 0
    ends = materialize(tree.filter(going).groupBy(*node).agg(
        F.min("_rest").alias("least"), F.max("_rest").alias("most")))
    differ = F.array_position(F.zip_with("least", "most", lambda a, b: a.eqNullSafe(b)), False)
    common = F.when(differ > 0, differ - 1).otherwise(F.size("least")).cast("int")
    counted = ends.select(*node, common.alias("_common"))
    joined = tree.join(counted, node, "left").withColumn(
        "_common", F.when(going, F.col("_common")).otherwise(0))
    passed = F.transform(
        F.slice("_rest", F.lit(1), F.col("_common")), lambda s: F.concat(F.lit("/"), s))
    return materialize(joined.select(
        *[c for c in tree.columns if c not in ("_rest", "template")],
        F.slice("_rest", F.col("_common") + 1, F.size("_rest")).alias("_rest"),
        F.concat("template", F.array_join(passed, "")).alias("template")))


def with_templates(places: DataFrame, significant: float = SIGNIFICANT) -> DataFrame:
    """Adds ``template`` to (host, path, bad), where bad is 1, 0 or NULL (no label)."""
    known = places.columns
    tree = materialize(places.withColumn("_rest", _shapes(F.col("path")))
                       .withColumn("template", F.lit("")))
    node = ["host", "template"]
    while not tree.filter(F.size("_rest") > 0).isEmpty():
        here = _past_common(tree, node).withColumn("_segment", F.get("_rest", F.lit(0)))
        branches = materialize(
            here.filter(F.col("_segment").isNotNull()).groupBy(*node, "_segment")
            .agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("l"),
                 F.coalesce(F.sum("bad"), F.lit(0)).alias("b")))
        whole = materialize(branches.groupBy(*node).agg(
            F.count(F.lit(1)).alias("children"), F.sum("n").alias("all"),
            F.sum("l").alias("labelled"), F.sum("b").alias("blocked")))
        others, rest = F.col("labelled") - F.col("l"), F.col("blocked") - F.col("b")
        pooled = F.col("blocked") / F.nullif("labelled", F.lit(0))
        error = F.sqrt(pooled * (1 - pooled) * (
            1 / F.nullif("l", F.lit(0)) + 1 / F.nullif(others, F.lit(0))))
        gap = F.abs(F.col("b") / F.nullif("l", F.lit(0)) - rest / F.nullif(others, F.lit(0)))
        alike = (F.col("l") > 0) & (others > 0) & (gap <= error * significant)
        scattered = (F.col("children") >= MANY) & (F.col("children") > F.col("all") * DISTINCT)
        step = materialize(branches.join(whole, node).select(
            *node, "_segment",
            F.when(alike | scattered, F.lit("*")).otherwise(F.col("_segment")).alias("_step")))
        tree = materialize(here.join(step, [*node, "_segment"], "left").select(
            *known, F.slice("_rest", 2, F.greatest(F.size("_rest"), F.lit(1))).alias("_rest"),
            F.concat("template", F.coalesce(F.concat(F.lit("/"), "_step"), F.lit("")))
            .alias("template")))
    return tree.select(*known, "template")


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", purity: float = PURITY,
) -> DataFrame:
    """Adds host, path, rule, template, template_share and verdict to ``pages``.

    ``rules`` has (rule, rule_verdict), the verdicts being ``block`` and ``allow``.
    ``template_share`` is the share of blocked urls among the labelled ones of the
    template, smoothed by one blocked and one allowed. A NULL url or one without
    ``://`` has an empty host and path, which no rule fits. Rows are kept as they
    are, repeated ones too; columns of the added names are replaced.
    """
    added = ("host", "path", "rule", "template", "template_share", "verdict")
    carried = [c for c in pages.columns if c not in added]
    placed = pages.select(*carried, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    places = _with_rule(materialize(placed.select("host", "path").distinct()), rules)
    labelled = places.withColumn(
        "bad", F.when(F.col("rule_verdict") == "block", 1).when(F.col("rule").isNotNull(), 0))
    tree = with_templates(labelled)
    shares = materialize(tree.groupBy("host", "template").agg(
        ((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.count("bad") + 2)).alias("template_share")))
    judged = materialize(tree.join(shares, ["host", "template"]).select(
        "host", "path", "rule", "template", "template_share",
        F.coalesce("rule_verdict", F.when(F.col("template_share") >= purity, F.lit("block"))
                   .otherwise(F.lit("allow"))).alias("verdict")))
    return placed.join(judged, ["host", "path"]).select(*carried, *added)
