r"""Quality rules as a short-circuit cascade, on built-in functions only.

Each rule is a condition that rejects a text. A bounded sample gives its cost
(time to evaluate it alone) and its selectivity (share rejected); the rules are
then tried in the order of rejections per cost, and the first that fires ends
the work for that text. The order changes cost only: a text is kept exactly
when no rule fires.

Words are runs of ``[^\x20\x09-\x0D]``. A null text counts as an empty one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that ends a word, without the blank itself.
_SPACES = ("\t", "\n", "\x0b", "\x0c", "\r")
_SYMBOLS = "[#*$%&|<>]"
_BLANKS = " \t\n\x0b\x0c\r"
_CAPITAL = "[A-Z]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _replaced(text: Column, parts: Sequence[str], by: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(by))
    return text


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(_replaced(text, _SPACES, " "), " "), "")


def word_chars(text_words: Column) -> Column:
    """Code points inside words."""
    return F.length(F.array_join(text_words, "")).cast("long")


def symbol_count(text: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    return F.regexp_count(text, F.lit(_SYMBOLS)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.ltrim(line, F.lit(_BLANKS)) != "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _let(
        lines_with_words(text),
        lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    )


def _covered(hashes: Column, width: int) -> Column:
    """Words inside the windows whose hash occurs twice or more.

    Windows are sorted by (hash, place) so that equal ones are neighbours; the
    places found are sorted, and each adds the words up to the next one.
    """
    def places(ordered: Column) -> Column:
        def repeated(item: Column, k: Column) -> Column:
            return F.coalesce(F.get(ordered, k - 1)["h"] == item["h"], F.lit(False)) | F.coalesce(
                F.get(ordered, k + 1)["h"] == item["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, repeated), lambda item: item["i"]))

    def total(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda x, k: F.least(F.lit(width), F.coalesce(F.get(starts, k + 1) - x, F.lit(width))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _let(F.sort_array(placed), lambda ordered: _let(places(ordered), total))


def repeated_words(text_words: Column, doublings: int = 3) -> Column:
    """Words in windows of ``2 ** doublings`` words found twice or more in the text.

    The hash of a window joins the hashes of its halves. Half windows that are
    all distinct settle the matter, as they do in most texts.
    """
    width, none = 2 ** doublings, F.lit(0).cast("long")

    def distinct(hashes: Column) -> Column:
        return F.size(F.array_distinct(hashes)) == F.size(hashes)

    def doubled(hashes: Column, span: int) -> Column:
        shifted = F.slice(hashes, F.lit(1 + span), F.size(hashes))
        heads = F.slice(hashes, F.lit(1), F.size(hashes) - span)
        return F.zip_with(heads, shifted, lambda a, b: F.xxhash64(a, b))

    def whole(found: Column) -> Column:
        return F.when(distinct(found), none).otherwise(_covered(found, width))

    def windows(hashes: Column, span: int) -> Column:
        if 2 * span < width:
            return _let(doubled(hashes, span), lambda longer: windows(longer, 2 * span))
        return F.when(distinct(hashes), none).otherwise(_let(doubled(hashes, span), whole))

    return F.when(F.size(text_words) <= width, none).otherwise(
        _let(F.transform(text_words, lambda w: F.xxhash64(w)), lambda hashes: windows(hashes, 1)))


def adjacent_repeats(text_words: Column) -> Column:
    """Words that equal the word just before them."""
    return _let(text_words, lambda w: F.size(F.filter(
        F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: a == b),
        lambda same: F.coalesce(same, F.lit(False)))))


class Text:
    """What rules may ask of a text, each computed only where it is asked for.

    ``known`` names columns that hold a value already.
    """

    def __init__(self, text: Column, known: Mapping[str, Column] | None = None):
        self.text = text
        self._known = dict(known or {})

    def _value(self, name: str, make: Callable[[], Column]) -> Column:
        return self._known.get(name) if name in self._known else make()

    @property
    def words(self) -> Column:
        return self._value("words", lambda: words(self.text))

    @property
    def n_words(self) -> Column:
        return self._value("n_words", lambda: F.size(self.words).cast("long"))

    @property
    def word_chars(self) -> Column:
        return self._value("word_chars", lambda: word_chars(self.words))

    @property
    def n_symbols(self) -> Column:
        return self._value("n_symbols", lambda: symbol_count(self.text))

    @property
    def n_dup_lines(self) -> Column:
        return self._value("n_dup_lines", lambda: duplicate_lines(self.text))

    @property
    def n_repeat_words(self) -> Column:
        return self._value("n_repeat_words", lambda: _let(self.words, repeated_words))

    @property
    def n_lines(self) -> Column:
        return F.size(lines_with_words(self.text)).cast("long")

    @property
    def n_capitals(self) -> Column:
        return F.regexp_count(self.text, F.lit(_CAPITAL)).cast("long")

    @property
    def n_adjacent(self) -> Column:
        return _let(self.words, adjacent_repeats)


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    They replace columns of those names.
    """
    body, found = F.coalesce(F.col(text), F.lit("")), "_llm_words"
    known = Text(body, {"words": F.col(found)})
    return docs.drop(*STATISTICS).withColumn(found, words(body)).withColumns(
        {name: getattr(known, name) for name in STATISTICS}
    ).drop(found)


@dataclass(frozen=True)
class Rule:
    """A named condition that rejects a text; it must never be NULL."""

    name: str
    rejects: Callable[[Text], Column]


def _above(part: Column, percent: int, whole: Column) -> Column:
    return part * 100 > whole * percent


#: The rules in production; each reads the text alone.
RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: _above(t.n_repeat_words, 30, t.n_words)),
    Rule("symbols", lambda t: _above(t.n_symbols, 5, t.word_chars)),
    Rule("capitals", lambda t: _above(t.n_capitals, 40, t.word_chars)),
    Rule("duplicate_lines", lambda t: (t.n_dup_lines > 0) & _above(t.n_dup_lines, 50, t.n_lines)),
    Rule("stutter", lambda t: _above(t.n_adjacent, 20, t.n_words)),
)


def order_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 500
) -> list[Rule]:
    """``rules`` by rejections per cost on the first ``sample_rows`` rows, best first.

    Only as many partitions are read as hold those rows. Cost is the time of one
    job that evaluates the rule alone. Ties and empty samples leave the given order.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(body.alias(text)).limit(sample_rows).collect()
    if not rows:
        return list(rules)
    sample = docs.sparkSession.createDataFrame(rows, T.StructType([T.StructField(text, T.StringType())]))
    gains = {}
    for rule in rules:
        rejected = F.count(F.when(rule.rejects(Text(F.col(text))), 1))
        start = time.perf_counter()
        found = sample.agg(rejected).first()[0]
        gains[rule.name] = found / max(time.perf_counter() - start, 1e-6)
    return sorted(rules, key=lambda rule: -gains[rule.name])


def with_verdict(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = 500,
    name: str = "rejected_by",
    known: Sequence[str] = (),
) -> DataFrame:
    """Adds ``name``: the first rule of the cascade that rejects the text, else NULL.

    Input columns stay as they are; ``name`` replaces a column of that name.
    ``known`` lists statistics that ``docs`` already holds, as ``with_statistics``
    names them; rules read those instead of computing them again.
    NULL and empty texts have no words and fall to ``few_words``.
    """
    body = Text(F.coalesce(F.col(text), F.lit("")), {c: F.col(c) for c in known})
    ordered = order_rules(docs, rules, text, sample_rows)
    verdict = F.coalesce(*[F.when(rule.rejects(body), F.lit(rule.name)) for rule in ordered]) \
        if ordered else F.lit(None).cast("string")
    return docs.withColumn(name, verdict)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows whose text no rule rejects, with their columns unchanged."""
    verdict = "_llm_rejected_by"
    return with_verdict(docs, rules, text, name=verdict).filter(F.col(verdict).isNull()).drop(verdict)
