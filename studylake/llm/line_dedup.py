r"""Removal of repeated multi-line passages.

``remove_repeated_passages`` finds them wherever they stand. Its windows are two
neighbouring lines with words (with the blank lines between them) or one line of
``long_line`` words or more; a line goes when it lies in a window whose bytes
occur at an earlier place, so a passage of two lines or more goes whole in any
context. Neighbouring lines that would go but hold fewer than ``least_words`` words
between them stay, unless they are the whole text: a brace over a brace, or "Yes."
over "No.", says nothing about where it came from. The place of a window is (doc_id, hash of the text, place in the text).

``remove_repeated_chunks`` is the coarser removal by content-defined chunks of
lines, which compares whole chunks only. A text is cut into lines at ``\n``. A hash over the ``window`` lines that end at
a line decides whether a chunk ends there, so boundaries move with the content:
an inserted line changes the chunks around it and no others. A line of
``long_line`` words or more is a passage of its own and always a chunk by itself.
Chunks of at least two lines, and long lines, are compared over all texts. Of
chunks that are equal byte for byte the first by (doc_id, place) stays, the
others are removed. Only built-in functions are used.

Both shuffle hashes first; then the texts, once, to meet the places whose hash
occurs again; at last the text of those chunks or windows alone, to be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studylake.llm.quality_rules import _BLANKS, _let, words
from studylake.session import materialize

WINDOW = 2
DIVISOR = 4
LONG_LINE = 50
LEAST_WORDS = 10

_CHUNK = "array<struct<start:int,size:int>>"
_CHUNKS, _PLACES, _UNEQUAL = "_llm_chunks", "_llm_places", "_llm_unequal"
_UNITS, _GONE = "_llm_units", "_llm_gone"
_ALL, _LATER = "_llm_all", "_llm_later"


def _split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _ends(lines: Column, window: int, divisor: int, long_line: int) -> Column:
    """0-based indices of the lines that end a chunk, the last line included."""
    def from_hashes(hashes: Column) -> Column:
        # (hash of the line, whether it is long) per line
        def rolling(i: Column) -> Column:
            return F.xxhash64(*[F.get(hashes, i - k)["h"] for k in range(window)])

        def ends(i: Column) -> Column:
            here, after = F.get(hashes, i), F.get(hashes, i + 1)
            return (
                after.isNull() | here["long"] | after["long"]
                | (F.pmod(rolling(i), F.lit(divisor)) == 0)
            )

        return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), ends)

    described = F.transform(lines, lambda line: F.struct(
        F.xxhash64(line).alias("h"), (F.size(words(line)) >= long_line).alias("long")))
    return _let(described, from_hashes)


def chunk_places(
    lines: Column, window: int = WINDOW, divisor: int = DIVISOR, long_line: int = LONG_LINE
) -> Column:
    """The chunks as structs (start, size), both in lines, in order."""
    return _let(_ends(lines, window, divisor, long_line), lambda ends: F.transform(
        ends, lambda end, k: F.struct(
            (F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 1).alias("start"),
            (end - F.coalesce(F.get(ends, k - 1), F.lit(-1))).alias("size"),
        ))).cast(_CHUNK)


def _texts(lines: Column, places: Column) -> Column:
    return F.transform(places, lambda c: F.array_join(F.slice(lines, c["start"] + 1, c["size"]), "\n"))


def with_chunks(
    docs: DataFrame, text: str = "text", name: str = "chunks",
    window: int = WINDOW, divisor: int = DIVISOR, long_line: int = LONG_LINE,
) -> DataFrame:
    """Adds ``name``: the texts of the chunks in order; joined by ``\\n`` they give the text."""
    lines = _split_lines(F.col(text))
    chunks = _let(lines, lambda ls: _texts(ls, chunk_places(ls, window, divisor, long_line)))
    return docs.withColumn(name, chunks)


def _chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _comparable(chunk: Column, long_line: int) -> Column:
    """More than one line, or one long line, and at least one word."""
    return (chunk.contains("\n") & (F.size(words(chunk)) > 0)) | (F.size(words(chunk)) >= long_line)


def remove_repeated_chunks(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    divisor: int = DIVISOR,
    long_line: int = LONG_LINE,
) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``; every row stays.

    Adds ``n_chunks`` and ``n_removed``. NULL texts stay NULL with 0 chunks, an
    empty text is one chunk that is never compared. The first of equal chunks
    is the least by (key, hash of the whole text, place), NULL keys first. Rows
    equal in key and text lose the same chunks. Other columns pass unchanged;
    ``n_chunks`` and ``n_removed`` replace columns of those names.
    """
    added = ("n_chunks", "n_removed")
    carried = [c for c in docs.columns if c not in added]
    row = F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("body"))
    cut = {"window": window, "divisor": divisor, "long_line": long_line}

    # hashes of all chunks that may be compared
    described = with_chunks(docs.filter(F.col(text).isNotNull()), text, _CHUNKS, **cut)
    light = F.filter(
        F.transform(F.col(_CHUNKS), lambda c, i: F.struct(
            _chunk_hash(c).alias("hash"), i.alias("place"), _comparable(c, long_line).alias("use"))),
        lambda x: x["use"])
    places = materialize(
        described.select(row.alias("row"), F.explode(light).alias("c"))
        .select("row.key", "row.body", "c.hash", "c.place"))
    at = F.struct("key", "body", "place")
    first = materialize(
        places.groupBy("hash").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1).select("hash", "first"))
    repeated = (
        places.join(first, "hash")
        .groupBy(F.col("key").alias("_llm_key"), F.col("body").alias("_llm_body"))
        .agg(F.collect_set(F.struct("place", "hash", (at == F.col("first")).alias("stays")))
             .alias(_PLACES)))

    # the texts meet their places in one shuffle, whatever the sizes
    whole = docs.select(*carried, F.xxhash64(F.col(text)).alias("_llm_hash"))
    known = materialize(repeated).hint("merge")
    marked = materialize(whole.join(
        known, F.col(key).eqNullSafe(F.col("_llm_key")) & (F.col("_llm_hash") == F.col("_llm_body")), "left"
    ).select(*carried, "_llm_hash", _PLACES))

    # byte comparison of every later copy with the first one
    several = with_chunks(marked.filter(F.col(_PLACES).isNotNull()), text, _CHUNKS, **cut).select(
        F.col(key).alias("key"), F.col("_llm_hash").alias("body"),
        F.explode(F.transform(F.col(_PLACES), lambda p: F.struct(
            p["hash"].alias("hash"), p["place"].alias("place"), p["stays"].alias("stays"),
            F.get(F.col(_CHUNKS), p["place"]).alias("chunk")))).alias("c")).select("key", "body", "c.*")
    kept = materialize(several.filter("stays").groupBy("hash").agg(F.min("chunk").alias("kept")))
    unequal = materialize(
        several.filter(~F.col("stays")).join(kept, "hash").filter(F.col("chunk") != F.col("kept"))
        .groupBy(F.col("key").alias("_llm_key"), F.col("body").alias("_llm_body"))
        .agg(F.collect_set("place").alias(_UNEQUAL)))  # chunks that share a 64-bit hash alone

    judged = marked.join(
        unequal, F.col(key).eqNullSafe(F.col("_llm_key")) & (F.col("_llm_hash") == F.col("_llm_body")), "left"
    ).select(*carried, _PLACES, _UNEQUAL)
    gone = F.array_except(
        F.transform(F.filter(F.col(_PLACES), lambda p: ~p["stays"]), lambda p: p["place"]),
        F.coalesce(_UNEQUAL, F.array().cast("array<int>")))
    judged = with_chunks(judged.withColumn(_UNEQUAL, gone), text, _CHUNKS, **cut)
    rest = F.array_join(F.filter(
        F.col(_CHUNKS), lambda c, i: ~F.array_contains(F.col(_UNEQUAL), i)), "\n")
    removed = F.coalesce(F.size(_UNEQUAL), F.lit(0))
    return judged.select(
        *[F.when(removed > 0, rest).otherwise(F.col(text)).alias(text)
          if c == text else F.col(c) for c in carried],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(_CHUNKS)).cast("long").alias("n_chunks"),
        removed.cast("long").alias("n_removed"),
    )


def _starts(lines: Column) -> Column:
    """0-based indices of the lines with words."""
    return F.filter(
        F.transform(lines, lambda line, i: F.when(F.ltrim(line, F.lit(_BLANKS)) != "", i)),
        lambda i: i.isNotNull())


def _units(lines: Column, starts: Column) -> Column:
    """The lines with words, each with the blank lines after it."""
    return F.transform(starts, lambda start, k: F.struct(
        F.get(lines, start).alias("line"),
        F.array_join(F.slice(
            lines, start + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - start), "\n"
        ).alias("whole")))


def _with_units(text: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the units of a text."""
    return _let(_split_lines(text), lambda ls: _let(_starts(ls), lambda st: _let(_units(ls, st), body)))


def _window(units: Column, place: Column) -> Column:
    """The text at a place: 2 k for unit k and the next line, 2 k + 1 for the line of unit k alone."""
    k = F.floor(place / 2).cast("int")
    return F.when(place % 2 == 1, F.get(units, k)["line"]).otherwise(
        F.concat_ws("\n", F.get(units, k)["whole"], F.get(units, k + 1)["line"]))


def _windows(units: Column, long_line: int) -> Column:
    """Structs (hash, place) of all windows."""
    def is_long(line: Column) -> Column:
        # so many words take that many characters and the blanks between them
        return (F.length(line) >= 2 * long_line - 1) & (F.size(words(line)) >= long_line)

    pairs = F.transform(F.slice(units, 1, F.greatest(F.size(units) - 1, F.lit(0))), lambda u, k: k * 2)
    long = F.filter(
        F.transform(units, lambda u, k: F.when(is_long(u["line"]), k * 2 + 1)), lambda p: p.isNotNull())
    return F.transform(F.concat(pairs, long), lambda p: F.struct(
        _window_hash(_window(units, p)).alias("hash"), p.alias("place")))


def _window_hash(window: Column) -> Column:
    return F.xxhash64(window)


def _long_runs(units: Column, out: Column, least_words: int) -> Column:
    """Of the units in ``out``, those in neighbouring runs of ``least_words`` words or more; all where none is left."""
    def of_sorted(sorted_out: Column) -> Column:
        starts = F.filter(sorted_out, lambda k, i: F.coalesce(F.get(sorted_out, i - 1) != k - 1, F.lit(True)))
        ends = F.filter(sorted_out, lambda k, i: F.coalesce(F.get(sorted_out, i + 1) != k + 1, F.lit(True)))
        runs = F.zip_with(starts, ends, lambda a, b: F.sequence(a, b))
        said = F.filter(runs, lambda run: F.size(words(F.array_join(
            F.transform(run, lambda k: F.get(units, k)["line"]), " "))) >= least_words)
        return F.when(F.size(sorted_out) == F.size(units), sorted_out).otherwise(F.flatten(said))

    return _let(F.array_sort(out), of_sorted)


def remove_repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", long_line: int = LONG_LINE,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``docs`` without the lines of repeated passages; every row stays.

    Adds ``n_chunks``, the lines with words, and ``n_removed``, those taken out;
    blank lines go with the line before them. A text that loses its last word
    becomes empty, NULL stays NULL with 0 chunks. The first of equal windows is the
    least by (key, hash of the whole text, place), NULL keys first, and of every
    line the first place stays; so do neighbouring lines of fewer than ``least_words``
    words, unless the whole text would go. Rows equal in key and text lose the same lines.
    Other columns pass unchanged; ``n_chunks`` and ``n_removed`` replace columns of
    those names.
    """
    added = ("n_chunks", "n_removed")
    carried = [c for c in docs.columns if c not in added]
    row = F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("body"))

    # hashes of all windows
    places = materialize(
        docs.filter(F.col(text).isNotNull())
        .select(row.alias("row"), F.explode(
            _with_units(F.col(text), lambda units: _windows(units, long_line))).alias("w"))
        .select("row.key", "row.body", "w.hash", "w.place"))
    at = F.struct("key", "body", "place")
    first = materialize(
        places.groupBy("hash").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1).select("hash", "first"))
    repeated = (
        places.join(first, "hash")
        .groupBy(F.col("key").alias("_llm_key"), F.col("body").alias("_llm_body"))
        .agg(F.collect_set(F.struct("place", (at == F.col("first")).alias("stays"))).alias(_PLACES)))

    # the texts meet their places in one shuffle, whatever the sizes
    same = F.col(key).eqNullSafe(F.col("_llm_key")) & (F.col("_llm_hash") == F.col("_llm_body"))
    whole = docs.select(*carried, F.xxhash64(F.col(text)).alias("_llm_hash"))
    known = materialize(repeated).hint("merge")
    marked = materialize(whole.join(known, same, "left").select(*carried, "_llm_hash", _PLACES))
    gone = F.transform(F.filter(F.col(_PLACES), lambda p: ~p["stays"]), lambda p: p["place"])

    # a hash whose windows differ in a byte says nothing; their texts decide
    several = marked.filter(F.col(_PLACES).isNotNull()).select(
        F.col(key).alias("key"), F.col("_llm_hash").alias("body"),
        F.explode(_with_units(F.col(text), lambda units: F.transform(F.col(_PLACES), lambda p: F.struct(
            p["place"].alias("place"), _window(units, p["place"]).alias("window"))))).alias("w")
    ).select("key", "body", "w.*", _window_hash(F.col("w.window")).alias("hash"))
    unequal = materialize(
        several.groupBy("hash").agg(F.min("window").alias("least"), F.max("window").alias("most"))
        .filter(F.col("least") != F.col("most")).select("hash"))
    judged = marked.withColumn(_GONE, gone)
    if not unequal.isEmpty():
        doubtful = materialize(several.join(unequal, "hash"))
        really = doubtful.groupBy("window").agg(F.min(at).alias("first"))
        exact = (
            doubtful.join(really, "window")
            .groupBy(F.col("key").alias("_llm_key"), F.col("body").alias("_llm_body"))
            .agg(F.collect_set("place").alias(_ALL),
                 F.collect_set(F.when(at != F.col("first"), F.col("place"))).alias(_LATER)))
        judged = judged.join(materialize(exact), same, "left").withColumn(
            _GONE, F.when(F.col(_ALL).isNull(), F.col(_GONE)).otherwise(
                F.array_union(F.array_except(_GONE, _ALL), _LATER)))

    covered = F.array_distinct(F.flatten(F.transform(F.col(_GONE), lambda p: _let(
        F.floor(p / 2).cast("int"), lambda k: F.when(p % 2 == 1, F.array(k)).otherwise(F.array(k, k + 1))))))
    # blank lines before the first unit
    head = F.regexp_extract(F.col(text), r"^(?:[ \t\x0B\f\r]*\n)*", 0)

    def left(units: Column, out: Column) -> Column:
        rest = F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(units) - 1), out),
            lambda k: F.get(units, k)["whole"]), "\n")
        return F.struct(
            F.when(F.size(out) == F.size(units), "").when(F.size(out) == 0, F.col(text))
            .otherwise(F.concat(head, rest)).alias("text"),
            F.size(units).alias("n"), F.size(out).alias("removed"))

    lost = F.size(_GONE) > 0
    n_lines = _let(_split_lines(F.col(text)), lambda ls: F.size(_starts(ls)))
    whole = F.struct(F.col(text).alias("text"), n_lines.alias("n"), F.lit(0).alias("removed"))
    cut = F.when(lost, _with_units(F.col(text), lambda units: _let(
        _long_runs(units, covered, least_words), lambda out: left(units, out))))
    # an array of one, exploded, so that no later column computes it again
    judged = judged.withColumn(_UNITS, F.explode(F.array(F.coalesce(cut, whole))))
    return judged.select(
        *[F.col(_UNITS)["text"].alias(text) if c == text else F.col(c) for c in carried],
        F.when(F.col(text).isNull(), 0).otherwise(F.col(_UNITS)["n"]).cast("long").alias("n_chunks"),
        F.col(_UNITS)["removed"].cast("long").alias("n_removed"),
    )
