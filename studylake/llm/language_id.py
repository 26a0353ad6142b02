"""Language of a text by interpolated Kneser-Ney character models.

A model per language gives the probability of each character of a word after the
characters before it in the word, up to ``ORDER - 1``, word start and end included.
The highest order uses counts, lower ones the number of different characters
seen before; every order is discounted and interpolated with the next lower one,
down to a uniform choice among ``CHARACTERS``. Models lie in sorted arrays of
n-gram hashes with one column per language. A text goes to the language with the
lowest cross-entropy per character. It is rejected, by a flag, where that lies
above what is usual for the language's own training texts.

Models are fitted on a sample of at most about ``SAMPLE_ROWS`` rows per language,
drawn by hash; this bounds them and their broadcast. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.llm.shipping import map_batches
from studylake.llm.words import blocks, mix
from studylake.session import materialize

ORDER = 4
SAMPLE_ROWS = 2000
CHARACTERS = 4096
MEMORY = 300_000
UNKNOWN = "und"
#: Standard deviations above the mean cross-entropy at which a text is rejected.
REJECT_ABOVE = 4.0

_LETTER = re.compile(r"[^\W\d_]")
_START, _STOP = "\x02", "\x03"
_FIXED = 1 << 20


def grams(points: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each place, for n = 1 to ``order``."""
    points = points.astype(np.uint64)
    out = [mix(points + np.uint64(0x9E3779B97F4A7C15))]
    for n in range(2, order + 1):
        longer = np.zeros_like(points)
        longer[1:] = mix(out[-1][:-1] * np.uint64(0xD6E8FEB86659FD93) + points[1:] + np.uint64(n))
        out.append(longer)
    return out


def _spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the marked words, the place in its word of each, and word starts."""
    text = "".join(f"{_START}{w}{_STOP}" for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    return points, np.arange(len(points)) - np.repeat(starts, sizes), starts


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return places, keys[places] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass
class Model:
    """Sorted hash arrays per order: discounted shares of n-grams, weights after contexts."""

    languages: list[str]
    shares: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    weights: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    limits: np.ndarray | None = None

    def bits(self, words: list[str]) -> np.ndarray:
        """Cost of each word in bits, per language."""
        points, place, starts = _spelled(words)
        hashes = grams(points, len(self.shares))
        chance = np.full((len(points), len(self.languages)), 1 / CHARACTERS)
        for n, (keys, share) in enumerate(self.shares, start=1):
            inside = np.flatnonzero(place >= max(n - 1, 1))
            own, hit = _found(keys, hashes[n - 1][inside])
            lower = chance[inside]
            contexts, weight = self.weights[n - 1]
            if n == 1:
                factor = np.broadcast_to(weight[0], lower.shape)
            else:
                at, known = _found(contexts, hashes[n - 2][inside - 1])
                factor = np.where(known[:, None], weight[at], 1.0) if len(contexts) else 1.0
            chance[inside] = np.where(hit[:, None], share[own], 0.0) + factor * lower \
                if len(keys) else lower
        cost = -np.log2(chance)
        cost[place == 0] = 0
        return np.add.reduceat(cost, starts, axis=0)


def _words(text: str) -> list[str]:
    return text.lower().split()


def _counted(order: int):
    """(lang, word, n) to (lang, size, gram, n): the n-grams of every word, by their strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for lang, word, n in zip(*[batch.column(c).to_pylist() for c in ("lang", "word", "n")],
                                     strict=True):
                spelled = f"{_START}{word}{_STOP}"
                for end in range(2, len(spelled) + 1):
                    for start in range(max(0, end - order), end):
                        gram = lang, spelled[start:end]
                        found[gram] = found.get(gram, 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()),
                 pa.array([k[1] for k in found], pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "gram", "n"])
    return run


def sample(train: DataFrame, text: str, lang: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(lang, text): about ``rows`` rows per language at most, chosen by the row's hash."""
    usable = train.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
                          F.xxhash64(*train.columns).alias("draw")).dropna(subset=["lang", "text"])
    sizes = materialize(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")))
    drawn = usable.join(sizes, "lang").filter(
        F.pmod("draw", F.lit(_FIXED)) * F.col("_n") < rows * _FIXED)
    return drawn.select("lang", "text")


def fit(
    train: DataFrame, text: str = "text", lang: str = "lang",
    order: int = ORDER, sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Models of the languages in ``lang``; rows with a NULL text or language are left out.

    The number of languages is taken to be small: one row each comes to the driver,
    as do the n-grams of the sample.
    """
    drawn = materialize(sample(train, text, lang, sample_rows))
    words = (
        drawn.select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))
        .filter(F.col("word") != "").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    counted = map_batches(words, _counted(order), "lang string, gram string, n bigint").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    model = Model(languages)
    column = table["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    names, counts = table["gram"].to_numpy(), table["n"].to_numpy().astype(float)
    sizes = table["gram"].str.len().to_numpy()
    by_size = {n: {} for n in range(1, order + 1)}
    for gram, size, lang_at, count in zip(names, sizes, column, counts, strict=True):
        by_size[size][lang_at, gram] = count
    for n in range(1, order + 1):
        model.shares.append(_empty(len(languages)))
        model.weights.append(_empty(len(languages)))
        if languages:
            used = _kneser_ney(by_size[n], by_size.get(n + 1))
            model.shares[-1], model.weights[-1] = _interpolated(used, len(languages), n)
    if languages:
        model.limits = _limits(drawn, model)
    return model


def _empty(width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.empty(0, np.uint64), np.empty((0, width))


def _kneser_ney(own: dict, longer: dict | None) -> dict:
    """Counts at the highest order and at word starts, else numbers of characters before."""
    if longer is None:
        return own
    before: dict = {}
    for lang, gram in longer:
        key = lang, gram[1:]
        before[key] = before.get(key, 0) + 1
    return {k: float(c if k[1][0] == _START else before.get(k, 0)) for k, c in own.items()}


def _hash_of(strings: list[str], n: int) -> np.ndarray:
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return grams(points, n)[n - 1][n - 1::n]


def _interpolated(counts: dict, width: int, n: int):
    """(hashes, discounted shares) of n-grams and (hashes, weights) of their contexts."""
    rows = [(lang, gram, c) for (lang, gram), c in counts.items() if c > 0]
    langs = np.array([r[0] for r in rows])
    value = np.array([r[2] for r in rows])
    strings, at = np.unique([r[1] for r in rows], return_inverse=True)
    contexts, after = np.unique([s[:-1] for s in strings], return_inverse=True)
    discount = np.empty(width)
    for k in range(width):
        ones, twos = ((value == c) & (langs == k) for c in (1, 2))
        discount[k] = max(ones.sum(), 1) / (max(ones.sum(), 1) + 2 * max(twos.sum(), 1))
    total, kinds = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
    np.add.at(total, (after[at], langs), value)
    np.add.at(kinds, (after[at], langs), 1)
    share = np.zeros((len(strings), width))
    share[at, langs] = np.maximum(value - discount[langs], 0) / total[after[at], langs]
    with np.errstate(invalid="ignore", divide="ignore"):
        weight = np.where(total > 0, discount * kinds / total, 1.0)
    # what the discount cannot take from counts below it stays with the n-gram
    weight = np.minimum(weight, 1.0)
    keys = _hash_of(list(strings), n)
    order = np.argsort(keys)
    if n == 1:
        return (keys[order], share[order]), (np.zeros(1, np.uint64), weight)
    above = _hash_of(list(contexts), n - 1)
    upward = np.argsort(above)
    return (keys[order], share[order]), (above[upward], weight[upward])


class _Scorer:
    """Bits of texts, with the costs of recent words at hand, at most ``MEMORY``."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.costs = np.empty((0, len(model.languages)))

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per language, characters) of texts given as words."""
        if len(self.place) > MEMORY:
            self.place, self.costs = {}, self.costs[:0]
        new = list({w for words in texts for w in words}.difference(self.place))
        if new:
            self.costs = np.vstack([self.costs, self.model.bits(new)])
            self.place.update((w, i) for i, w in enumerate(new, start=len(self.place)))
        bits = np.zeros((len(texts), len(self.model.languages)))
        sizes = np.zeros(len(texts))
        for i, words in enumerate(texts):
            if words:
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                bits[i] = self.costs[at].sum(axis=0)
                sizes[i] = sum(map(len, words)) + len(words)
        return bits, sizes


def _judged(shared, names: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        scorer = _Scorer(model)
        for batch in batches:
            for block in blocks(batch, text):
                texts = block.column(text).to_pylist()
                texts = [_words(t) if t and _LETTER.search(t) else [] for t in texts]
                langs, scores, entropies, rejected = [], [], [], []
                if model.languages:
                    bits, sizes = scorer(texts)
                for i, words in enumerate(texts):
                    if not words or not model.languages:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        entropies.append(None)
                        rejected.append(True)
                        continue
                    best = int(bits[i].argmin())
                    odds = np.exp2(np.maximum(bits[i][best] - bits[i], -1000.0))
                    langs.append(model.languages[best])
                    scores.append(float(1 / odds.sum()))
                    entropies.append(float(bits[i][best] / sizes[i]))
                    rejected.append(model.limits is not None
                                    and entropies[-1] > float(model.limits[best]))
                yield pa.RecordBatch.from_arrays(
                    [*[block.column(c) for c in names], pa.array(langs, pa.string()),
                     pa.array(scores, pa.float64()), pa.array(entropies, pa.float64()),
                     pa.array(rejected, pa.bool_())],
                    names=[*names, "lang_pred", "score", "entropy", "rejected"])
    return run


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score, entropy and rejected to ``docs``; only ``text`` is looked at.

    ``lang_pred`` is a learned language, or ``und`` for a NULL text or one without a
    letter (score 0, rejected). ``score`` is the probability of that language
    among the learned ones, ``entropy`` its bits per character. Columns of the added names are replaced.
    """
    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "entropy": T.DoubleType(),
             "rejected": T.BooleanType()}
    carried = [f for f in docs.schema.fields if f.name not in added]
    schema = T.StructType([*carried, *[T.StructField(n, k) for n, k in added.items()]])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_batches(docs, _judged(shared, [f.name for f in carried], text), schema)


def _limits(drawn: DataFrame, model: Model) -> np.ndarray:
    """The cross-entropy per language above which a text is rejected."""
    found = predict(drawn, model).filter(F.col("lang_pred") == F.col("lang")).groupBy("lang").agg(
        F.avg("entropy").alias("mean"), F.coalesce(F.stddev_pop("entropy"), F.lit(0.0)).alias("sd"))
    by_lang = {r["lang"]: r["mean"] + REJECT_ABOVE * r["sd"] for r in found.collect()}
    return np.array([by_lang.get(x, np.inf) for x in model.languages])
