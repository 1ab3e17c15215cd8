"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: compatibility forms and accents go, look-alike letters of other alphabets and digit or sign
substitutions become Latin letters, everything else is a space. The lexicon holds whole words and word beginnings with
their log-odds; a match that lies inside an exception phrase does not count. The summed weight is normalised by the
length of the text and turned into a probability.

The lexicon, the exceptions and the probability curve are fitted on a bounded sample of labelled rows (``max_labels``,
taken by hash); every text is scored whole. Null and empty texts have no matches and get the curve's value at zero.
"""

from __future__ import annotations

import math
from bisect import bisect_right
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.session import scratch_path, stored

# Letters that look like Latin ones, and digits and signs that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ζ": "z", "ı": "i", "ɡ": "g", "ł": "l", "ø": "o", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

#: A toxic document asks for terms until so many cover it.
COVERS = 4
_FOLD = str.maketrans(LOOK_ALIKES)
_DISGUISE = str.maketrans(DIGITS)
#: A sign or digit is a disguised letter only inside a word that has letters.
_MIXED = re.compile(r"(?:[0134578@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$]+)")
_HIDDEN = re.compile(r"[­​-‏⁠﻿̀-ͯ]+")
_OTHER = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Words of Latin letters between single spaces, with a space at both ends."""
    text = text or ""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKD", text.lower())).translate(_FOLD)
    text = _MIXED.sub(lambda m: m[0].translate(_DISGUISE), text.lower())
    return f" {_OTHER.sub(' ', text).strip()} "


@dataclass
class Lexicon:
    """Weights of patterns (" word " or " begin") and exception phrases, and the curve from density to probability."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-2.0, 2.0, -0.5)
    _machine: object = field(default=None, repr=False)

    def machine(self):
        if self._machine is None:
            import ahocorasick

            m = ahocorasick.Automaton()
            for p, w in self.weights.items():
                m.add_word(p, (len(p), w))
            for p in self.exceptions:
                m.add_word(p, (len(p), None))
            if len(m):
                m.make_automaton()
            self._machine = m
        return self._machine

    def weigh(self, folded: str) -> tuple[float, int]:
        """Summed weight of the matches outside exception phrases, and the number of words."""
        n = len(folded.split())
        if not len(self.machine()):
            return 0.0, n
        found, shield = [], []                                # (first, last, weight) of terms and phrases
        for end, (size, weight) in self.machine().iter(folded):
            (found if weight is not None else shield).append((end - size + 1, end, weight or 0.0))
        # a match is shielded if, of the phrases that begin no later, the one that reaches farthest ends no earlier
        shield.sort()
        starts, reach = [x for x, _, _ in shield], list(accumulate((y for _, y, _ in shield), max))
        return sum(w for a, b, w in found if not (k := bisect_right(starts, a)) or reach[k - 1] < b), n

    def probability(self, total: float, words: int) -> float:
        """The curve at the weight, normalised by the length: a power of the number of words divides the weight."""
        z = self.curve[0] + self.curve[1] * math.log1p(total) + self.curve[2] * math.log1p(words)
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))

    def score(self, text: str | None) -> tuple[float, float]:
        """(weight for each hundred words, probability) of a text."""
        total, words = self.weigh(fold(text))
        return 100.0 * total / max(1, words), self.probability(total, words)


def _patterns(folded: str, shortest: int = 3, longest: int = 8) -> Counter:
    """How often each whole word and each word beginning occurs."""
    out: Counter = Counter()
    for w, n in Counter(folded.split()).items():
        if len(w) >= shortest:
            out[f" {w} "] += n
        for size in range(shortest, min(longest, len(w) - 1) + 1):
            out[f" {w[:size]}"] += n
    return out


def _phrases(folded: str, terms: tuple[str, ...]) -> Counter:
    """Word pairs around words that match a term."""
    words = folded.split()
    hit = {i for i, w in enumerate(words) if f" {w} ".startswith(terms)}
    return Counter(f" {words[i]} {words[i + 1]} " for j in hit for i in (j - 1, j) if 0 <= i < len(words) - 1)


def _counted(sample: DataFrame, features) -> DataFrame:
    """(feature, toxic, docs, n): documents of each class with the feature and its occurrences, added up within a task first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: dict[int, Counter] = {0: Counter(), 1: Counter()}
        n: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, y in zip(b.column("folded").to_pylist(), b.column("toxic").to_pylist()):
                got = features(text)
                n[y].update(got)
                docs[y].update(got.keys())
        for y, c in n.items():
            yield pa.RecordBatch.from_pydict({"feature": pa.array(list(c), pa.string()), "toxic": pa.array([y] * len(c), pa.int32()), "docs": pa.array([docs[y][f] for f in c], pa.int64()), "n": pa.array(list(c.values()), pa.int64())})

    return sample.mapInArrow(run, "feature string, toxic int, docs long, n long").groupBy("feature", "toxic").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _folded(docs: DataFrame, columns: list[str]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array([fold(t.as_py()) for t in b.column("t")], pa.string())], [*columns, "folded"])

    return docs.select(*columns, "t").mapInArrow(run, docs.select(*columns).schema.add("folded", "string"))


def learn(docs: DataFrame, labels: DataFrame, max_labels: int = 24_000, min_docs: int = 5, min_odds: float = 2.0,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """Fit a lexicon on at most ``max_labels`` labelled rows, the ones with the least hashes.

    A term's weight is the log of how much more often it occurs for each word of toxic documents. Terms are chosen
    greedily: each time the one that adds most weight over the toxic documents that fewer than ``COVERS`` chosen terms
    cover, as long as its weight is ``min_odds`` and those documents are ``min_docs`` (or a 200th of all) at least; copies of one text count once, as toxic if any is. Word pairs
    around a term that are mostly found in clean documents become exceptions. All tables here are bounded by ``max_labels``.
    """
    spark = docs.sparkSession
    chosen = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(max_labels))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id")
    rows = stored(rows, scratch_path(spark, "toxic-sample")).groupBy("t").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic"))
    sample = stored(_folded(rows, ["id", "toxic"]), scratch_path(spark, "toxic-folded")).repartition(spark.sparkContext.defaultParallelism)
    words = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.sum(F.size(F.split("folded", " ")) - 2).alias("n")).collect()}

    def odds(a: int, b: int) -> float:
        return math.log((a + 0.5) / (words.get(1, 0) + 1)) - math.log((b + 0.5) / (words.get(0, 0) + 1))

    min_docs = max(min_docs, sample.filter("toxic = 1").count() // 200)
    toxic, clean = sample.filter("toxic = 1"), sample.filter("toxic = 0")
    held = {r.feature: r.n for r in _counted(toxic, _patterns).filter(F.col("docs") >= min_docs).collect()}
    known = frozenset(held)
    spare = {r.feature: r.n for r in _counted(clean, lambda t: Counter({f: n for f, n in _patterns(t).items() if f in known})).collect()}
    weight = {f: odds(n, spare.get(f, 0)) for f, n in held.items()}
    good = frozenset(f for f, w in weight.items() if w >= min_odds)
    covers: dict[str, set[int]] = {f: set() for f in good}
    for r in _features(toxic, good).collect():
        for f in r.features:
            covers[f].add(r.id)
    weights: dict[str, float] = {}
    covers = {f: ids for f, ids in covers.items() if len(ids) >= min_docs}
    kin = lambda f, g: f.startswith(g.rstrip()) or g.startswith(f.rstrip())  # noqa: E731  a beginning of the other
    times: Counter = Counter()
    while covers:
        best = max(covers, key=lambda f: (len(covers[f]) * weight[f], len(f), f))
        times.update(got := covers.pop(best))
        weights[best] = weight[best]
        full = {i for i in got if times[i] == COVERS}
        covers = {f: left for f, ids in covers.items() if not kin(f, best) and len(left := ids - full) >= min_docs}
    exceptions: tuple[str, ...] = ()
    if weights:
        terms = tuple(weights)
        both: dict[str, list[int]] = {}
        for r in _counted(sample, lambda t: _phrases(t, terms)).collect():
            both.setdefault(r.feature, [0, 0])[r.toxic] = r.docs
        exceptions = tuple(sorted(f for f, (b, a) in both.items() if b >= min_docs and odds(a, b) < 0))
    lexicon = Lexicon(weights, exceptions)
    lexicon.curve = _curve(sample, lexicon)
    return lexicon


def _features(sample: DataFrame, wanted: frozenset[str]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([sorted(_patterns(t).keys() & wanted) for t in b.column("folded").to_pylist()], pa.list_(pa.string()))], ["id", "features"])

    kind = sample.schema["id"].dataType.simpleString()
    return sample.mapInArrow(run, f"id {kind}, features array<string>")


def _curve(sample: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic regression of the label on the logs of weight and length, with a little ridge so that separable data end."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [lexicon.weigh(t) for t in b.column("folded").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int64()), b.column("toxic")], ["x", "n", "y"])

    start = np.array([-2.0, 2.0, -0.5])
    got = sample.mapInArrow(run, "x double, n long, y int").toPandas().sort_values(["x", "n", "y"])
    y = got["y"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return tuple(start.tolist())
    z, beta = np.stack([np.ones(len(y)), np.log1p(got["x"].to_numpy(float)), np.log1p(got["n"].to_numpy(float))], 1), start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(3), z.T @ (y - p) - 0.5 * (beta - start))
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(beta.tolist())


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, density, score) of every row, in one pass without a shuffle; density is weight for each hundred words."""
    lexicon = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [lexicon.score(t.as_py()) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([d for d, _ in got], pa.float64()), pa.array([p for _, p in got], pa.float64())], ["id", "density", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, density double, score double").withColumnRenamed("id", id_col)


def reject_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, all columns as they were."""
    place = docs.columns.index(text_col)
    lexicon = Lexicon(lexicon.weights, lexicon.exceptions, lexicon.curve)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([lexicon.score(t.as_py())[1] < threshold for t in b.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learn_on_training_part(docs: DataFrame, labels: DataFrame, **kw) -> Lexicon:
    """Fit on the labelled rows whose crc32 of the id, as text, is not 2 modulo 4."""
    return learn(docs, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), **kw)
