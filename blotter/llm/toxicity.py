r"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from the labelled rows: words, and word beginnings, that mark the toxic ones. Each text
then becomes a few numbers: densities of lexicon and of common insults, how many of these stand near a
word in the second person, capitals, punctuation, and disguised words. Trees learn from these numbers, and an
isotonic curve turns their margin into the share of toxic documents.

No step learns from what it has seen before: for learning, each half of the labelled rows gets its numbers by
a lexicon of the other half, and the curve is fitted on margins by trees that learned from the other
folds. So every labelled row serves all three. The lexicon and the trees that score are learned from all.

The labelled rows used are a bounded sample, ``per_class`` of each label, chosen by a hash of the id;
the curve weighs them by what they stand for. Equal texts are one row, toxic if one of them is. What is
learned depends neither on how rows are dealt to tasks nor on their order. Every text is scored whole.

Defined results: a null text is empty; an empty text has all features zero and gets a score as any
other. A document labelled twice is toxic if any label says so; null ids and null labels teach
nothing. Without labelled rows of both kinds the score is the share of toxic ones among them, zero
without any. Repeated rows get equal scores. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import ship, stage, table

ship(__name__)

#: Common insults, and second-person words, in English, German, French and Spanish.
INSULTS = frozenset(
    "idiot idiots idiotic moron morons stupid loser losers pathetic worthless disgusting trash scum "
    "clown clowns dumb fool jerk ugly filth garbage vermin imbecile coward creep idiota imbecil "
    "estupido estupida tonto basura asqueroso inutil idiote imbecile stupide connard ordure minable "
    "dumm dumme idioten trottel versager abschaum widerlich erbarmlich mull".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch "
    "euer sie ihnen ti tus usted ustedes vosotros vuestro".split()
)

#: Signs that stand for letters in disguised words.
_SIGNS = str.maketrans("013457@$!|", "oieastasil")

#: Lexicon terms: words, and beginnings of these lengths of longer words.
_BEGINNINGS = (4, 5, 6)

_LETTERS = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"[^\W\d_][\d@$!|*_.\-]+[^\W\d_]")

#: Distinct tokens whose worth a task remembers.
_REMEMBERED = 300_000

#: A token's worth in one number: lexicon score in sixteenths, and flags above.
_SCALE, _INSULT, _SECOND, _DISGUISE = 16, 1 << 10, 1 << 11, 1 << 12

_NEAR = 5


def terms_of(word: str) -> Iterator[str]:
    yield word
    for length in _BEGINNINGS:
        if len(word) > length:
            yield f"{word[:length]}*"


class Worth(dict):
    """What a token, white space around it removed and in lower case, counts for."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        words = _LETTERS.findall(token)
        flags = 0
        if _DISGUISED.search(token):
            plain = "".join(_LETTERS.findall(token.strip("!|.-_*").translate(_SIGNS)))
            flags |= _DISGUISE * (plain not in words)
            words.append(plain)
        score = max((self.lexicon.get(t, 0.0) for w in words for t in terms_of(w)), default=0.0)
        flags |= _INSULT * any(w in INSULTS for w in words)
        flags |= _SECOND * any(w in SECOND_PERSON for w in words)
        found = self[token] = min(round(score * _SCALE), _INSULT - 1) | flags
        return found


FEATURES = (
    "words", "strong_density", "strong_count", "score_density", "top_score", "insult_density",
    "insult_count", "near_second_person", "second_person", "capitals", "exclamation", "punctuation",
    "disguised",
)

_STRONG = 3.0


def features(text: str, worth: Worth) -> list[float]:
    tokens = text.lower().split()
    if not tokens:
        return [0.0] * len(FEATURES)
    per_100 = 100 / len(tokens)
    values = np.fromiter((worth[t] for t in tokens), np.int64, len(tokens))
    scores = (values & (_INSULT - 1)) / _SCALE
    strong, insult = scores >= _STRONG, (values & _INSULT) > 0
    second = np.flatnonzero(values & _SECOND)
    hits = np.flatnonzero(strong | insult)
    near = 0
    if len(hits) and len(second):
        after = np.searchsorted(second, hits)
        left = np.abs(hits - second[np.maximum(after - 1, 0)])
        right = np.abs(second[np.minimum(after, len(second) - 1)] - hits)
        near = int((np.minimum(left, right) <= _NEAR).sum())
    raw = np.frombuffer(text.encode(), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    signs = int(((raw >= 33) & (raw <= 47)).sum())
    loud = text.count("!") + text.count("?")
    n_strong, n_insult = int(strong.sum()), int(insult.sum())
    return [
        math.log1p(len(tokens)), n_strong * per_100, math.log1p(n_strong), float(scores.sum()) * per_100,
        float(scores.max()), n_insult * per_100, math.log1p(n_insult), near * per_100,
        len(second) * per_100, upper / len(raw), loud * per_100, signs * per_100,
        int((values & _DISGUISE > 0).sum()) * per_100,
    ]


def feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worth = Worth(lexicon)
        for texts in batches:
            yield pd.Series([features(t or "", worth) for t in texts])

    return of(text)


@dataclass
class Sample:
    """Labelled rows to learn from: ``id``, ``toxic``, ``weight``, ``part`` (0 to 7), and the share
    of toxic ones among all labelled rows."""

    rows: DataFrame
    share: float
    both: bool


def sample_labels(labels: DataFrame, per_class: int) -> Sample:
    """``per_class`` rows of each label at most, those with the least hash of the id."""
    known = labels.filter("id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    chosen = [
        known.filter(F.col("toxic") == toxic)
        .orderBy(F.xxhash64("id"), "id")
        .limit(per_class)
        .withColumn("weight", F.lit(max(1.0, count / per_class)))
        for toxic, count in counts.items()
    ]
    if len(chosen) < 2:
        return Sample(known, counts.get(1, 0) / total if total else 0.0, False)
    rows = chosen[0].unionByName(chosen[1])
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(8))
    return Sample(stage(rows.withColumn("part", part)), counts[1] / total, True)


def learn_lexicon(texts: DataFrame, most: int, least_docs: int = 3, least_g2: float = 22.0) -> dict[str, float]:
    """Terms that mark toxic texts, with their log odds: those whose log-likelihood ratio is
    at least ``least_g2``, ``most`` of them. ``texts``: ``text``, ``toxic``, each text once."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_LETTERS.findall((text or "").lower()))
                terms = sorted({t for w in words for t in terms_of(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.string()), pa.array([toxic] * len(terms), pa.int32())],
                    ["term", "toxic"],
                )

    numbers = texts.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).collect()[0]
    n_toxic = numbers["toxic"] or 0
    n_clean = numbers["all"] - n_toxic
    if not n_toxic or not n_clean:
        return {}
    counts = texts.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        each, "term string, toxic int"
    ).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    both, p = F.col("t") + F.col("c"), n_toxic / (n_toxic + n_clean)
    part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
    g2 = 2 * (part(F.col("t"), both * p) + part(F.col("c"), both * (1 - p)))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    found = (
        counts.filter(F.col("t") >= least_docs)
        .select("term", g2.alias("g2"), odds.alias("odds"))
        .filter((F.col("g2") >= least_g2) & (F.col("odds") > 1))
        .orderBy(F.desc("g2"), "term")
        .limit(most)
    )
    return {r["term"]: r["odds"] for r in found.collect()}


@dataclass
class Scorer:
    """A fitted scorer; without ``trees`` it gives the ``share`` to all."""

    lexicon: dict[str, float]
    trees: object
    curve: object
    share: float

    def featurize(self, docs: DataFrame, text_col: str, name: str) -> DataFrame:
        return docs.withColumn(name, feature_column(F.col(f"`{text_col}`"), self.lexicon))

    def score(self, featured: DataFrame, name: str) -> DataFrame:
        """``featured`` with ``score`` instead of its features ``name``."""
        if self.trees is None:
            return featured.withColumn("score", F.lit(self.share)).drop(name)
        vectors = featured.withColumn("__vector", array_to_vector(name)).drop(name)
        margin = self.trees.transform(vectors).withColumn("__margin", _margin())
        scored = self.curve.transform(margin.drop("rawPrediction", "probability", "prediction"))
        score = F.least(F.greatest("__score", F.lit(0.0)), F.lit(1.0))
        return scored.withColumn("score", score).drop("__vector", "__margin", "__score")


def _margin() -> Column:
    return vector_to_array("rawPrediction")[1]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int,
    lexicon_size: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Scorer:
    """Learn from the texts of ``docs`` that ``labels`` (``id``, ``toxic``) names."""
    sample = sample_labels(labels, per_class)
    if not sample.both:
        return Scorer({}, None, None, sample.share)
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # 2 * per_class rows of a few numbers each, whatever the input. Each text teaches once.
    rows = named.join(F.broadcast(sample.rows), "id").withColumn("text", F.coalesce("text", F.lit("")))
    learning = stage(
        rows.groupBy("text").agg(
            F.max("toxic").alias("toxic"), F.sum("weight").alias("weight"), F.min("part").alias("part")
        )
    )
    lexicon = learn_lexicon(learning, lexicon_size)
    scorer = Scorer(lexicon, None, None, sample.share)
    halves = learning.filter("part < 4"), learning.filter("part >= 4")
    by_other = [
        Scorer(learn_lexicon(other, lexicon_size), None, None, 0.0).featurize(half, "text", "features")
        for half, other in (halves, halves[::-1])
    ]
    # In one order in one task, so that sums of doubles come out alike.
    order = F.xxhash64("text").alias("order")
    numbers = by_other[0].unionByName(by_other[1]).select("features", "toxic", "weight", "part", order)
    ready = stage(numbers.coalesce(1).sortWithinPartitions("order", "toxic", "weight", "part"))
    vectors = ready.withColumn("__vector", array_to_vector("features"))
    if vectors.select("toxic").distinct().count() < 2:
        return scorer
    trees = _learn_trees(vectors)
    return Scorer(lexicon, trees, _learn_curve(vectors, trees), sample.share)


#: Parts of the labelled rows whose margins come from trees that learned from the others; a leaf of the trees
#: holds a row in so many toxic ones at least, so that a few odd rows or wrong labels make none.
FOLDS, LEAF_ONE_IN = 4, 12


def _learn_trees(vectors: DataFrame):
    leaf = max(1, vectors.filter("toxic = 1").count() // LEAF_ONE_IN)
    return GBTClassifier(
        featuresCol="__vector", labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.2, seed=7, minInstancesPerNode=leaf
    ).fit(vectors)


def _learn_curve(vectors: DataFrame, trees):
    """The share of toxic rows by margin, on margins by trees that haven't seen the row; with too few rows for
    that, by ``trees``."""
    fold = F.col("part") % FOLDS
    margins = []
    for k in range(FOLDS):
        others, own = vectors.filter(fold != k), vectors.filter(fold == k)
        learned = trees if others.select("toxic").distinct().count() < 2 else _learn_trees(others)
        margins.append(learned.transform(own).select(_margin().alias("__margin"), "toxic", "weight"))
    together = stage(reduce(DataFrame.unionByName, margins).coalesce(1).sortWithinPartitions("__margin", "toxic", "weight"))
    return IsotonicRegression(
        featuresCol="__margin", labelCol="toxic", weightCol="weight", predictionCol="__score"
    ).fit(together)


#: Labelled rows of each kind that are learned from, and terms of the lexicon, at most.
PER_CLASS, LEXICON_SIZE = 6000, 2000


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> Scorer:
    teaching = labels.select(F.col("doc_id").alias("id"), "toxic").filter(~held_out(F.col("id")))
    return fit(docs, teaching, PER_CLASS, LEXICON_SIZE)


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic, with their own columns."""
    scorer = fit_on_labels(docs, labels)
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    text = docs.select(row).withColumn("text", F.col("row.text"))
    scored = scorer.score(scorer.featurize(text, "text", "features"), "features")
    return scored.filter(F.col("score") < 0.5).select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = fit_on_labels(docs, table(spark, sf_dir, "labels"))
    featured = scorer.featurize(docs, "text", "features").drop("text")
    return scorer.score(featured, "features").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
