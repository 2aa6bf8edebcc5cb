r"""Language identification in two steps: first the family, then the language within it.

A text becomes the square roots of the shares of its hashed byte sequences of length 1 to 3, in lower
case. Linear support vector machines, one for each pair of families and one for each pair of languages
of a family, vote; the winner of the families picks whose machines vote next. They learn from a
sample of about ``per_language`` rows of each language, chosen by a hash of the id; every text is
predicted whole.

Defined results: a text that is null or has no letter is ``und`` with score 0, and teaches nothing;
neither do rows with a null language. With nothing learned all are ``und``. Ties of votes go to the
greater sum of margins, then to the first name. Equal texts get equal predictions, repeated rows too.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import ship, stage, table

ship(__name__)

UNKNOWN = "und"

#: Families of languages; a language that isn't here is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo is lb nb nl nn no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

DIMENSIONS = 2048
_MULTIPLIERS = (2654435761, 2246822519, 3266489917)
#: Bytes of a text looked at together.
_CHUNK = 1 << 20


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only {lang}")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    counts = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    for start in range(0, len(raw), _CHUNK):
        codes = raw[start : start + _CHUNK + 2].astype(np.uint32)
        own = min(len(codes), _CHUNK)
        key = np.zeros(len(codes), np.uint32)
        for n, multiplier in enumerate(_MULTIPLIERS):
            key = (key[: len(codes) - n] << np.uint32(8)) | codes[n:]
            hashed = (key[:own] + np.uint32(n << 24)) * np.uint32(multiplier)
            counts += np.bincount(hashed >> shift, minlength=DIMENSIONS)
    return np.sqrt(counts / max(1, counts.sum()))


@dataclass
class Machines:
    """Names in order, and for each pair of them (by place) weights and intercept: positive for the
    first of the pair."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    intercepts: np.ndarray

    def vote(self, x: np.ndarray) -> tuple[str, float]:
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = self.weights @ x + self.intercepts
        votes, sums, shares = np.zeros((3, len(self.names)))
        for (a, b), margin in zip(self.pairs, margins.tolist()):
            votes[a if margin >= 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
            share = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
            shares[a] += share
            shares[b] += 1 - share
        best = max(range(len(self.names)), key=lambda i: (votes[i], sums[i], -i))
        # Against each other name it got a share; all of them sum to the number of pairs.
        return self.names[best], float(shares[best] / (len(self.names) - 1))


@dataclass
class Identifier:
    families: Machines | None
    languages: dict[str, Machines]

    def predict(self, text: str | None) -> tuple[str, float]:
        if self.families is None or text is None or not has_letter(text):
            return UNKNOWN, 0.0
        x = features(text)
        family, sure = self.families.vote(x)
        lang, surer = self.languages[family].vote(x)
        return lang, sure * surer

    def column(self, text: Column) -> Column:
        """``lang``, ``score`` of each text."""

        @F.pandas_udf("lang string, score double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield pd.DataFrame([self.predict(t) for t in texts], columns=["lang", "score"])

        return of(text)


def _vectors(text: Column) -> Column:
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype(np.float32) if has_letter(t) else None for t in texts])

    return of(text)


#: Weight of errors against that of a wide margin, rounds over the rows, and where rounds end early.
_COST, _ROUNDS, _SETTLED = 8.0, 60, 1e-3


def separate(x: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear support vector machine of squared hinge loss, by descent along
    one row's multiplier at a time. The intercept is the weight of a feature that is always 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    slack = 1 / (2 * _COST)
    curvature = (x * x).sum(axis=1) + slack
    multipliers, weights = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(0)
    for _ in range(_ROUNDS):
        largest = 0.0
        for i in order.permutation(len(x)).tolist():
            slope = sign[i] * (x[i] @ weights) - 1 + slack * multipliers[i]
            moved = max(multipliers[i] - slope / curvature[i], 0.0) - multipliers[i]
            if moved:
                multipliers[i] += moved
                weights += moved * sign[i] * x[i]
                largest = max(largest, abs(moved))
        if largest < _SETTLED:
            break
    return weights[:-1], float(weights[-1])


def _learn_machine(rows: pd.DataFrame) -> pd.DataFrame:
    # In an order that doesn't depend on how rows were shuffled, so that a rerun learns the same.
    x = np.stack(rows["x"].to_numpy())
    sign = rows["sign"].to_numpy(np.float64)
    keys = [x[i].tobytes() for i in range(len(x))]
    order = sorted(range(len(x)), key=lambda i: (keys[i], sign[i]))
    weights, intercept = separate(x[order].astype(np.float64), sign[order])
    return pd.DataFrame(
        {"machine": rows["machine"].iloc[:1].to_numpy(), "weights": [weights], "intercept": [intercept]}
    )


def _machines(teaching: DataFrame, groups: dict[tuple[str, str], list[str]]) -> dict[tuple[str, str], Machines]:
    """For each group, which names a column and what is told apart in it, the machines of its pairs. All
    are learned in one job, a task each; a machine gets no more rows than the sample has of its two
    names."""
    pairs = {group: list(combinations(range(len(names)), 2)) for group, names in groups.items()}
    places = [(group, i) for group, of in pairs.items() for i in range(len(of))]
    sides = [
        (number, group[0], groups[group][pairs[group][i][side]], (1, -1)[side])
        for number, (group, i) in enumerate(places)
        for side in (0, 1)
    ]
    made = {
        group: Machines(groups[group], of, np.zeros((len(of), DIMENSIONS)), np.zeros(len(of)))
        for group, of in pairs.items()
    }
    if not sides:
        return made
    # Two rows a pair of languages or families.
    both = teaching.sparkSession.createDataFrame(sides, "machine int, label string, name string, sign int")
    named = F.array(*(F.struct(F.lit(c).alias("label"), F.col(c).alias("name")) for c in ("family", "lang")))
    rows = (
        teaching.select("x", F.explode(named).alias("as"))
        .select("x", "as.label", "as.name")
        .join(F.broadcast(both), ["label", "name"])
        .select("machine", "sign", "x")
    )
    learned = rows.groupBy("machine").applyInPandas(
        _learn_machine, "machine int, weights array<double>, intercept double"
    )
    for row in learned.collect():
        group, i = places[row["machine"]]
        made[group].weights[i], made[group].intercepts[i] = row["weights"], row["intercept"]
    return made


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> Identifier:
    """Learn from ``docs``: a sample of its labelled rows, about ``per_language`` of each language."""
    known = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")
    ).filter("lang IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Identifier(None, {})
    fine = 1 << 20
    limits = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, per_language * fine // n)))
    families_of = F.create_map(*(F.lit(x) for k in counts for x in (k, family_of(k))))
    # Small texts of a language that is rare are all used; of a common one, a share by the hash.
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(fine)) < limits[F.col("lang")])
    family = families_of[F.col("lang")]
    teaching = stage(
        chosen.filter("text IS NOT NULL").select(family.alias("family"), "lang", _vectors(F.col("text")).alias("x"))
        .filter("x IS NOT NULL")
    )
    learned = sorted(r["lang"] for r in teaching.select("lang").distinct().collect())
    if not learned:
        return Identifier(None, {})
    families = sorted({family_of(lang) for lang in learned})
    groups = {("lang", name): [lang for lang in learned if family_of(lang) == name] for name in families}
    made = _machines(teaching, {("family", ""): families} | groups)
    return Identifier(made["family", ""], {name: made["lang", name] for name in families})


#: Rows of each language that are learned from, about.
PER_LANGUAGE = 800


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    identifier = fit(docs.filter(~held_out(F.col("doc_id"))), "doc_id", "text", "lang", PER_LANGUAGE)
    found = docs.select("doc_id", identifier.column(F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )
