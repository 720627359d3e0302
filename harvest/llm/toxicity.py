"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words and word beginnings that the toxic texts of the sample hold far more often. Features are
the densities of lexicon words, how near they stand to a second person, capitals, punctuation and obfuscation. The features
of a text of the sample use the lexicon learned without its fold, so the trees see them as they see new texts.

Null and empty texts have zero features and get the score of such texts. Without rows of both classes every score is the
share of class 1, 0.5 if there are no labels. Repeated rows are scored alike; an empty table gives an empty table. Columns
of any other name are left alone.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm.common import labelled_sample, quoted
from harvest.sources.scratch import written

#: Rows of labels that a fit reads at most.
MAX_ROWS = 20_000
INNER_FOLDS = 4
#: The fold that calibrates; the trees do not see it.
CALIBRATION = 3
STEMS = (4, 5, 6)
PRONOUNS = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta vous votre vos tú ti usted ustedes vosotros".split()
)
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic scum trash garbage worthless disgusting clown fool imbecile jerk bastard".split()
)
LEET = str.maketrans("013457@$!|", "oieastasil", "*.-_")
WORDS = re.compile(r"\w+")
MIXED = re.compile(r"[^\W\d_]+[0-9@$!|*._-]+[^\W\d_][\w@$!|*-]*")
SPACED = re.compile(r"\b(?:[^\W\d_][ .]){3,}[^\W\d_]\b")
MARKS = "!?.,;:\"'()-"
SYMBOLS = "#*$%&|<>@^~_+="
#: Kinds of characters, and the code points that have one; later ones have none.
OTHER, UPPER, MARK, SHOUT, SYMBOL = range(5)
LAST = 0x20000
NEAR = 5
N_FEATURES = 16
MOST_WORDS = 200_000


@cache
def kinds() -> np.ndarray:
    """The kind of each code point. Beyond ASCII, marks are Unicode's punctuation and symbols its symbols."""

    def kind(char: str) -> int:
        if char.isupper():
            return UPPER
        if char in "!！¡":
            return SHOUT
        if char.isascii():
            return MARK if char in MARKS else SYMBOL if char in SYMBOLS else OTHER
        return {"P": MARK, "S": SYMBOL}.get(unicodedata.category(char)[0], OTHER)

    return np.array([kind(chr(c)) for c in range(LAST)] + [OTHER], np.uint8)


def kind_counts(text: str) -> np.ndarray:
    """How many characters of a text are of each kind."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(kinds()[np.minimum(points, LAST)], minlength=5)


class Weights(dict):
    """Lexicon weight of a lower-case word: -1 for a second person, 0 for words outside the lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= MOST_WORDS:
            self.clear()
        known = self.lexicon.get
        weight = max([known(word, 0.0), *(known(word[:n] + "*", 0.0) for n in STEMS if len(word) > n)])
        if word in INSULTS:
            weight = max(weight, 2.0)
        self[word] = weight = weight if weight > 0 or word not in PRONOUNS else -1.0
        return weight


def tokens(text: str) -> set[str]:
    """Words of a text and the beginnings of its longer words."""
    words = set(WORDS.findall(text.lower()))
    return words.union(w[:n] + "*" for w in words for n in STEMS if len(w) > n)


def features(text: str, weights: Weights) -> list[float]:
    """The dense features of one text."""
    if not text:
        return [0.0] * N_FEATURES
    words = WORDS.findall(text.lower())
    n, chars = max(1, len(words)), max(1, len(text))
    found = np.fromiter(map(weights.__getitem__, words), float, len(words))
    hits = np.flatnonzero(found > 0)
    persons = np.flatnonzero(found < 0)
    near = 0
    if hits.size and persons.size:
        after = np.searchsorted(persons, hits)
        left = hits - persons[np.maximum(after - 1, 0)]
        right = persons[np.minimum(after, persons.size - 1)] - hits
        near = int(((np.abs(left) <= NEAR) | (np.abs(right) <= NEAR)).sum())
    of = kind_counts(text).tolist()
    mixed = MIXED.findall(text)
    hidden = sum(weights[m.lower().translate(LEET)] > 0 for m in mixed)
    spaced = SPACED.findall(text)
    hidden += sum(weights[re.sub(r"\W", "", m.lower())] > 0 for m in spaced)
    return [
        math.log1p(len(words)),
        float(hits.size),
        hits.size / n,
        float(found[hits].max()) if hits.size else 0.0,
        float(found[hits].sum()) / n,
        float(len({words[i] for i in hits})),
        float((found[hits] > 3).sum()),
        float(near),
        near / n,
        persons.size / n,
        of[UPPER] / chars,
        of[SHOUT] / chars,
        (of[MARK] + of[SHOUT]) / chars,
        of[SYMBOL] / chars,
        (len(mixed) + len(spaced)) / n,
        float(hidden),
    ]


def learn_lexicons(train: DataFrame, toxic: int, clean: int) -> list[dict[str, float]]:
    """One lexicon without each fold, then one of all folds: token to log odds.

    A token enters if the lower confidence bound of its log odds is above 1 and enough toxic texts hold it. The sample is
    bounded, and so are the tokens that reach the driver.
    """
    base = toxic / (toxic + clean)
    least = max(3, math.ceil(math.log(20 * toxic) / -math.log(base)))

    def counted(wanted: frozenset[str] | None):
        def count(batches):
            seen: Counter = Counter()
            for batch in batches:
                for text, label, fold in zip(batch["text"], batch["label"], batch["fold"], strict=True):
                    own = tokens(text)
                    seen.update((t, fold, label) for t in (own if wanted is None else own & wanted))
            yield pd.DataFrame([(*key, n) for key, n in seen.items()], columns=["token", "fold", "label", "n"])

        return count

    shape = "token string, fold int, label int, n long"
    often = train.where("label = 1").mapInPandas(counted(None), shape).groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    candidates = frozenset(often.select("token").toArrow()["token"].to_pylist())
    cells = [(fold, label) for fold in range(INNER_FOLDS) for label in (0, 1)]
    each = [F.sum(F.when((F.col("fold") == fold) & (F.col("label") == label), F.col("n")).otherwise(0)).alias(f"n{fold}{label}") for fold, label in cells]
    # One row for each token reaches the driver, in columns.
    counts = train.mapInPandas(counted(candidates), shape).groupBy("token").agg(*each).toArrow()
    del candidates
    sizes = {(r["fold"], r["label"]): r["n"] for r in train.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    lexicons = []
    for left_out in [*range(INNER_FOLDS), None]:
        n = [sum(v for (f, y), v in sizes.items() if y == label and f != left_out) for label in (0, 1)]
        b, a = (sum(counts[f"n{f}{label}"].to_numpy() for f in range(INNER_FOLDS) if f != left_out) for label in (0, 1))
        odds = np.log((a + 0.5) / (n[1] + 1)) - np.log((b + 0.5) / (n[0] + 1))
        error = np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        chosen = np.flatnonzero((a >= min(3, least)) & (odds - 1.64 * error > 1))
        lexicons.append(dict(zip(counts["token"].take(chosen).to_pylist(), odds[chosen].round(4).tolist(), strict=True)))
    return lexicons


@dataclass
class ToxicityModel:
    prior: float
    lexicon: dict[str, float] = field(default_factory=dict)
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None

    def scored(self, docs: DataFrame, to: str = "score", text: str = "text") -> DataFrame:
        """`docs` with one more column, the calibrated probability of class 1."""
        if self.trees is None:
            return docs.withColumn(to, F.lit(self.prior))
        lexicon = self.lexicon

        @F.pandas_udf("array<double>")
        def dense(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            weights = Weights(lexicon)
            for texts in batches:
                yield pd.Series([features(t, weights) for t in texts])

        out = docs.withColumn("__tox_features", array_to_vector(dense(F.coalesce(quoted(text), F.lit("")))))
        out = self.steps.transform(raw_scores(self.trees, out))
        return out.withColumn(to, 0.999 * F.col("__tox_step") + 0.001 * F.col("__tox_raw")).select(*(quoted(c) for c in docs.columns if c != to), quoted(to))


def raw_scores(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    return trees.transform(df).withColumn("__tox_raw", vector_to_array("__tox_probability")[1])


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", max_rows: int = MAX_ROWS, trees: int = 12, depth: int = 4) -> ToxicityModel:
    """Learn from at most `max_rows` labelled rows outside the held-out fold."""
    train = written(labelled_sample(docs, labels, column, max_rows, INNER_FOLDS).repartition(8), "toxicity-train")
    sizes = train.groupBy("label", (F.col("fold") == CALIBRATION).alias("kept")).agg(F.count("*").alias("n")).collect()
    clean, toxic = (sum(r["n"] for r in sizes if r["label"] == label) for label in (0, 1))
    if len(sizes) < 4:
        return ToxicityModel(toxic / (clean + toxic) if clean + toxic else 0.5)
    lexicons = learn_lexicons(train, toxic, clean)

    def dense(batches):
        weights = [Weights(x) for x in lexicons]
        for batch in batches:
            yield pd.DataFrame(
                {
                    "label": batch["label"].astype(float),
                    "fold": batch["fold"],
                    "x": [features(t, weights[f]) for t, f in zip(batch["text"], batch["fold"], strict=True)],
                }
            )

    rows = written(train.mapInPandas(dense, "label double, fold int, x array<double>"), "toxicity-features")
    rows = rows.withColumn("__tox_features", array_to_vector("x"))
    booster = GBTClassifier(
        featuresCol="__tox_features", labelCol="label", predictionCol="__tox_class", maxIter=trees, maxDepth=depth, stepSize=0.4, maxBins=32, seed=7
    )
    booster.setProbabilityCol("__tox_probability").setRawPredictionCol("__tox_margin")
    boosted = booster.fit(rows.where(F.col("fold") != CALIBRATION))
    # At most 1001 rows reach the isotonic fit, whatever the number of texts.
    binned = raw_scores(boosted, rows.where(F.col("fold") == CALIBRATION)).groupBy(F.round("__tox_raw", 3).alias("__tox_raw"))
    binned = binned.agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    steps = IsotonicRegression(featuresCol="__tox_raw", labelCol="label", weightCol="weight", predictionCol="__tox_step").fit(binned)
    return ToxicityModel(toxic / (clean + toxic), lexicons[-1], boosted, steps)


def is_toxic(score: Column) -> Column:
    return score >= 0.5
