"""Quality classifier: naive Bayes support vectors.

A text becomes a set of hashed n-grams, of words and of word shapes. Each indicator is scaled by the log-count ratio of its
n-gram between the classes, then a linear hinge-loss model is fitted by dual coordinate descent. The rows of the sample lie
in blocks; in every round each block improves its own dual variables against the shared weights in a task of its own, and
the sum of the changes is added to the weights. The margin becomes a probability by a logistic fit on rows of another fold.

Null and empty texts have no n-gram and get the score of the bias alone. Without rows of both classes every score is the
share of class 1, 0.5 if there are no labels. Repeated rows are scored alike; an empty table gives an empty table. Columns
of any other name are left alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm.common import labelled_sample, quoted
from harvest.sources.scratch import written

#: Rows of labels that a fit reads at most.
MAX_ROWS = 20_000
INNER_FOLDS = 4
#: The fold of the logistic fit; ratios and weights do not see it.
CALIBRATION = 3
#: Hashed n-grams; the last place of the weights is the bias.
DIMENSIONS = 1 << 18
BLOCKS = 8
MOST_WORDS = 200_000


class Words(dict):
    """Hash of a word, lower case, in the upper half and of its shape in the lower half."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        shape = re.sub(r"[^\W\d_]+", lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "x" if m[0].islower() else "Xx", word)
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"\d+", "d", shape))
        self[word] = code = zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(shape.encode())
        return code


REPEATED = np.uint64(zlib.crc32(b"="))


def _placed(h: np.ndarray, kind: int) -> np.ndarray:
    mixed = (h ^ np.uint64(kind * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - 18)).astype(np.int32)


def grams(text: str, words: Words) -> np.ndarray:
    """Places of the n-grams of a text: one and two words, one to three shapes. A word equal to the one before has a shape of its own."""
    parts = text.split()
    if not parts:
        return np.zeros(0, np.int32)
    codes = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    word, shape = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    shape[1:][codes[1:] == codes[:-1]] = REPEATED
    step, far = np.uint64(0x100000001B3), np.uint64(0x9E3779B1)
    found = [_placed(word, 1), _placed(shape, 2)]
    if len(parts) > 1:
        pair = shape[:-1] * step + shape[1:]
        found += [_placed(word[:-1] * step + word[1:], 3), _placed(pair, 4)]
        if len(parts) > 2:
            found.append(_placed(pair[:-1] * far + shape[2:], 5))
    return np.unique(np.concatenate(found))


@dataclass
class QualityModel:
    prior: float
    ratios: np.ndarray | None = None
    weights: np.ndarray | None = None
    slope: float = 0.0
    shift: float = 0.0

    def margin(self, places: np.ndarray) -> float:
        own = self.ratios[places]
        norm = float(np.sqrt(own @ own)) or 1.0
        return float(own @ self.weights[places]) / norm + float(self.weights[-1])

    def scored(self, docs: DataFrame, to: str = "score", text: str = "text") -> DataFrame:
        """`docs` with one more column, the probability of class 1."""
        if self.weights is None:
            return docs.withColumn(to, F.lit(self.prior))
        model = self

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            words = Words()
            for texts in batches:
                margins = np.array([model.margin(grams(t, words)) for t in texts], float)
                yield pd.Series(1 / (1 + np.exp(-np.clip(model.slope * margins + model.shift, -40, 40))))

        return docs.withColumn(to, score(F.coalesce(quoted(text), F.lit(""))))


def log_count_ratios(rows: DataFrame) -> np.ndarray:
    """Log ratio of the smoothed, normalised counts of each place. The counts are summed in the tasks; one number per place and class reaches the driver."""
    counts = rows.select("label", F.explode("places").alias("place")).groupBy("place").agg(F.sum("label").alias("good"), F.count("*").alias("all"))
    got = counts.toArrow()
    good, every = np.ones(DIMENSIONS), np.ones(DIMENSIONS)
    place = got["place"].to_numpy()
    good[place] += got["good"].to_numpy()
    every[place] += got["all"].to_numpy() - got["good"].to_numpy()
    return np.log(good / good.sum()) - np.log(every / every.sum())


def _packed(rows: DataFrame) -> DataFrame:
    """One row for each block: labels, row starts and places of its texts."""

    def pack(batches):
        labels, places = [], []
        for batch in batches:
            labels += batch["label"].tolist()
            places += list(batch["places"])
        if labels:
            starts = np.concatenate([[0], np.cumsum([len(p) for p in places])])
            yield pd.DataFrame({"labels": [labels], "starts": [starts.tolist()], "places": [np.concatenate(places)]})

    packed = rows.repartition(BLOCKS).mapInPandas(pack, "labels array<int>, starts array<int>, places array<int>")
    return written(packed.withColumn("block", F.spark_partition_id()), "quality-blocks")


def descend(blocks: DataFrame, ratios: np.ndarray, costs: dict[int, float], rounds: int, local_passes: int) -> np.ndarray:
    """Weights of the hinge-loss model by dual coordinate descent in blocks.

    `costs` bounds the dual variables of each class. A block sees the changes of the other blocks after each round, so its
    own steps count `BLOCKS` times while it works; then adding the changes of all blocks never overshoots.
    """
    weights = np.zeros(DIMENSIONS + 1)
    duals: dict[int, np.ndarray] = {}
    for turn in range(rounds):
        now, known = weights, duals

        def improve(batches, now=now, known=known, turn=turn):
            for batch in batches:
                for row in batch.itertuples():
                    y = np.where(np.asarray(row.labels) == 1, 1.0, -1.0)
                    starts, places = np.asarray(row.starts), np.asarray(row.places)
                    bound = np.array([costs[int(v > 0)] for v in y])
                    dual = known.get(row.block, np.zeros(len(y))).copy()
                    own = now.copy()
                    rng = np.random.default_rng((row.block, turn))
                    for _ in range(local_passes):
                        for i in rng.permutation(len(y)):
                            at = places[starts[i] : starts[i + 1]]
                            x = ratios[at]
                            norm = np.sqrt(x @ x) or 1.0
                            x = x / norm
                            slope = y[i] * (x @ own[at] + own[-1]) - 1
                            new = min(max(dual[i] - slope / (BLOCKS * (x @ x + 1)), 0.0), bound[i])
                            step = (new - dual[i]) * y[i] * BLOCKS
                            if step:
                                dual[i] = new
                                own[at] += step * x
                                own[-1] += step
                    change = ((own - now) / BLOCKS).astype(np.float32)
                    used = np.flatnonzero(change).astype(np.int32)
                    yield pd.DataFrame({"block": [row.block], "dual": [dual], "used": [used.tobytes()], "change": [change[used].tobytes()]})

        got = blocks.mapInPandas(improve, "block int, dual array<double>, used binary, change binary").collect()
        duals = {r["block"]: np.array(r["dual"]) for r in got}
        weights = weights.copy()
        for r in sorted(got, key=lambda r: r["block"]):
            weights[np.frombuffer(r["used"], np.int32)] += np.frombuffer(r["change"], np.float32)
    return weights


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(1) over the margin, by Newton steps on smoothed targets."""
    good = labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    x, beta = np.stack([margins, np.ones_like(margins)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p) - 1e-6 * beta)
        beta = beta + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", max_rows: int = MAX_ROWS, cost: float = 4.0, rounds: int = 12, local_passes: int = 3) -> QualityModel:
    """Learn from at most `max_rows` labelled rows outside the held-out fold."""

    def hashed(batches):
        words = Words()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "fold": batch["fold"], "places": [grams(t, words) for t in batch["text"]]})

    sample = labelled_sample(docs, labels, column, max_rows, INNER_FOLDS)
    rows = written(sample.mapInPandas(hashed, "label int, fold int, places array<int>"), "quality-rows")
    sizes = rows.groupBy("label", (F.col("fold") == CALIBRATION).alias("kept")).agg(F.count("*").alias("n")).collect()
    n = {y: sum(r["n"] for r in sizes if r["label"] == y) for y in (0, 1)}
    if len(sizes) < 4:
        return QualityModel(n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5)
    learn = rows.where(F.col("fold") != CALIBRATION)
    model = QualityModel(n[1] / (n[0] + n[1]), log_count_ratios(learn))
    costs = {y: cost * (n[0] + n[1]) / (2 * n[y]) for y in (0, 1)}
    model.weights = descend(_packed(learn), model.ratios, costs, rounds, local_passes)

    def margins(batches):
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "margin": [model.margin(p) for p in batch["places"]]})

    got = rows.where(F.col("fold") == CALIBRATION).mapInPandas(margins, "label int, margin double").toPandas()
    model.slope, model.shift = logistic(got["margin"].to_numpy(), got["label"].to_numpy())
    return model


def is_good(score: Column) -> Column:
    return score >= 0.3
