"""Hard negatives of anchors by shared candidate lists, one for each cluster of anchors.

Anchors are clustered by direction, with centres fitted on a bounded sample of them. For each cluster, candidates are sorted once by
an upper bound that holds for all its members: the angle between a candidate and a member is at least the candidate's angle to the
centre less the widest angle of a member, so |candidate| * cos of that difference, times the member's length, bounds the inner
product. Every member walks the same list, a stretch of it at a time, and stops when the bound certifies that nothing further
along can enter its result. One walk finds the positives, a second the negatives of each positive's band of scores.

The candidates lie in blocks by a hash of their id and the members of a cluster in groups of bounded size; a task sorts one block
for one group, and the best of all blocks are merged. So a task holds BLOCK candidates and GROUP anchors, whatever their number,
and neither a common vector nor a common label meets in one task. All anchors against all candidates is what the operator is asked
for: rows that a task reads grow with the groups of anchors. Scores are whole numbers and exact: products beyond 53 bits are
computed with whole numbers, sums beyond 64 bits stop at the ends of that range.

Rows without id, label or vector, or with a null component, take no part. Rows that repeat an id count once, with the
smallest label and vector; columns beside id, label and vector are ignored. A shorter vector counts as filled up with zeros. An empty table, or one
without anchors, gives an empty table. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvest.llm.common import uniform
from harvest.sources.scratch import written

POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these percentages of its positive.
LOW, HIGH = 50, 95
#: Anchors of a group and candidates of a block that meet in a task.
GROUP, BLOCK = 512, 16384
#: Anchors that the centres are fitted on, centres, and rounds of the fit, at most.
SAMPLE, CENTRES, ROUNDS = 4096, 64, 8
#: Candidates of one step along a list.
STEP = 1024
TOP = np.iinfo(np.int64).max


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = vectors.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vectors.flatten().to_numpy()
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of `a` with all of `b`."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if most < 2**52:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -TOP, TOP).astype(np.int64)


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zeros stay), and the lengths."""
    rows = vectors.astype(float)
    norm = np.linalg.norm(rows, axis=1)
    return rows / np.maximum(norm, 1e-300)[:, None], norm


def centres_of(vectors: np.ndarray, number: int) -> np.ndarray:
    """Centres of the directions of `vectors`: rounds of assigning each to the nearest and taking the mean direction."""
    unit, _ = directions(vectors)
    centres = unit[:: max(1, len(unit) // number)][:number]
    for _ in range(ROUNDS):
        near = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        norm = np.linalg.norm(sums, axis=1)[:, None]
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return centres


class SharedList:
    """The candidates of a block in the order of their bound for one group of anchors."""

    def __init__(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        unit, self.lengths = directions(anchors)
        centre = centres_of(anchors, 1)[0]
        angle = lambda rows: np.arccos(np.clip(rows @ centre, -1, 1))
        # A vector of zeros has no direction; its products are zero, which any bound of length zero allows.
        widest = angle(unit[self.lengths > 0]).max(initial=0)
        other, norm = directions(vectors)
        bound = norm * np.cos(np.clip(angle(other) - widest, 0, np.pi))
        order = np.argsort(-bound, kind="stable")
        self.anchors, self.ids, self.labels, self.vectors = anchors, ids[order], labels[order], vectors[order]
        # Rounding of angles and products stays far below this.
        self.bound, self.slack = bound[order], 1e-6 * max(1.0, float(norm.max(initial=0)))

    def walk(self, going: Callable, take: Callable) -> None:
        """Calls `take(members, scores, ids, labels)` along the list, with the members that `going(members, bounds)` lets go on."""
        members = np.arange(len(self.anchors))
        for at in range(0, len(self.ids), STEP):
            members = members[going(members, self.lengths[members] * (self.bound[at] + self.slack))]
            if not members.size:
                return
            here = slice(at, at + STEP)
            take(members, products(self.anchors[members], self.vectors[here]), self.ids[here], self.labels[here])


def best_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, number: int) -> np.ndarray:
    """The places of the first `number` rows of each owner, by score from the highest, then by id."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    begins = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
    counts = np.diff(np.append(begins, len(own)))
    return order[np.arange(len(own)) - np.repeat(begins, counts) < number]


class Best:
    """The best rows seen so far of each owner, and the score that a further row must reach."""

    def __init__(self, owners: int, number: int):
        self.number, self.owners = number, owners
        self.owner = self.score = self.ids = np.zeros(0, np.int64)
        self.least = np.full(owners, -TOP)

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, ids = (np.append(x, y) for x, y in ((self.owner, owner), (self.score, score), (self.ids, ids)))
        take = best_of(owner, score, ids, self.number)
        self.owner, self.score, self.ids = owner[take], score[take], ids[take]
        full = np.bincount(self.owner, minlength=self.owners) >= self.number
        last = np.full(self.owners, TOP)
        np.minimum.at(last, self.owner, self.score)
        self.least = np.where(full, last, -TOP)


def positives_in(shared: SharedList, ids: np.ndarray, labels: np.ndarray, number: int = POSITIVES) -> Best:
    """The best candidates of each anchor's own label, other than itself."""
    best = Best(len(ids), number)

    def take(members: np.ndarray, scores: np.ndarray, other: np.ndarray, other_labels: np.ndarray) -> None:
        fits = (other_labels == labels[members][:, None]) & (other != ids[members][:, None]) & (scores >= best.least[members][:, None])
        row, column = np.nonzero(fits)
        best.add(members[row], scores[row, column], other[column])

    shared.walk(lambda members, bound: bound >= best.least[members], take)
    return best


def negatives_in(shared: SharedList, labels: np.ndarray, bands: np.ndarray, number: int = NEGATIVES) -> Best:
    """The best candidates of another label in each band [least, most] of each anchor; owner is anchor * bands + band."""
    width = bands.shape[1]
    best = Best(len(labels) * width, number)

    def least(members: np.ndarray) -> np.ndarray:
        return np.maximum(bands[members, :, 0], best.least.reshape(-1, width)[members])

    def take(members: np.ndarray, scores: np.ndarray, other: np.ndarray, other_labels: np.ndarray) -> None:
        differs, floor = other_labels != labels[members][:, None], least(members)
        for k in range(width):
            row, column = np.nonzero(differs & (scores >= floor[:, k, None]) & (scores <= bands[members, k, 1][:, None]))
            best.add(members[row] * width + k, scores[row, column], other[column])

    shared.walk(lambda members, bound: bound >= least(members).min(axis=1, initial=TOP), take)
    return best


def band_of(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The least and the greatest whole score between `low` and `high` percent of a score; none for a negative score."""
    return (-(-low * score // 100), high * score // 100) if score >= 0 else (TOP, -TOP)


def _plain(rows: DataFrame) -> DataFrame:
    """One row of id, label and vector for each id that takes part."""
    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    least = rows.where(whole).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return least.select("id", "row.label", "row.vector")


def grouped(anchors: DataFrame, count: int) -> tuple[DataFrame, int]:
    """`anchors` with their group, and the number of groups: clusters by direction, large ones cut by a hash of the id."""
    sample = anchors.orderBy(uniform(F.col("id"), F.lit("centre")), "id").limit(SAMPLE).select("vector").toArrow().column("vector")
    points = matrix(sample)
    centres = centres_of(points, min(CENTRES, math.ceil(count / GROUP)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("vector"), centres.shape[1])[:, : centres.shape[1]]
            cluster = np.argmax(directions(vectors)[0] @ centres.T, axis=1)
            yield batch.append_column("cluster", pa.array(cluster.astype(np.int32)))

    marked = written(anchors.mapInArrow(nearest, "id long, label long, vector array<long>, cluster int"), "negatives-anchors")
    sizes = {r["cluster"]: r["n"] for r in marked.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    slices = [max(1, math.ceil(sizes.get(k, 0) / GROUP)) for k in range(len(centres))]
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    own = F.pmod(F.xxhash64(F.col("id"), F.lit("slice")), pick(slices)).cast("int")
    return marked.select("id", "label", "vector", (pick([sum(slices[:k]) for k in range(len(slices))]) + own).alias("group")), sum(slices)


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the rows (id, label, vector), whole numbers.

    An anchor's positives are its best `positives` rows of its label. For each, the best `negatives` rows of other labels that
    score between `low` and `high` percent of the positive's score are returned, from rank 1.
    """
    table = written(_plain(rows.select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<long>"))), "negatives-rows")
    anchors = table.where(is_anchor)
    blocks, count = math.ceil(max(1, table.count()) / BLOCK), anchors.count()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return rows.sparkSession.createDataFrame([], out)
    anchors, groups = grouped(anchors, count)
    block = F.pmod(F.xxhash64(F.col("id"), F.lit("block")), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = table.select("id", "label", "vector", block.alias("block"), every(groups).alias("group")).groupBy("group", "block")

    def listed(left: pa.Table, right: pa.Table) -> tuple[SharedList, np.ndarray, np.ndarray] | None:
        if not left.num_rows or not right.num_rows:
            return None
        width = max(matrix(left.column("vector")).shape[1], matrix(right.column("vector")).shape[1])
        own, other = (matrix(t.column("vector"), width) for t in (left, right))
        shared = SharedList(own, right.column("id").to_numpy(), right.column("label").to_numpy(), other)
        return shared, left.column("id").to_numpy(), left.column("label").to_numpy()

    near = "anchor_id long, positive_id long, positive_score long"

    def first_walk(left: pa.Table, right: pa.Table) -> pa.Table:
        if (cell := listed(left, right)) is None:
            return pa.table({n: pa.array([], pa.int64()) for n in ("anchor_id", "positive_id", "positive_score")})
        shared, ids, labels = cell
        best = positives_in(shared, ids, labels, positives)
        return pa.table({"anchor_id": ids[best.owner], "positive_id": best.ids, "positive_score": best.score})

    def second_walk(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        if (cell := listed(left, right)) is None:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        shared, ids, labels = cell
        own = left.column("positives").to_pylist()
        bands = np.array([[band_of(p["positive_score"], low, high) for p in mine] + [(TOP, -TOP)] * (positives - len(mine)) for mine in own], np.int64)
        best = negatives_in(shared, labels, bands, negatives)
        member, band = np.divmod(best.owner, positives)
        chosen = [own[m][k] for m, k in zip(member.tolist(), band.tolist(), strict=True)]
        columns = [ids[member], [c["positive_id"] for c in chosen], best.ids, [c["positive_score"] for c in chosen], best.score]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    def ranked(found: DataFrame, by: list[str], score: str, other: str) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(other))))

    spread = anchors.withColumn("block", every(blocks)).groupBy("group", "block")
    found = spread.cogroup(candidates).applyInArrow(first_walk, near)
    own = written(ranked(found, ["anchor_id"], "positive_score", "positive_id").where(F.col("rank") <= positives), "negatives-positives")
    own = own.groupBy(F.col("anchor_id").alias("of")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    spread = anchors.join(own, F.col("id") == F.col("of")).drop("of").withColumn("block", every(blocks)).groupBy("group", "block")
    found = spread.cogroup(candidates).applyInArrow(second_walk, near.replace("positive_score", "negative_id long, positive_score") + ", negative_score long")
    found = ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id").where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def prepared(embeddings: DataFrame) -> DataFrame:
    """(id, label, vector) of a table of vec_id, label and embedding: the labels that the query changes, components in 256ths."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return rows.select(F.col("vec_id").alias("id"), moved.alias("label"), F.transform(vector, lambda x: F.floor(256 * x)).alias("vector"))


SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
        list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES})
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b)::INT AS "rank",
    s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
QUALIFY "rank" <= {NEGATIVES}
"""
