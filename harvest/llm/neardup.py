"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link at `radius` or fewer differing bits. Correlated bits are put together into eight blocks, from the
joint counts of all fingerprints. Dynamic programming over the blocks cuts them into parts and gives each part a threshold of
its own, so that (threshold + 1) adds up to radius + 1 over the parts and the estimated number of probes and candidates is
least: two linked fingerprints then differ within the threshold in one part at least. Each fingerprint is indexed by the
value of each part and probes the values within the threshold; candidates are verified on all bits.

A value that very many fingerprints share (near copies of one text) would give the square of their number. Fingerprints that
meet such a value are linked by an exact way without pairs: two fingerprints differ in 2 bits or fewer just if they share a
point at distance 1 or less from both, so each names its 65 points and the at most 65 fingerprints of a point are linked.

Null and empty texts have no word and the fingerprint zero, which links like any other. Equal texts have equal fingerprints,
and a fingerprint enters the search once, however often it occurs. Rows without a doc_id take part; a group of such rows alone
has a null component_id. An empty table gives an empty table; columns of any other name are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from harvest.llm.common import free_names, quoted
from harvest.llm.components import components
from harvest.sources.scratch import written

SHINGLE = 3
SEED = 42
RADIUS = 2
BLOCK_BITS = 8
#: A candidate weighs so many probes: it is joined, verified, and their number grows with the square of the rows.
CANDIDATE_COST = 64
#: Values with more fingerprints than this are linked without pairs.
CROWDED = 32


def fingerprint(text: str | None) -> int:
    """64 bits as a signed number: bit i is 1 if set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), len(words)
    if size <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, size) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: size - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, size - SHINGLE + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(t) for t in texts], dtype="int64")


def with_fingerprint(docs: DataFrame, to: str = "bits", text: str = "text") -> DataFrame:
    return docs.withColumn(to, _fingerprints(F.coalesce(quoted(text), F.lit(""))))


def hex_digits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _bit_matrix(values: pd.Series) -> np.ndarray:
    return np.unpackbits(values.to_numpy(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_blocks(prints: DataFrame) -> list[list[int]]:
    """Eight blocks of eight bits; correlated bits lie together. Only the 64 x 64 joint counts reach the driver."""

    def joint(batches):
        total, rows = np.zeros((64, 64)), 0
        for batch in batches:
            bits = _bit_matrix(batch["bits"]).astype(np.float32)
            total += bits.T @ bits
            rows += len(bits)
        yield pd.DataFrame({"place": np.arange(4097), "n": np.append(total.ravel(), rows)})

    counts = np.zeros(4097)
    for r in prints.select("bits").mapInPandas(joint, "place int, n double").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    rows, both = max(1.0, counts[-1]), counts[:-1].reshape(64, 64)
    share = np.diag(both) / rows
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(both / rows - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, blocks = set(range(64)), []
    while free:
        left = sorted(free)
        first = max(left, key=lambda i: (related[i, left].sum(), -i))
        block = [first]
        free.remove(first)
        while len(block) < BLOCK_BITS:
            best = max(sorted(free), key=lambda i: (related[i, block].sum(), -i))
            block.append(best)
            free.remove(best)
        blocks.append(block)
    return blocks


def distance_shares(prints: DataFrame, blocks: list[list[int]]) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each block the share of pairs that differ there in 0, 1 or 2 bits. 256 counts a block reach the driver."""

    def histogram(batches):
        counts = np.zeros((len(blocks), 1 << BLOCK_BITS), np.int64)
        for batch in batches:
            bits = _bit_matrix(batch["bits"]).astype(np.int64)
            for b, places in enumerate(blocks):
                counts[b] += np.bincount(bits[:, places] @ (1 << np.arange(BLOCK_BITS)), minlength=1 << BLOCK_BITS)
        yield pd.DataFrame({"place": np.arange(counts.size), "n": counts.ravel()})

    counts = np.zeros(len(blocks) << BLOCK_BITS)
    for r in prints.select("bits").mapInPandas(histogram, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    counts = counts.reshape(len(blocks), -1)
    rows = int(counts[0].sum())
    values = np.arange(1 << BLOCK_BITS)
    masks = [[m for m in range(1 << BLOCK_BITS) if m.bit_count() == d] for d in range(3)]
    shares = [[sum(float(c @ c[values ^ m]) for m in group) / max(1, rows) ** 2 for group in masks] for c in counts]
    return rows, np.array(shares)


def allot(rows: int, shares: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """Parts as (first block, end block, threshold), of the least estimated cost.

    Blocks count as independent, so the distances of a part are the convolution of those of its blocks. A part with
    threshold t uses t + 1 of the radius + 1 units that the pigeonhole principle has; thresholds are 0 or 1.
    """
    n = len(shares)

    def cost(first: int, end: int, threshold: int) -> float:
        near = np.array([1.0, 0.0, 0.0])
        for b in range(first, end):
            near = np.convolve(near, shares[b])[:3]
        width = (end - first) * BLOCK_BITS
        return rows * (1 + width / 2 * threshold) + CANDIDATE_COST * rows**2 / 2 * float(near[: threshold + 1].sum())

    best: dict[tuple[int, int], tuple[float, list]] = {(0, 0): (0.0, [])}
    for end in range(1, n + 1):
        for units in range(1, radius + 2):
            choices = [
                (best[first, units - t - 1][0] + cost(first, end, t), [*best[first, units - t - 1][1], (first, end, t)])
                for first in range(end)
                for t in (0, 1)
                if (first, units - t - 1) in best
            ]
            if choices:
                best[end, units] = min(choices)
    return best[n, radius + 1][1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bits(places: list[int]) -> Column:
    return F.array(*(F.lit(_signed(1 << p)).cast("long") for p in places))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links that connect all fingerprints of `prints` (bits, distinct) that differ in `radius` or fewer bits."""
    if not 0 <= radius <= 2:
        raise ValueError("the exact way for crowded values serves radius 2 or less")
    blocks = bit_blocks(prints)
    rows, shares = distance_shares(prints, blocks)
    parts = [([p for b in blocks[first:end] for p in b], t) for first, end, t in allot(rows, shares, radius)]
    masks = [sum(1 << p for p in places) for places, _ in parts]
    bits = F.col("bits")

    def value(bits: Column, k: int) -> Column:
        return F.struct(F.lit(k).alias("part"), bits.bitwiseAND(F.lit(_signed(masks[k])).cast("long")).alias("value"))

    index = prints.select("bits", F.explode(F.array(*(value(bits, k) for k in range(len(parts))))).alias("key")).select("bits", "key.*")
    # A pair that differs in one bit of a part is found once: from the side that has a 0 there.
    def flipped(k: int) -> Column:
        zeros = F.filter(_bits(parts[k][0]), lambda b: bits.bitwiseAND(b) == 0)
        return F.transform(zeros, lambda b: value(bits.bitwiseOR(b), k))

    flips = [flipped(k) for k in range(len(parts)) if parts[k][1]]
    probes = prints.select("bits", F.explode(F.concat(*flips)).alias("key")).select("bits", "key.*") if flips else index.limit(0)
    crowded = written(index.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).drop("n"), "simhash-crowded")
    seen = index.withColumn("probe", F.lit(False)).union(probes.withColumn("probe", F.lit(True)))
    mark = crowded.withColumn("crowd", F.lit(True))
    seen = seen.join(mark, ["part", "value"], "left")
    calm, busy = seen.where("crowd is null"), seen.where("crowd")
    left = calm.select("part", "value", F.col("bits").alias("u"), "probe")
    right = calm.where("not probe").select("part", "value", F.col("bits").alias("v"))
    differ = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    pairs = left.join(right, ["part", "value"]).where((F.col("probe") | (F.col("u") < F.col("v"))) & (F.col("u") != F.col("v")) & (differ <= radius)).select("u", "v")
    around = F.concat(F.array(bits), F.transform(_bits(list(range(64))), lambda b: bits.bitwiseXOR(b)))
    points = busy.select("bits").distinct().select("bits", F.explode(around).alias("point"))
    # At most 65 different fingerprints lie within distance 1 of a point.
    met = points.groupBy("point").agg(F.collect_set("bits").alias("near")).where(F.size("near") > 1)
    star = met.select(F.array_min("near").alias("v"), F.explode("near").alias("u")).where("u <> v")
    if radius < 2:  # two fingerprints differ in one bit just if one of them is a point of the other
        star = met.where(F.array_contains("near", F.col("point")) & (F.lit(radius) == 1)).select(F.col("point").alias("v"), F.explode("near").alias("u")).where("u <> v")
    return pairs.union(star.select("u", "v")).distinct()


def groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, bits and component_id (the smallest doc_id reachable over links) of every row of `docs` (doc_id, text)."""
    prints = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "bits"), "simhash")
    distinct = written(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    linked = components(links(distinct, radius))
    member = linked.join(distinct, F.col("node") == F.col("bits")).select("node", "root", "first")
    named = member.groupBy("root").agg(F.min("first").alias("component")).withColumnRenamed("root", "head")
    # Only links between different texts are here; most fingerprints have none.
    renamed = member.join(named, F.col("root") == F.col("head")).select(F.col("node").alias("print"), "component")
    named_all = distinct.join(renamed, F.col("bits") == F.col("print"), "left").select(F.col("bits").alias("print"), F.coalesce("component", "first").alias("component_id"))
    return prints.join(written(named_all, "simhash-named"), F.col("bits") == F.col("print")).select("doc_id", "bits", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of `docs` (doc_id, text) for each group of linked fingerprints: the one with the smallest doc_id.

    Rows without a doc_id come last; of equal doc_ids the smallest row by its other columns stays, so reruns keep the same row.
    """
    bits, root, rank = free_names(docs, 3)
    prints = written(with_fingerprint(docs, bits), "simhash-rows")
    roots = components(links(written(prints.select(F.col(bits).alias("bits")).distinct(), "simhash-distinct"), radius))
    rooted = prints.join(roots.select("node", F.col("root").alias(root)), F.col(bits) == F.col("node"), "left").withColumn(root, F.coalesce(root, bits))
    return first_of_each(rooted.drop("node"), root, rank).select(*(quoted(c) for c in docs.columns))


def first_of_each(rows: DataFrame, group: str, rank: str) -> DataFrame:
    """The first row of each group by doc_id (null last) and a 128-bit hash of the row.

    The first is found by partial aggregation over small columns, so that a group of a third of all rows meets in no task.
    """
    own = rows.columns
    whole = F.struct(*(quoted(c) for c in own))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(F.lit(1), whole).alias("one"), F.xxhash64(F.lit(2), whole).alias("two"))
    ranked = rows.withColumn(rank, order)
    first = ranked.groupBy(F.col(group).alias("__of")).agg(F.min(rank).alias("__first"))
    kept = ranked.join(first, (F.col(group) == F.col("__of")) & F.col(rank).eqNullSafe(F.col("__first")), "left_semi")
    # Only rows that are equal in every column are left with equal ranks.
    return kept.dropDuplicates([group, rank])
