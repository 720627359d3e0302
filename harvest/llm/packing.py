"""Packing into sequences by deficit round-robin over source queues.

The documents of a source form a queue, each text followed by an end id. Every sequence takes from each queue its share of the
tokens, in quanta; what rounding withholds from a queue is its deficit and carries to the next sequences. Shares can be given as
targets: sequences hold them until a queue runs dry, then the rest share anew by their targets, and queues without a target follow
when those with one are dry. Without targets the shares are those of the queues' tokens, at which all queues run dry together:
the mix of the whole holds in every sequence, and nothing is left over.

The round-robin runs over a binary tree of the sources. Of the first c quanta that reach a node, floor(c * left / both) go left:
the deficit of a subtree is below one quantum after every quantum. This closed form tells how many quanta each queue has given
after any number of sequences, so the deficits carry across sequences and partitions without a pass through them in order: a
document's place in its queue determines its pieces, their sequences and offsets. The place is a running sum over chunks of the
stored token table. What remains of each queue after its last whole quantum fills the last sequences.

Null and empty texts give one end id. A null source is a queue of its own. Repeated rows are packed each. An empty table gives
no pieces; columns of any other name are ignored. The driver holds one pair of numbers for each source, and for each source with a
target one number for every time that one of them runs dry, hence `MOST_TARGETS`. Targets of sources that have no rows count for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvest.llm.tokens import VOCABULARY, Encoder
from harvest.sources.scratch import written

LENGTH = 2048
QUANTUM = 64
END = 1
MOST_SOURCES = 1_000_000
MOST_TARGETS = 1_000
#: Bytes of texts or ids that a task unpacks at once; a longer one is unpacked alone.
AT_ONCE = 4 << 20
#: Products of quanta beyond this need whole numbers of any size.
WIDE = 1 << 31


def slices(batch: pa.RecordBatch, column: str, most: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose values of `column` have about `most` bytes."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for first, stop in zip(cuts, cuts[1:], strict=False):
        if stop > first:
            yield batch.slice(first, stop - first)


def encoded(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """chunk, doc_id, source, local_start, doc_tokens, ids of every row; local_start counts the tokens of its source before it in its chunk."""
    where = path or public_tokenizers.path(VOCABULARY)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = Encoder(where, special_as_text=False), np.array([end], "<u4").tobytes()
        chunk, seen = TaskContext.get().partitionId(), {}
        for batch in (part for whole in batches for part in slices(whole, "text")):
            starts, counts, ids = [], [], []
            for text, source in zip(batch.column("text").to_pylist(), batch.column("source").to_pylist(), strict=True):
                own = encoder.ids(text or "") + last
                starts.append(seen.get(source, 0))
                counts.append(len(own) // 4)
                seen[source] = starts[-1] + counts[-1]
                ids.append(own)
            chunks = pa.array(np.full(len(ids), chunk, np.int32))
            columns = [chunks, batch.column("doc_id"), batch.column("source"), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "doc_id", "source", "local_start", "doc_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), F.col("source").cast("string"))
    return rows.mapInArrow(encode, "chunk int, doc_id long, source string, local_start long, doc_tokens long, ids binary")


class RoundRobin:
    """Closed form of the deficit round-robin over queues of `quanta[i]` quanta."""

    def __init__(self, quanta: list[int]):
        self.quanta, self.all = quanta, sum(quanta)
        self.kind = object if self.all >= WIDE else np.int64
        self.before = [0]
        for q in quanta:
            self.before.append(self.before[-1] + q)
        self.paths: dict[int, list[tuple[bool, int, int]]] = {}

    def path(self, queue: int) -> list[tuple[bool, int, int]]:
        """From the root to a queue: whether it lies left, the quanta of the left child, the quanta of the node."""
        if queue not in self.paths:
            low, high, steps = 0, len(self.quanta), []
            while high - low > 1:
                middle = (low + high) // 2
                left, both = self.before[middle] - self.before[low], self.before[high] - self.before[low]
                steps.append((queue < middle, left, both))
                low, high = (low, middle) if queue < middle else (middle, high)
            self.paths[queue] = steps
        return self.paths[queue]

    def given(self, queue: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quanta of this queue, and of all queues before it, among the first `after`."""
        c, ahead = after.astype(self.kind), np.zeros(len(after), self.kind)
        for is_left, left, both in self.path(queue):
            taken = c * left // both if both else c * 0
            c, ahead = (taken, ahead) if is_left else (c - taken, ahead + taken)
        return c, ahead

    def turn(self, queue: int, quantum: np.ndarray) -> np.ndarray:
        """The place of a queue's quantum among all quanta."""
        c = quantum.astype(self.kind) + 1
        for is_left, left, both in reversed(self.path(queue)):
            c = -(-c * both // left) if is_left else (c - 1) * both // (both - left) + 1
        return c - 1


class Rounds:
    """Round-robins one after the other, each over queues that lie side by side: `quotas[k]` is the first queue of a phase and
    the quanta that it and the next ones give in that phase.
    """

    def __init__(self, quotas: list[tuple[int, list[int]]], queues: int):
        quotas = [(first, n) for first, n in quotas if sum(n)]
        self.phases = [(first, RoundRobin(n)) for first, n in quotas]
        self.begins = np.array([0, *accumulate(robin.all for _, robin in self.phases)], np.int64)
        self.all = int(self.begins[-1])
        self.quanta = [0] * queues
        for first, n in quotas:
            for i, q in enumerate(n, first):
                self.quanta[i] += q
        self.gone: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, quanta: list[int], weights: list[Fraction]) -> Rounds:
        """The first `len(weights)` queues give by their weights until one is dry, and so on; the others follow by their quanta."""
        first, phases, given = len(weights), [], [0] * len(weights)
        for dry in sorted({q / w for q, w in zip(quanta, weights, strict=False)}):
            until = [min(q, int(w * dry)) for q, w in zip(quanta, weights, strict=False)]
            phases.append((0, [u - g for u, g in zip(until, given, strict=True)]))
            given = until
        return cls([*phases, (first, quanta[first:])], len(quanta))

    def _before(self, queue: int) -> tuple[np.ndarray, np.ndarray]:
        """Quanta of this queue, and of all queues before it, that earlier phases gave, for every phase and the end."""
        if queue not in self.gone:
            own, ahead = [0], [0]
            for first, robin in self.phases:
                at = min(max(queue - first, 0), len(robin.quanta))
                own.append(own[-1] + (robin.quanta[at] if first <= queue and at < len(robin.quanta) else 0))
                ahead.append(ahead[-1] + robin.before[at])
            self.gone[queue] = np.array(own, np.int64), np.array(ahead, np.int64)
        return self.gone[queue]

    def given(self, queue: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quanta of this queue, and of all queues before it, among the first `after`."""
        after = np.asarray(after, np.int64)
        phase = np.searchsorted(self.begins, after, "right") - 1
        own, ahead = (x[phase] for x in self._before(queue))
        for k in np.unique(phase[phase < len(self.phases)]):
            (first, robin), at = self.phases[k], np.flatnonzero(phase == k)
            c = after[at] - self.begins[k]
            if first <= queue < first + len(robin.quanta):
                here, before = robin.given(queue - first, c)
                own[at] += here.astype(np.int64)
                ahead[at] += before.astype(np.int64)
            elif queue >= first:
                ahead[at] += c
        return own, ahead

    def turn(self, queue: int, quantum: np.ndarray) -> np.ndarray:
        """The place of a queue's quantum among all quanta."""
        own, quantum = self._before(queue)[0], np.asarray(quantum, np.int64)
        phase, place = np.searchsorted(own, quantum, "right") - 1, np.empty(len(quantum), np.int64)
        for k in np.unique(phase):
            (first, robin), at = self.phases[k], np.flatnonzero(phase == k)
            place[at] = self.begins[k] + robin.turn(queue - first, quantum[at] - own[k]).astype(np.int64)
        return place


def cut(queue: int, starts: np.ndarray, counts: np.ndarray, robin: Rounds, tail_at: int, length: int, quantum: int) -> tuple[np.ndarray, ...]:
    """(document, start in the document, tokens, sequence, offset) of all pieces of documents at `starts` in a queue.

    `tail_at` is the place, among all tokens, of what this queue has beyond its whole quanta.
    """
    whole, each = robin.quanta[queue] * quantum, length // quantum
    ends, found = starts + counts, []
    main = np.flatnonzero(starts < whole)
    if main.size:
        first, stop = starts[main] // quantum, -(-np.minimum(ends[main], whole) // quantum)
        n = stop - first
        doc = np.repeat(main, n)
        q = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        window = robin.turn(queue, q) // each
        new = np.ones(len(q), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (window[1:] != window[:-1])
        at = np.flatnonzero(new)
        until = np.append(at[1:], len(q)) - 1
        doc, window = doc[at], window[at]
        begin = np.maximum(q[at] * quantum, starts[doc])
        end = np.minimum(np.minimum((q[until] + 1) * quantum, ends[doc]), whole)
        here, ahead = robin.given(queue, window * each)
        _, ahead_after = robin.given(queue, np.minimum((window + 1) * each, robin.all))
        offset = (ahead_after - ahead - here) * quantum + begin
        found.append((doc, begin - starts[doc], end - begin, window, offset))
    tail = np.flatnonzero(ends > whole)
    if tail.size:
        begin = np.maximum(starts[tail], whole) - whole + tail_at
        end = ends[tail] - whole + tail_at
        first, last = begin // length, (end - 1) // length
        n = last - first + 1
        doc = np.repeat(tail, n)
        window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        lo, hi = np.maximum(np.repeat(begin, n), window * length), np.minimum(np.repeat(end, n), (window + 1) * length)
        found.append((doc, lo - tail_at + whole - starts[doc], hi - lo, window, lo - window * length))
    return tuple(np.concatenate([f[i].astype(np.int64) for f in found]) for i in range(5))


def pack(
    docs: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    quantum: int = QUANTUM,
    end: int = END,
    targets: Mapping[str | None, float] | None = None,
) -> DataFrame:
    """One row for each piece: doc_id, source, doc_tokens, start, ids (little-endian unsigned 32 bit), sequence_id, offset.

    `targets` gives sources the proportions in which sequences hold their tokens; they need not add up to 1. A source with no
    target, or 0, follows when the others are dry. Left out, the proportions are those of the input.
    """
    if length % quantum:
        raise ValueError("a sequence must hold whole quanta")
    weights = {source: Fraction(w) for source, w in (targets or {}).items()}
    if any(w < 0 for w in weights.values()):
        raise ValueError("targets cannot be negative")
    if len(weights) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    table = written(encoded(docs, path, end), "packing-tokens")
    chunks = table.groupBy("source", "chunk").agg(F.sum("doc_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    bases = written(chunks.withColumn("base", F.coalesce(before, F.lit(0))), "packing-bases")
    totals = bases.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    if totals.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    # Queues with a target come first.
    queues = sorted(totals.collect(), key=lambda r: (not weights.get(r["source"]), r["source"] is None, r["source"]))
    numbers = {r["source"]: i for i, r in enumerate(queues)}
    shares = [w for r in queues if (w := weights.get(r["source"]))]
    robin = Rounds.of([r["tokens"] // quantum for r in queues], shares)
    tails = [robin.all * quantum]
    for r in queues:
        tails.append(tails[-1] + r["tokens"] % quantum)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "ids")):
            queue = np.array([numbers[k] for k in batch.column("source").to_pylist()], np.int64)
            starts, counts = batch.column("start_in_queue").to_numpy(), batch.column("doc_tokens").to_numpy()
            ids = batch.column("ids").to_pylist()
            for k in np.unique(queue):
                own = np.flatnonzero(queue == k)
                doc, start, n, window, offset = cut(int(k), starts[own], counts[own], robin, tails[k], length, quantum)
                rows = own[doc]
                out = [ids[r][4 * s : 4 * (s + m)] for r, s, m in zip(rows.tolist(), start.tolist(), n.tolist(), strict=True)]
                same = pa.array(rows)
                columns = [batch.column(c).take(same) for c in ("doc_id", "source", "doc_tokens")]
                columns += [pa.array(start), pa.array(out, pa.binary()), pa.array(window), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "doc_tokens", "start", "ids", "sequence_id", "offset"])

    place = bases.select(F.col("source").alias("__source"), F.col("chunk").alias("__chunk"), "base")
    placed = table.join(place, F.col("source").eqNullSafe(F.col("__source")) & (F.col("chunk") == F.col("__chunk")))
    placed = placed.select("doc_id", "source", "doc_tokens", (F.col("base") + F.col("local_start")).alias("start_in_queue"), "ids")
    return placed.mapInArrow(pieces, "doc_id long, source string, doc_tokens long, start long, ids binary, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences; one holds `length` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("hex")).select("sequence_id", F.unhex("hex").alias("ids"))
