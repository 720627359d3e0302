"""Removal of passages that occur in an earlier document, by bucket-pointer refinement of suffixes.

A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller doc_id. Strings are sorted by
bucket-pointer refinement: buckets of 8-byte prefixes first, then every bucket with several members is refined by sorting on the
bucket pointers some bytes later, and the new pointers are what the next round reads. A round doubles the sorted depth, so four
rounds sort 50 bytes; buckets of one member are not looked at again.

The suffixes of a corpus do not fit in one task, so equal strings are brought together first. Each window of `length` bytes has a
mark, its 16-byte piece of least hash. The mark depends on the window alone, so equal windows have equal marks, and the windows of
one mark lie in a row: a segment. Only segments whose mark occurs in two documents are shuffled, by their mark, and the refinement
sorts the suffixes of one block of marks at a time. A mark or segment that a task meets in several documents leaves the task
once. Marks of very many documents (`hot_marks`, of which there are at most MOST_HOT by construction) are split: each of
their windows travels alone, by its own bytes, so no group grows with the documents that share a mark.

Equal texts enter once, with their smallest doc_id; the others lose all bytes if they have `length` of them.

Null texts are empty; a text below `length` bytes loses nothing. Rows without a doc_id lose nothing and cause no removal. Rows that
repeat a doc_id are judged each, against smaller ids only; documents are told apart by a 64-bit hash of id and text. An empty
table gives an empty table. doc_id is a whole number; columns of any other name are left alone, the results replace columns of
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.sources.scratch import written

LENGTH = 50
#: Bytes of a mark: two words of eight.
GRAM = 16
#: Places that are hashed at a time; their numbers fit in the low bits of a sort key.
SLICE = 1 << 20
LOW = np.uint64((1 << 21) - 1)
#: Bytes of text that meet before equal segments leave a task once.
GATHER = 16 << 20
#: Bytes of segments that one refinement sorts, more only if one mark has more.
BLOCK = 1 << 20
#: Documents of one task's batch from which a mark is counted as possibly hot, documents of all from which it is, and the most such marks.
OFTEN, HOT, MOST_HOT = 16, 2000, 1_000_000

FOUND = "n_bytes long, n_removed long, n_spans long, kept binary"


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; one more at the end."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data if data is not None else b"", np.uint8), bounds


def words_at(data: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), kind, padded.data, 0, (1,)).astype(np.uint64)


def _hashes(data: np.ndarray) -> np.ndarray:
    word = words_at(data, "<u8")
    h = word[: len(data) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15) + word[8 : len(data) - GRAM + 9] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def marks(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, place of the mark, its hash) of every segment; places count from the begin of `data`.

    The lowest bit of a hash is free for the use of callers.
    """
    found = [(np.zeros(0, np.int64),) * 5]
    wide = length - GRAM + 1
    for begin in range(int(bounds[0]), int(bounds[-1]) - length + 1, SLICE):
        stop = min(begin + SLICE + length - 1, int(bounds[-1]))
        h = _hashes(data[begin:stop])
        least, size = h & ~LOW | np.arange(len(h), dtype=np.uint64), 1
        while size < wide:
            step = min(size, wide - size)
            least, size = np.minimum(least[:-step], least[step:]), size + step
        first, last = np.searchsorted(bounds, [begin, begin + len(least) - 1], "right") - 1
        cuts = np.clip(bounds[first : last + 2], begin, begin + len(least))
        text = np.repeat(np.arange(first, last + 1), np.diff(cuts))
        at = np.flatnonzero(begin + np.arange(len(least)) + length <= bounds[text + 1])
        if not at.size:
            continue
        mark, text = (least[at] & LOW).astype(np.int64), text[at]
        new = np.append(True, (mark[1:] != mark[:-1]) | (text[1:] != text[:-1]))
        firsts = np.flatnonzero(new)
        code = h[mark[firsts]].view(np.int64) & ~1
        found.append((text[firsts], begin + at[firsts], np.diff(np.append(firsts, len(at))), begin + mark[firsts], code))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(5))


def _gathered(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that have a doc_id, in stretches of about GATHER bytes."""
    batch = batch.filter(batch.column("doc_id").is_valid())
    if not batch.num_rows:
        return
    sizes = batch.column("text").cast(pa.large_binary())
    _, bounds = bytes_of(sizes)
    part = (bounds[:-1] - bounds[0]) // GATHER
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], batch.num_rows), strict=True):
        yield batch.slice(a, b - a)


def _marks_by_key(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each (mark, key) of a batch once, sorted; where a mark begins, and its number of keys."""
    text, _, _, _, code = marks(*bytes_of(batch.column("text")), length)
    key = batch.column("key").to_numpy()[text]
    order = np.lexsort((key, code))
    code, key = code[order], key[order]
    new = np.append(True, (code[1:] != code[:-1]) | (key[1:] != key[:-1]))[: len(code)]
    code, key = code[new], key[new]
    begins = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    return code, key, begins, np.diff(np.append(begins, len(code)))


def hot_marks(keyed: DataFrame, length: int = LENGTH) -> np.ndarray:
    """Marks of very many documents. They need HOT documents, and one in MOST_HOT of all bytes, so at most MOST_HOT reach the driver."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _gathered(whole):
                code, _, begins, counts = _marks_by_key(batch, length)
                many = counts >= OFTEN
                yield pa.RecordBatch.from_arrays([pa.array(code[begins[many]]), pa.array(counts[many])], ["code", "n"])

    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = keyed.select("doc_id", "key", "text").mapInArrow(often, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    hot = counts.where(F.col("n") >= max(HOT, size // MOST_HOT)).select("code").toPandas()
    return np.sort(hot["code"].to_numpy(np.int64))


def shared_marks(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, code): the marks of every text that another text has too; a few that none has, where hashes are equal.

    A mark that a batch has in several texts is shared; two of them go on to tell the texts of other batches, the rest are
    spread by their key.
    """

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _gathered(whole):
                code, key, begins, counts = _marks_by_key(batch, length)
                known = np.arange(len(code)) - np.repeat(begins, counts) >= 2
                # By key: equal neighbours are shuffled as less.
                order = np.lexsort((code, key))
                yield pa.RecordBatch.from_arrays([pa.array(key[order]), pa.array((code & ~1 | known)[order])], ["key", "mark"])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_code, held_key = np.zeros(0, np.int64), np.zeros(0, np.int64)
        open_code = None
        for batch in batches:
            mark, key = batch.column("mark").to_numpy(), batch.column("key").to_numpy()
            code, known = mark & ~1, (mark & 1).astype(bool)
            done_code, done_key = code[known], key[known]
            code, key = np.append(held_code, code[~known]), np.append(held_key, key[~known])
            if len(code):
                begins = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                counts = np.diff(np.append(begins, len(code)))
                shared = key[begins] != key[begins + counts - 1]
                shared |= code[begins] == open_code if open_code is not None else False
                take = np.repeat(shared, counts)
                # The last mark may go on in the next batch. Of one key so far, one row of it is enough.
                open_code = code[-1] if shared[-1] else None
                held = slice(len(code) - (not shared[-1]), len(code))
                held_code, held_key = code[held], key[held]
                done_code, done_key = np.append(done_code, code[take]), np.append(done_key, key[take])
            yield pa.RecordBatch.from_arrays([pa.array(done_key), pa.array(done_code)], ["key", "code"])

    # Sorted, so that a task that runs again makes the same batches and sends the same rows.
    rows = keyed.select("doc_id", "key", "text").sortWithinPartitions("key").mapInArrow(seen, "key long, mark long")
    place = F.when(F.col("mark").bitwiseAND(1) == 1, F.col("key")).otherwise(F.col("mark"))
    spread = rows.repartition(place).sortWithinPartitions("mark", "key")
    return spread.mapInArrow(judged, "key long, code long")


SEGMENT = "mark int, segment binary, doc_id long, key long, starts binary, spans binary"
SEGMENT_NAMES = ["mark", "segment", "doc_id", "key", "starts", "spans"]
#: The mark of a window that travels alone.
ALONE = -1


def place() -> Column:
    """What equal windows of segments have in common: the bytes of the mark, or the whole window."""
    mark = F.when(F.col("mark") == ALONE, F.col("segment")).otherwise(F.substring(F.col("segment"), F.col("mark") + 1, F.lit(GRAM)))
    return F.when(F.col("segment").isNull(), F.col("key")).otherwise(F.xxhash64(mark))


def segments(texts: DataFrame, hot: np.ndarray, length: int = LENGTH) -> DataFrame:
    """The segments of shared marks: where the mark lies in them, their bytes, and where they start in their text.

    `texts` has doc_id, key, text and codes. A segment that a batch has in several texts goes on with the smallest doc_id; in the
    texts of larger ids all its windows are removed, which a row with spans alone tells.
    """

    def chosen(batch: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        text, lo, n, mark, code = marks(data, bounds, length)
        lists = batch.column("codes").cast(pa.large_list(pa.int64()))
        owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        mix = lambda code, text: code * np.int64(0x2545F4914F6CDD1D) + text  # noqa: E731  an equal sum only makes a candidate
        with np.errstate(over="ignore"):
            take = np.isin(mix(code, text), mix(lists.flatten().to_numpy(), owner))
        text, lo, n, mark, code = (x[take] for x in (text, lo, n, mark - lo, code))
        split = np.isin(code, hot)
        if split.any():  # each window for itself
            row, nth = _pairs(n[split])
            each = np.flatnonzero(split)[row]
            alone = (text[each], lo[each] + nth, np.ones(len(each), np.int64), np.full(len(each), ALONE))
            text, lo, n, mark = (np.append(x[~split], y) for x, y in zip((text, lo, n, mark), alone, strict=True))
        return text, lo, n, mark

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _gathered(whole):
                data, bounds = bytes_of(batch.column("text"))
                text, lo, n, mark = chosen(batch, data, bounds)
                ids, keys, raw = batch.column("doc_id").to_numpy(), batch.column("key").to_numpy(), data.tobytes()
                own = [raw[a:b] for a, b in zip(lo.tolist(), (lo + n + length - 1).tolist(), strict=True)]
                least: dict[bytes, int] = {}
                for s, i in zip(own, ids[text].tolist(), strict=True):
                    if least.setdefault(s, i) > i:
                        least[s] = i
                goes = np.array([least[s] for s in own], np.int64) < ids[text]
                starts: dict[tuple[int, bytes, int], list[int]] = {}
                local = lo - bounds[text]
                stays = np.flatnonzero(~goes)
                for r, t, a, m in zip(stays.tolist(), text[stays].tolist(), local[stays].tolist(), mark[stays].tolist(), strict=True):
                    starts.setdefault((t, own[r], m), []).append(a)
                t = np.fromiter((t for t, *_ in starts), np.int64, len(starts))
                columns = [
                    pa.array([m for *_, m in starts], pa.int32()),
                    pa.array([s for _, s, _ in starts], pa.binary()),
                    pa.array(ids[t], pa.int64()),
                    pa.array(keys[t], pa.int64()),
                    pa.array([np.array(x, "<i4").tobytes() for x in starts.values()], pa.binary()),
                    pa.nulls(len(starts), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, SEGMENT_NAMES)
                gone = np.flatnonzero(goes)
                yield _span_rows(ids, keys, text[gone], local[gone], local[gone] + n[gone] + length - 1, full=True)

    return texts.select("doc_id", "key", "text", "codes").sortWithinPartitions("key").mapInArrow(cut, SEGMENT)


def _span_rows(ids: np.ndarray, keys: np.ndarray, text: np.ndarray, begin: np.ndarray, end: np.ndarray, full: bool = False) -> pa.RecordBatch:
    """One row for each text of `text`, with its (begin, end) pairs of 32 bits."""
    order = np.argsort(text, kind="stable")
    text, pairs = text[order], np.stack([begin[order], end[order]], 1).astype("<i4")
    firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1])[: len(text)])
    offsets = np.append(firsts, len(text)).astype(np.int32) * 8
    spans = pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pairs.tobytes())])
    named = {"doc_id": pa.array(ids[text[firsts]], pa.int64()), "key": pa.array(keys[text[firsts]], pa.int64()), "spans": spans}
    if full:
        none = pa.nulls(len(firsts), pa.binary())
        named = dict(zip(SEGMENT_NAMES, [pa.nulls(len(firsts), pa.int32()), none, named["doc_id"], named["key"], none, spans], strict=True))
    return pa.RecordBatch.from_arrays([*named.values()], [*named])


def pointers(data: np.ndarray, length: int) -> np.ndarray:
    """Bucket pointers of all places of `data`: equal just for places whose next `length` bytes are equal, and in their order.

    What follows the end counts as zeros; places less than `length` before the end are no use to a caller.
    """
    word, n = words_at(data, ">u8"), len(data)
    order = np.argsort(word, kind="stable")
    sorted_words = word[order]
    new = np.append(True, sorted_words[1:] != sorted_words[:-1])[:n]
    begins = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    pointer = np.zeros(n + length, np.int64)
    pointer[order] = begins
    several = ~(new & np.append(new[1:], True))
    active, depth = order[several], 8
    while depth < length and active.size:
        step = min(depth, length - depth)
        key = pointer[active] * (n + 1) + pointer[active + step]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        places = np.arange(len(active))
        old = pointer[active]
        first = np.append(True, old[1:] != old[:-1])
        new = np.append(True, key[1:] != key[:-1])
        # A part of a bucket points as far behind the pointer of the bucket as members come before it.
        pointer[active] = old + np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(first, places, 0))
        active, depth = active[~(new & np.append(new[1:], True))], depth + step
    return pointer[:n]


def _pairs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number within the row) for `counts[row]` numbers of each row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def removed_windows(segment: pa.Array, doc_id: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, end) of the runs of windows in `segment` rows that also occur in a row of a smaller doc_id."""
    known = segment.dictionary_encode()
    which, distinct = known.indices.to_numpy().astype(np.int64), known.dictionary
    data, bounds = bytes_of(distinct)
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, which, doc_id)
    counts = np.diff(bounds) - length + 1
    owner, nth = _pairs(counts)
    pointer = pointers(data[bounds[0] : bounds[-1]], length)[bounds[owner] - bounds[0] + nth]
    order = np.argsort(pointer, kind="stable")
    first = np.flatnonzero(np.append(True, pointer[order][1:] != pointer[order][:-1]))
    smallest = np.empty(len(pointer), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(least[owner[order]], first), np.diff(np.append(first, len(order))))
    begins = np.cumsum(counts) - counts
    row, nth = _pairs(counts[which])
    gone = smallest[begins[which[row]] + nth] < doc_id[row]
    same = np.append(False, row[1:] == row[:-1])
    opens = np.flatnonzero(gone & ~(same & np.append(False, gone[:-1])))
    closes = np.flatnonzero(gone & ~np.append(same[1:] & gone[1:], False))
    return row[opens], nth[opens], nth[closes] + 1


def verdicts(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, key, spans): the removed bytes of texts, as (begin, end) pairs of 32 bits."""

    def refined(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids, keys = rows.column("doc_id").to_numpy(), rows.column("key").to_numpy()
        row, first, end = removed_windows(rows.column("segment").combine_chunks(), ids, length)
        starts, bounds = bytes_of(rows.column("starts").combine_chunks())
        starts, bounds = starts[bounds[0] : bounds[-1]].view("<i4"), (bounds - bounds[0]) // 4
        run, nth = _pairs(np.diff(bounds)[row])
        at = starts[bounds[row[run]] + nth].astype(np.int64)
        name = pd.factorize(pd.MultiIndex.from_arrays([keys[row[run]], ids[row[run]]]))[0] if len(run) else run
        head = np.zeros(name.max() + 1 if len(name) else 0, np.int64)
        head[name] = row[run]
        return _span_rows(ids[head], keys[head], name, at + first[run], at + end[run] + length - 1)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            told = batch.filter(batch.column("spans").is_valid())
            if told.num_rows:
                yield told.select(["doc_id", "key", "spans"])
            rows = batch.filter(batch.column("segment").is_valid())
            if not rows.num_rows:
                continue
            places = rows.column("place").to_numpy()
            before = np.append(0, np.cumsum(np.diff(bytes_of(rows.column("segment"))[1])))
            goes_on = bool(held) and held[-1].column("place")[held[-1].num_rows - 1].as_py() == places[0]
            cuts = np.append(np.zeros(0 if goes_on else 1, np.int64), np.flatnonzero(places[1:] != places[:-1]) + 1)
            begin = 0
            while (nth := np.searchsorted(before[cuts], before[begin] + BLOCK - size)) < len(cuts):
                held.append(rows.slice(begin, cuts[nth] - begin))
                yield refined(pa.Table.from_batches(held))
                held, size, begin = [], 0, cuts[nth]
            held.append(rows.slice(begin))
            size += int(before[-1] - before[begin])
        if held:
            yield refined(pa.Table.from_batches(held))

    placed = cut.repartition(place()).withColumn("place", place()).sortWithinPartitions("place")
    return placed.mapInArrow(judged, "doc_id long, key long, spans binary")


def _rest(raw: bytes, spans: list[bytes]) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs, and the bytes that stay."""
    pairs = np.frombuffer(b"".join(spans), "<i4").reshape(-1, 2)
    if not len(pairs):
        return 0, 0, raw
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    upto = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > upto[:-1])
    begins, ends = pairs[new, 0].tolist(), upto[np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1)].tolist()
    kept = b"".join(raw[a:b] for a, b in zip([0, *ends], [*begins, len(raw)], strict=True))
    return len(raw) - len(kept), len(begins), kept


def _outcome(length: int):
    @F.pandas_udf(FOUND)
    def outcome(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, spans, copies in batches:
            rows = []
            for text, own, is_copy in zip(texts, spans, copies, strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                if is_copy and len(raw) >= length:
                    rows.append((len(raw), len(raw), 1, b""))
                else:
                    rows.append((len(raw), *_rest(raw, [] if own is None else list(own))))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return outcome


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` (doc_id, text) with n_bytes, n_removed, n_spans (maximal removed runs) and kept, the bytes that stay."""
    if length < GRAM + 1:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    names = docs.columns
    flat = docs.toDF(*(f"__{i}" for i in range(len(names))))
    doc_id = F.col(f"__{names.index('doc_id')}").cast("long")
    text = F.coalesce(F.col(f"__{names.index('text')}").cast("string"), F.lit(""))
    keyed = flat.withColumn("__key", F.xxhash64(doc_id, F.xxhash64(text)))
    plain = lambda df: df.select(doc_id.alias("doc_id"), F.col("__key").alias("key"), text.alias("text"))
    firsts = flat.groupBy(F.xxhash64(text).alias("one"), F.xxhash64(F.lit(length), text).alias("other")).agg(F.min(doc_id).alias("first"))
    firsts = firsts.where("first is not null").select(F.xxhash64("first", "one").alias("first_key"), "first")
    firsts = written(firsts, "repeats-firsts")
    hot = hot_marks(plain(keyed), length)
    # The key alone is the join key, so that one partitioning serves; ids are compared beside it.
    heads = plain(keyed).join(firsts.hint("shuffle_hash"), (F.col("key") == F.col("first_key")) & F.col("doc_id").bitwiseXOR(F.col("first")).eqNullSafe(0))
    codes = shared_marks(heads, length).groupBy(F.col("key").alias("of")).agg(F.collect_list("code").alias("codes"))
    codes = written(codes, "repeats-marks")
    told = verdicts(segments(heads.join(codes.hint("shuffle_hash"), F.col("key") == F.col("of")), hot, length), length)
    told = written(told, "repeats-spans").select(F.col("key").alias("of"), F.col("doc_id").alias("id"), "spans")
    told = told.union(firsts.select("first_key", "first", F.lit(None).cast("binary")))
    by_text = told.repartition("of").groupBy("of", "id").agg(F.collect_list("spans").alias("spans"))
    same = (F.col("__key") == F.col("of")) & doc_id.bitwiseXOR(F.col("id")).eqNullSafe(0)
    joined = keyed.join(by_text.hint("shuffle_hash"), same, "left")
    found = joined.withColumn("__found", _outcome(length)(text, F.col("spans"), F.col("of").isNull() & doc_id.isNotNull()))
    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    return found.select(*(F.col(f"__{i}").alias(n) for i, n in enumerate(names) if n not in added), *(F.col(f"__found.{a}").alias(a) for a in added))
