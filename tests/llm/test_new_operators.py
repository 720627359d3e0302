"""Repeated passages, periodic runs and hard negatives against brute force, with awkward rows and forced splits."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import compare, connect
from harvest.llm import negatives, periods, queries, suffixes

SMALL = "/root/testdata/sf0.001"


# --- repeated passages ---


def without_repeats(rows, length=50):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1 if doc is not None else 0):
            first[raw[i : i + length]] = min(doc, first.get(raw[i : i + length], doc))
    out = []
    for doc, text in rows:
        raw, gone = (text or "").encode(), np.zeros(len((text or "").encode()) + 1, bool)
        for i in range(len(raw) - length + 1 if doc is not None else 0):
            if first[raw[i : i + length]] < doc:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((doc, len(raw), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), kept))
    return Counter(out)


def passages_table():
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [some(25) for _ in range(6)]
    rows = []
    for _ in range(120):
        text = some(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            text += f" {rng.choice(passages)} {some(rng.randint(0, 9))}"
        rows.append((rng.randint(0, 400) * 7 - 500, text))
    rows += [(1000, None), (1001, ""), (None, passages[0]), (5000, "w " * 500), (5001, "w " * 700 + "x"), (5002, "w " * 30)]
    rows += [(1003, rows[0][1]), (1004, rows[0][1]), (1004, rows[0][1]), (1004, rows[1][1]), (-2000, rows[2][1]), (7000, "q" * 49), (7001, "q" * 49)]
    # One passage in a third of the rows, and in rows without an id.
    rows += [(8000 + i, passages[0][:60] + str(i)) for i in range(60)] + [(None, passages[1])] * 20
    return rows


def kept_of(df):
    got = df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return Counter((*r[:4], bytes(r["kept"])) for r in got)


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_brute_force(spark, monkeypatch, small):
    if small:  # hot marks, several blocks and several gatherings
        for name, value in {"HOT": 5, "OFTEN": 3, "BLOCK": 2000, "GATHER": 3000, "SLICE": 700}.items():
            monkeypatch.setattr(suffixes, name, value)
    rows = passages_table()
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, `a.b` string").repartition(5)
    got = suffixes.without_repeats(frame)
    assert got.columns == ["doc_id", "text", "key", "a.b", "n_bytes", "n_removed", "n_spans", "kept"]
    assert kept_of(got) == without_repeats(rows)


def test_repeats_of_other_lengths_and_clashing_names(spark):
    rows = [(3, "abcdefghijklmnopqrstuvwxyz 1"), (2, "0 abcdefghijklmnopqrstuvwxyz"), (1, "cdefghijklmnopqrstuv"), (9, "z" * 70), (8, "z" * 40)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id int, text string, kept int")
    got = suffixes.without_repeats(frame, length=20)
    assert kept_of(got) == without_repeats(rows, 20) and got.columns.count("kept") == 1
    assert suffixes.without_repeats(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="longer"):
        suffixes.without_repeats(frame, length=10)


def test_pointers_sort_and_tell_strings_apart():
    rng = random.Random(3)
    data = bytes(rng.choice(b"ab") for _ in range(400)) + b"ab" * 60 + bytes(rng.choice(b"abc") for _ in range(300))
    for length in (9, 16, 24, 50):
        pointer = suffixes.pointers(np.frombuffer(data, np.uint8), length)
        places = range(len(data) - length + 1)
        strings = [data[i : i + length] for i in places]
        order = sorted(places, key=lambda i: strings[i])
        for a, b in zip(order, order[1:], strict=False):
            assert (pointer[a] == pointer[b]) == (strings[a] == strings[b]) and pointer[a] <= pointer[b]


def test_equal_windows_have_equal_marks():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"xyz ") for _ in range(rng.randint(0, 200))) for _ in range(40)] + [b"", b"aaaa" * 40]
    data, bounds = suffixes.bytes_of(pa.array(texts, pa.binary()))
    text, lo, n, at, code = suffixes.marks(data, bounds)
    mark, seen = {}, Counter()
    for t, a, k, m, c in zip(text.tolist(), lo.tolist(), n.tolist(), at.tolist(), code.tolist(), strict=True):
        for i in range(a, a + k):
            assert i <= m and m + suffixes.GRAM <= i + 50
            assert bounds[t] <= i and i + 50 <= bounds[t + 1]
            seen[t] += 1
            assert mark.setdefault(bytes(data[i : i + 50]), c) == c
    assert all(seen[t] == max(0, len(x) - 49) for t, x in enumerate(texts))


# --- periodic runs ---


def runs(words, least=24, times=3):
    found = set()
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            size = i + p - start
            if size >= max(least, times * p) and all(any(words[k] != words[k + q] for k in range(start, start + size - q)) for q in range(1, p)):
                found.add((start, size, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def lyndon(codes):
    out = []
    for i in range(len(codes)):
        j = i + 1
        while j < len(codes) and codes[j:] > codes[i:]:
            j += 1
        out.append(j - i)
    return out


def test_grouping_gives_lyndon_arrays():
    rng = random.Random(1)
    for _ in range(1500):
        codes = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        assert periods.lyndon_lengths(codes).tolist() == lyndon(codes)


def some_words(rng):
    n, kinds = rng.randint(0, 150), rng.randint(1, 6)
    words = [str(rng.randrange(kinds)) for _ in range(n)]
    for _ in range(rng.randint(0, 2) if n else 0):
        a = rng.randrange(n)
        p, end = 1 + (n - a) // rng.randint(3, 9), rng.randint(a, n)
        words = [words[a + (i - a) % p] if a <= i < end else words[i] for i in range(n)]
    return words


@pytest.mark.parametrize(("least", "times"), [(24, 3), (9, 3), (20, 5)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(2)
    texts = [some_words(rng) for _ in range(500)] + [["a"] * 300, ["a", "b"] * 40 + ["a", "c"] * 40]
    got = periods.runs_in_texts([[w.encode() for w in t] for t in texts], least, times)
    expected = [runs(t, least, times) for t in texts]
    assert got == expected and sum(map(len, expected)) > 100


def test_extensions():
    rng = random.Random(5)
    codes = np.array([rng.randrange(2) for _ in range(200)] + [7] * 100)
    extensions = periods.Extensions(codes)
    a, b = np.array([rng.randrange(300) for _ in range(400)]), np.array([rng.randrange(300) for _ in range(400)])
    ahead, back = extensions.forward(a, b), extensions.backward(a, b)
    for i, j, f, g in zip(a.tolist(), b.tolist(), ahead.tolist(), back.tolist(), strict=True):
        if i != j:
            k = 0
            while max(i, j) + k < 300 and codes[i + k] == codes[j + k]:
                k += 1
            assert f == k
            k = 0
            while min(i, j) - k > 0 and codes[i - k - 1] == codes[j - k - 1]:
                k += 1
            assert g == k


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_digests_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(some_words(rng)) + " ") for i in range(300)]
    rows += [(400, None), (401, ""), (None, "go " * 50), (402, " \t\x0b\f\r\n"), (5, "x y " * 20), (5, "x y " * 20), (403, "é é " * 30)]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, runs int, words string").repartition(3)
    expected = Counter()
    for doc, text in rows:
        words = (text or "").encode().split()
        words = planted(doc, words) if doc is not None else words
        found = runs(words)
        drop = {i for s, n, p in found for i in range(s + p, s + n)}
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        digest = lambda raw: hashlib.sha256(raw).hexdigest()
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
        rest = b" ".join(w for i, w in enumerate(words) if i not in drop)
        expected[(doc, len(found), *best, None if not found else 1000 * best[1] // best[2], digest(lines), digest(rest))] += 1
    got = periods.digests(periods.with_runs(periods.planted(frame)))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.select(*columns).collect())) == expected
    assert sum(n > 0 for _, n, *_ in expected) > 30
    whole = periods.with_runs(frame)
    assert whole.columns == ["doc_id", "text", "words", "n_words", "runs", "collapsed"]
    assert periods.with_runs(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="three"):
        periods.with_runs(frame, times=2)


# --- hard negatives ---

ROWS = "id long, label long, vector array<long>, `a.b` string"


def mined(rows, every=5, positives=5, negatives=3):
    least = {}
    for i, label, vector in rows:
        if None not in (i, label, vector) and None not in vector:
            least[i] = min(least.get(i, (label, vector)), (label, vector))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for a, (label, vector) in least.items():
        if a % every == 0:
            scored = sorted((-dot(vector, v), i, k) for i, (k, v) in least.items() if i != a)
            for score, p, _ in [s for s in scored if s[2] == label][:positives]:
                fits = [(n, i) for n, i, k in scored if k != label and 50 * -score <= 100 * -n <= 95 * -score]
                out |= {(a, p, rank, i, -score, -n) for rank, (n, i) in enumerate(fits[:negatives], 1)}
    return out


def vectors_table(scale=40):
    rng = random.Random(7)
    centres = [[rng.gauss(0, scale) for _ in range(6)] for _ in range(4)]
    rows = [(i, rng.randrange(3), [round(c + rng.gauss(0, scale / 2)) for c in rng.choice(centres)]) for i in range(400)]
    # A third of the rows hold one vector; ties, zeros, short and broken rows, rows that repeat an id.
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(200)]
    rows += [(2000, 1, [0] * 6), (2005, 1, []), (2010, 0, [3, 4]), (2001, None, [1] * 6), (2002, 1, None), (2003, 1, [1, None]), (None, 1, [1] * 6)]
    return rows + [rows[5], rows[5], (rows[10][0], 2, rows[11][2])]


@pytest.mark.parametrize(("group", "block", "step", "scale"), [(512, 16384, 1024, 40), (7, 60, 16, 40), (50, 100, 32, 10**9), (50, 100, 32, 10**7)])
def test_negatives_equal_brute_force(spark, monkeypatch, group, block, step, scale):
    for name, value in {"GROUP": group, "BLOCK": block, "STEP": step}.items():
        monkeypatch.setattr(negatives, name, value)
    rows = vectors_table(scale)
    if scale > 10**8:  # products beyond 64 bits stop at the ends; keep below
        rows = [(i, k, v and [x and x // 4 for x in v]) for i, k, v in rows]
    frame = spark.createDataFrame([(*r, "x") for r in rows], ROWS).repartition(4)
    got = negatives.mined(frame, F.col("id") % 5 == 0).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == mined(rows) and len(got) > 300
    assert negatives.mined(frame.limit(0), F.col("id") % 5 == 0).count() == 0
    assert negatives.mined(frame, F.lit(False)).count() == 0


def test_a_walk_stops_when_its_bound_certifies():
    rng = np.random.default_rng(8)
    vectors = rng.normal(0, 200, (3000, 8)).astype(np.int64)
    anchors = vectors[:1]
    shared = negatives.SharedList(anchors, np.arange(3000), np.zeros(3000, np.int64), vectors)
    scores = negatives.products(anchors, shared.vectors)[0]
    assert (scores <= shared.lengths[0] * (shared.bound + shared.slack)).all() and (np.diff(shared.bound) <= 0).all()
    taken = []
    negatives.STEP, step = 100, negatives.STEP
    try:
        best = negatives.Best(1, 5)

        def take(members, scores, ids, labels):
            taken.append(len(ids))
            best.add(np.repeat(members, len(ids)), scores[0], ids)

        shared.walk(lambda members, bound: bound >= best.least[members], take)
    finally:
        negatives.STEP = step
    assert sorted(best.score.tolist()) == sorted(scores)[-5:] and sum(taken) < 1000


def test_vectors_without_a_number_take_no_part(spark):
    rows = [(i, 1 + i % 2, [0.5, float(i)]) for i in range(20)] + [(20, 1, [float("nan"), 1.0]), (21, 1, [float("inf"), 1.0]), (22, 1, [None, 1.0]), (23, None, [1.0, 1.0]), (24, 1, None)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {r["id"]: (r["label"], r["vector"]) for r in negatives.prepared(frame).collect()}
    assert set(got) == set(range(20)) and got[7] == (3, [128, 7 * 256]) and got[8] == (1, [128, 8 * 256])


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_negatives_equal_sql(spark, folder):
    assert compare(queries.QUERIES["op13_hard_negatives"](spark, folder), connect(folder), negatives.SQL) is None


def test_queries_equal_brute_force_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = Counter((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in without_repeats(rows).elements())
    got = queries.QUERIES["op11_suffix_repeats"](spark, SMALL)
    assert Counter(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == expected
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    for doc, text in rows:
        words = planted(doc, (text or "").encode().split())
        if len(words) <= 2000:
            assert got[doc]["n_runs"] == len(runs(words))
