"""Detection of periodic runs of words, by Baier grouping.

The words of a text become numbers. Phase one of Baier's suffix sorter groups the places of the sequence: groups of one word first,
then, from the highest group down, every place that lies before k members of a group moves into a new group just above its own.
When all groups are done, the context of a place's group is the longest Lyndon word that starts there, so the sizes of the
contexts are the Lyndon array; no suffix is sorted further. This is done under the order of the numbers and under its reverse.
Every run holds a Lyndon root of one of the two arrays. A root is extended to both sides by the longest common extension of the
places a period apart (tables of equal blocks of 1, 2, 4, ... words), and gives a run if its word sequence is long enough.

Only stretches that can hold a run are grouped: with g = least // times, every window of g words of a run of `least` words and
`times` periods occurs again in the text, a period away. Stretches are the places that such windows cover; their borders depend
on hashes whose collisions only make them longer.

Null and empty texts have no words and no runs. Each text is judged alone, so repeated rows and rows without an id give equal
results; an empty table gives an empty table. Columns of any other name are left alone, the results replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.llm.common import quoted

#: Shortest run in words, and in periods.
LEAST, TIMES = 24, 3
#: Words that meet in one sequence; a longer text is one alone.
TOGETHER = 1 << 18
FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def lyndon_lengths(codes: list[int]) -> np.ndarray:
    """The length of the longest Lyndon word from each place on, by Baier's phase one."""
    n = len(codes)
    # Groups stand in a list linked both ways, lowest first; group 0 lies below all.
    ranked = {c: g for g, c in enumerate(sorted(set(codes)), 1)}
    group = [0] * (n + 1)
    members: list[list[int]] = [[] for _ in range(len(ranked) + 1)]
    for at, c in enumerate(codes, 1):
        group[at] = g = ranked[c]
        members[g].append(at)
    size = [1] * len(members)
    above = [*range(1, len(members)), 0]
    below = [*range(-1, len(members) - 1)]
    # The way left to the next place of a group not yet done; place 0 ends it.
    left = [*range(n + 1)]
    now = len(members) - 1
    while now > 0:
        own = [at for at in members[now] if group[at] == now]
        for at in own:
            left[at] = at - 1
        before: dict[int, int] = {}
        for at in own:
            j = at - 1
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            if j:
                before[j] = before.get(j, 0) + 1
        if before:
            fresh: dict[tuple[int, int], int] = {}
            # More members behind a place mean a higher group: those with most go first, the next ones below them.
            for j, k in sorted(before.items(), key=lambda x: -x[1]) if len(before) < len(own) else before.items():
                home = group[j]
                to = fresh.get((k, home))
                if to is None:
                    to = fresh[k, home] = len(members)
                    members.append([])
                    size.append(size[home] + k * size[now])
                    upper = above[home]
                    above.append(upper)
                    below.append(home)
                    above[home], below[upper] = to, to
                group[j] = to
                members[to].append(j)
        now = below[now]
    return np.array([size[g] for g in group[1:]], np.int64)


class Extensions:
    """Longest common extensions in a sequence: tables of the blocks of 1, 2, 4, ... words, equal blocks with equal numbers."""

    def __init__(self, codes: np.ndarray):
        self.blocks = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
        n = len(codes)
        while (wide := 1 << len(self.blocks)) <= n:
            now, half = self.blocks[-1], wide >> 1
            values, named = np.unique(now[: n - wide + 1] * n + now[half : half + n - wide + 1], return_inverse=True)
            if len(values) == len(named):
                break
            self.blocks.append(named)

    def _walk(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.blocks) - 1, -1, -1):
            table, wide = self.blocks[k], 1 << k
            while True:  # the highest table may serve several times
                x, y = (a - total - wide, b - total - wide) if back else (a + total, b + total)
                fits = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < len(table))
                fits[fits] = table[x[fits]] == table[y[fits]]
                total += fits * wide
                if k < len(self.blocks) - 1 or not fits.any():
                    break
        return total

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._walk(a, b, False)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._walk(a, b, True)


def runs_of(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of all runs of `least` numbers and `times` periods or more, by start and period."""
    extensions, found = Extensions(codes), []
    for order in (codes, -codes):
        period = lyndon_lengths(order.tolist())
        at = np.flatnonzero(period * times <= len(codes))
        period = period[at]
        right = extensions.forward(at, at + period)
        # Most roots end where they begin to differ on both sides.
        reach = np.flatnonzero((right > 0) | (codes[at - 1] == codes[at + period - 1]) & (at > 0))
        at, period, right = at[reach], period[reach], right[reach]
        begin = at - extensions.backward(at, at + period)
        length = at + period + right - begin
        long = (length >= least) & (length >= times * period)
        found.append(np.stack([begin[long], length[long], period[long]], 1))
    return np.unique(np.concatenate(found), axis=0)


def stretches(codes: np.ndarray, text: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """The places that can hold runs, as (begin, end): those covered by windows that occur twice in their text."""
    gram = least // times
    n = len(codes) - gram + 1
    if n < 1:
        return []
    with np.errstate(over="ignore"):
        h, power = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
        mixed = h ^ (h >> np.uint64(29))
        total = np.zeros(n, np.uint64)
        for k in range(gram):
            total = total * power + mixed[k : k + n]
        total += text[:n].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    inside = text[:n] == text[gram - 1 :]
    order = np.argsort(total)
    ranked = total[order]
    twice = np.append(False, ranked[1:] == ranked[:-1])
    twice[:-1] |= twice[1:]
    again = np.zeros(n, bool)
    again[order] = twice
    again &= inside
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + gram - 1
    long = ends - begins >= least
    return [*zip(begins[long].tolist(), ends[long].tolist(), strict=True)]


def runs_in_texts(words: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for own in words for w in own], np.int64)
    sizes = np.array([len(w) for w in words])
    text, before = np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    spans = stretches(codes, text, least, times)
    if not spans:
        return found
    # Between two stretches stands a number of its own, so no run crosses.
    parts, places = [], []
    for k, (a, b) in enumerate(spans):
        parts += [codes[a:b], [len(ids) + k]]
        places += [np.arange(a, b), [-1]]
    place = np.concatenate(places)
    for begin, length, period in runs_of(np.concatenate(parts), least, times).tolist():
        at = int(place[begin])
        found[text[at]].append((at - int(before[text[at]]), length, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that lie in no run beyond its first period, joined by a space."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int32)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(drop)[:-1] == 0)]
    return b" ".join(words)


def _finder(least: int, times: int):
    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            counts, runs, rest, waiting, size = [], [], [], [], 0
            for k, text in enumerate(texts):
                own = text.encode("utf-8", "surrogatepass").split()
                waiting.append(own)
                size += len(own)
                if size >= TOGETHER or k == len(texts) - 1:
                    for w, r in zip(waiting, runs_in_texts(waiting, least, times), strict=True):
                        counts.append(len(w))
                        runs.append([{"start": a, "length": b, "period": c} for a, b, c in r])
                        rest.append(collapsed(w, r).decode("utf-8", "surrogatepass"))
                    waiting, size = [], 0
            yield pd.DataFrame({"n_words": counts, "runs": runs, "collapsed": rest})

    return found


def with_runs(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """`docs` with n_words, runs (start, length and period of each, by start and period) and collapsed, the text without
    the words that lie in a run beyond its first period.

    A run is a stretch of words in which words a period apart are equal, with that period the smallest, that no word beside it
    continues. It has `least` words and `times` periods or more, at least 3.
    """
    if times < 3 or least < times:
        raise ValueError("runs need three periods, and a word for each of them")
    added = ["n_words", "runs", "collapsed"]
    rows = docs.withColumn("__found", _finder(least, times)(F.coalesce(quoted(text).cast("string"), F.lit(""))))
    return rows.select(*(quoted(c) for c in docs.columns if c not in added), *(F.col(f"__found.{a}").alias(a) for a in added))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of `docs`; in one of ten texts, chosen by CRC-32 of the id, the words from some place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words").cast("long"))
    first = F.col("g") % F.nullif(F.col("n"), F.lit(0))
    period = 1 + F.floor((F.col("n") - first) / (3 + F.col("g") % 8))
    place = lambda i: F.when(i < first, i).otherwise(first + (i - first) % period)
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, number of runs, the run of greatest exponent, and digests of all runs and of the collapsed text."""
    # Of two runs a and b the first is stronger if a.length * b.period is more; then the earlier start, then the smaller period.
    stronger = lambda a, b: (
        F.when(a["length"] * b["period"] != b["length"] * a["period"], a["length"] * b["period"] > b["length"] * a["period"])
        .when(a["start"] != b["start"], a["start"] < b["start"])
        .otherwise(a["period"] <= b["period"])
    )
    best = F.when(F.size("runs") > 0, F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(stronger(a, b), a).otherwise(b)))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed", "n_words")
    exponent = F.expr("1000 * best.length div best.period")
    return rows.select(
        "doc_id", "n_words", "n_runs", *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")), exponent.alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
