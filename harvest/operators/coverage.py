"""Which partitions of the query matrix the rows of a table fall in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from harvest.sources.matrix import bounds, fields_of, render, scheme_of, single_job_queries
from harvest.sources.matrix_values import LICENSE_NAMES

#: Flags that some queries exclude.
FLAGS = ("fork", "archived")


def band_of(value: str, bands: list[str], kind=int) -> Column:
    """The band text that the SQL expression `value` falls in, NULL outside all bands. Bands have no gaps and no overlap.

    A balanced tree of comparisons: 80 bands take 7 compares per row, in generated code.
    """
    ends = sorted(((bounds(band, kind), band) for band in bands), key=lambda e: (e[0][0] is not None, e[0][0] or 0))

    def sql(bound) -> str:
        return f"DATE '{bound}'" if isinstance(bound, dt.date) else str(bound)

    def tree(part) -> str:
        if len(part) == 1:
            return f"'{part[0][1]}'"
        middle = len(part) // 2
        return f"CASE WHEN {value} < {sql(part[middle][0][0])} THEN {tree(part[:middle])} ELSE {tree(part[middle:])} END"

    inside = [f"{value} IS NOT NULL"]
    lowest, highest = ends[0][0][0], ends[-1][0][1]
    if lowest is not None:
        inside.append(f"{value} >= {sql(lowest)}")
    if highest is not None:
        inside.append(f"{value} <= {sql(highest)}")
    return F.expr(f"CASE WHEN {' AND '.join(inside)} THEN {tree(ends)} END")


def license_key(name: Column) -> Column:
    """Key of a license from its display name, NULL for others."""
    key = F.lit(None).cast("string")
    for short, display in LICENSE_NAMES.items():
        key = F.when(name == display, short).otherwise(key)
    return key


def _probes(repos: DataFrame, columns: Mapping[str, str], scheme: str, id: str) -> tuple[DataFrame, list[Column], list[Column]]:
    """Rows with their bands, and the primary queries a row could answer: one text per strategy, and arrays of texts where
    `topic` is an array column. A text is NULL where a row has no such query."""
    plan = scheme_of(scheme)
    fields: dict[str, Column] = {}
    for name, column in columns.items():
        if name == "created":
            fields[name] = band_of(f"CAST(`{column}` AS DATE)", plan.lists[name], dt.date.fromisoformat)
        elif name in ("stars", "size"):
            fields[name] = band_of(f"`{column}`", plan.lists[name])
        else:
            fields[name] = F.lower(column) if name == "language" else F.col(column)
    # The bands get columns of their own, so that each is looked up once and not once per strategy.
    banded = repos.select(F.col(id).alias("id"), *[value.alias(name) for name, value in fields.items()])
    fields = {name: F.col(name) for name in fields}

    def per_topic(query: str) -> Column:
        return F.transform(F.array_distinct("topic"), lambda topic: render(query, {**fields, "topic": topic}))

    def unflagged(query: str, probe: Column) -> Column:
        for flag in FLAGS:
            if flag in fields and f"{flag}:false" in query:
                probe = F.when(~fields[flag], probe)
        return probe

    single, several = [], []
    for strategy, _, templates in plan.strategies:
        query = templates[0][0]
        if strategy == "special" or not fields_of(query) <= set(fields):
            continue
        if strategy == "topic" and banded.schema["topic"].dataType.typeName() == "array":
            several.append(unflagged(query, per_topic(query)))
        else:
            single.append(unflagged(query, render(query, fields)))
    if not single and not several:
        raise ValueError(f"no strategy of {scheme!r} can be evaluated on {sorted(columns)}")
    return banded, single, several


def _exploded(repos: DataFrame, columns: Mapping[str, str], scheme: str, id: str) -> DataFrame:
    """(id, query_string) for every primary query that a row could answer."""
    banded, single, several = _probes(repos, columns, scheme, id)
    arrays = [F.array(text) for text in single] + [F.coalesce(texts, F.array().cast("array<string>")) for texts in several]
    return banded.select("id", F.explode(F.flatten(F.array(*arrays))).alias("query_string"))


def _primary(matrix: DataFrame) -> DataFrame:
    """Distinct primary queries. Their number is bounded by the lists of a scheme (81,135 texts of under 120 bytes for
    `fine`, 3,333 for `coarse`) if the matrix is made from them; a caller's frame may be larger, so its size at run time
    decides whether it is broadcast."""
    return matrix.filter(F.col("query_idx") == 0).select("query_string").distinct()


def coverage(
    repos: DataFrame, matrix: DataFrame, columns: Mapping[str, str], scheme: str = "fine", id: str = "id"
) -> DataFrame:
    """(id, query_string) for every primary query of the matrix that a row falls in.

    `columns` maps list names (language, stars, created, size, license, topic) to columns; strategies that need an
    unmapped list are left out, and so are the special queries. Boolean columns may be mapped to `fork` and `archived`; queries
    that exclude such rows then do (NULL counts as excluded), without them rows are taken as neither. The bands are disjoint, so instead of a range join each
    row renders the one query per strategy it can match, and an equi join on the text does the rest. The matrix must be
    of the same scheme.
    """
    probes = _exploded(repos, columns, scheme, id)
    return probes.join(_primary(matrix), "query_string").select("id", "query_string")


def coverage_counts(
    repos: DataFrame, matrix: DataFrame, columns: Mapping[str, str], scheme: str = "fine", id: str = "id"
) -> DataFrame:
    """Rows per primary query, 0 for queries that cover none. Rows are counted per query text before the join."""
    probes = _exploded(repos, columns, scheme, id)
    hits = probes.groupBy("query_string").agg(F.count(F.lit(1)).alias("repos"))
    return _primary(matrix).join(hits, "query_string", "left").select("query_string", F.coalesce("repos", F.lit(0)).alias("repos"))


def uncovered(
    repos: DataFrame, matrix: DataFrame, columns: Mapping[str, str], scheme: str = "fine", id: str = "id"
) -> DataFrame:
    """Ids that no primary query of the matrix covers, in one scan of the table; ids are taken as unique.

    The text of each strategy is looked up by itself, so rows are not gathered by id. Only arrays of topics are unpacked,
    for the rows that nothing else covers.
    """
    banded, single, several = _probes(repos, columns, scheme, id)
    texts = [*single, *several]
    rows = banded.select("id", *[text.alias(f"_{i}") for i, text in enumerate(texts)])
    primary = _primary(matrix)
    for i in range(len(single)):
        rows = rows.join(primary, rows[f"_{i}"] == primary["query_string"], "left_anti")
    for i in range(len(single), len(texts)):
        probes = rows.select("id", F.explode_outer(f"_{i}").alias("query_string"))
        found = probes.join(primary.withColumn("_hit", F.lit(1)), "query_string", "left").groupBy("id").agg(F.count("_hit").alias("_hits"))
        rows = rows.join(found.filter(F.col("_hits") == 0).select("id"), "id", "left_semi")
    return rows.select("id")


def single_job_counts(repos: DataFrame, stars: str = "stars", scheme: str = "fine") -> DataFrame:
    """Rows that each query of the one-job list covers, and rows that none covers (NULL query)."""
    texts = {query.split("stars:")[1].split()[0]: query for query, _, _ in scheme_of(scheme).single}
    counts = repos.groupBy(band_of(f"`{stars}`", list(texts)).alias("band")).agg(F.count(F.lit(1)).alias("repos"))
    queries = single_job_queries(repos.sparkSession, scheme).select(
        F.regexp_extract("query_string", r"stars:(\S+)", 1).alias("band"), "query_string"
    )
    joined = counts.join(F.broadcast(queries), "band", "left").select("query_string", "repos")
    empty = queries.join(counts, "band", "left_anti").select("query_string", F.lit(0).cast("bigint").alias("repos"))
    return joined.unionByName(empty)
