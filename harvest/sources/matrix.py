"""The query matrix: which search queries each parallel job runs."""

from __future__ import annotations

import datetime as dt
from string import Formatter
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harvest.schemas import QUERY
from harvest.sources import matrix_values as v


class Scheme(NamedTuple):
    strategies: list
    lists: dict[str, list[str]]
    specials: list[tuple[str, str]]
    single: list[tuple[str, str, int]]


SCHEMES = {
    "fine": Scheme(
        v.STRATEGIES,
        {
            "language": v.LANGUAGES,
            "stars": v.STAR_BANDS,
            "created": v.DATE_BANDS,
            "size": v.SIZE_BANDS,
            "license": v.LICENSES,
            "topic": v.TOPICS,
        },
        v.SPECIALS,
        v.SINGLE_JOB,
    ),
    "coarse": Scheme(
        v.COARSE_STRATEGIES,
        {
            "language": v.COARSE_LANGUAGES,
            "stars": v.COARSE_STAR_BANDS,
            "created": v.COARSE_DATE_BANDS,
            "topic": v.COARSE_TOPICS,
        },
        v.COARSE_SPECIALS,
        v.COARSE_SINGLE_JOB,
    ),
}
_BOUNDED = {"stars": ("star", int), "created": ("created", dt.date.fromisoformat), "size": ("size", int), "pushed": ("pushed", dt.date.fromisoformat)}
_PLAIN = ["language", "license", "topic"]


def scheme_of(name: str) -> Scheme:
    if name not in SCHEMES:
        raise ValueError(f"scheme must be one of {sorted(SCHEMES)}, not {name!r}")
    return SCHEMES[name]


def bounds(band: str, kind=int) -> tuple[Any, Any]:
    """Inclusive bounds of a list entry such as 26..27, >45350, <5, >2024-06-01 or ..2016-12-31; None is open."""
    step = 1 if kind is int else dt.timedelta(1)
    if band[0] == ">":
        return kind(band[1:]) + step, None
    if band[0] == "<":
        return None, kind(band[1:]) - step
    low, high = band.split("..")
    return (kind(low) if low else None), (kind(high) if high else None)


def render(template: str, fields: dict[str, Column]) -> Column:
    """A text template with named fields as one string column, NULL where a field is NULL."""
    parts = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field:
            parts.append(fields[field])
    return F.concat(*parts)


def fields_of(template: str) -> set[str]:
    return {field for _, field, _, _ in Formatter().parse(template) if field}


def _fixed(query: str, name: str) -> str | None:
    """The value that a query of the lists gives a qualifier in plain text."""
    values = [term.removeprefix(f"{name}:") for term in query.split() if term.startswith(f"{name}:") and "{" not in term]
    return values[0] if values else None


def _fixed_bounds(query: str) -> list[Any]:
    """Bounds that a query states in plain text, in the order of the bounds columns."""
    bands = [(_fixed(query, name), kind) for name, (_, kind) in _BOUNDED.items()]
    return [end for band, kind in bands for end in (bounds(band, kind) if band else (None, None))]


def _bounds_columns() -> list[tuple[str, str, str]]:
    """(column, list name, SQL type) of every bound, lower and upper in turn."""
    kinds = {name: "bigint" if kind is int else "date" for name, (_, kind) in _BOUNDED.items()}
    return [(f"{label}_{side}", name, kinds[name]) for name, (label, _) in _BOUNDED.items() for side in ("lo", "hi")]


def _constant(values: list, kind: str = "string") -> Column:
    """A list as one text literal that Spark folds to a constant array; None becomes NULL."""
    entries = F.split(F.lit("|".join("" if value is None else str(value) for value in values)), r"\|")
    return entries if kind == "string" else entries.try_cast(f"array<{kind}>")


class _Lists:
    """Constant arrays of a scheme: the list entries, and the bounds of entries that are ranges."""

    def __init__(self, scheme: Scheme):
        self.sizes = {name: len(entries) for name, entries in scheme.lists.items()} | {"special": len(scheme.specials)}
        self.entries = {name: _constant(entries) for name, entries in scheme.lists.items()}
        self.entries["special"] = _constant([query for query, _ in scheme.specials])
        self.entries["special_description"] = _constant([text for _, text in scheme.specials])
        queries = [query for query, _ in scheme.specials]
        self.special_values = {name: _constant([_fixed(query, name) for query in queries]) for name in _PLAIN}
        self.bounds, self.special_bounds = {}, {}
        for at, (column, name, sql) in enumerate(_bounds_columns()):
            kind = _BOUNDED[name][1]
            self.bounds[column] = _constant([bounds(band, kind)[at % 2] for band in scheme.lists.get(name, [])], sql)
            self.special_bounds[column] = _constant([_fixed_bounds(query)[at] for query in queries], sql)


def _row(strategy: str, template, texts: dict[str, Column], index: dict[str, Column], lists: _Lists) -> Column:
    """One matrix row: rendered texts, and the values and bounds that the query names, by its lists or in plain text (NULL = free)."""
    query, description, expected = template
    used = fields_of(query)

    def plain(name: str) -> Column:
        if name in used:
            return texts[name]
        if "special" in used:
            value = F.element_at(lists.special_values[name], index["special"])
            return F.when(value != "", value)
        return F.lit(_fixed(query, name)).cast("string")

    columns = [
        render(query, texts).alias("query_string"),
        render(description, texts).alias("description"),
        F.lit(expected).alias("expected_results"),
        F.lit(strategy).alias("strategy"),
        *[plain(name).alias(name) for name in _PLAIN],
    ]
    for (column, name, sql), stated in zip(_bounds_columns(), _fixed_bounds(query)):
        if name in used:
            bound = F.element_at(lists.bounds[column], index[name])
        elif "special" in used:
            bound = F.element_at(lists.special_bounds[column], index["special"])
        else:
            bound = F.lit(stated).cast(sql)
        columns.append(bound.alias(column))
    return F.struct(*columns)


def queries_for(jobs: DataFrame, scheme: str = "fine", job: str = "job") -> DataFrame:
    """Matrix rows of the given job numbers, in the QUERY columns plus strategy and bounds.

    The job number picks the strategy by its remainder, and an entry of each list of the strategy by division with
    rest, the first list fastest. Both use the same number, so parts of the lists are never reached.
    """
    plan = scheme_of(scheme)
    lists = _Lists(plan)
    number = F.col("job")
    per_strategy = []
    for strategy, names, templates in plan.strategies:
        texts, index, step = {"job": number.cast("string")}, {}, 1
        for name in names:
            size = lists.sizes[name]
            index[name] = F.expr(f"CAST(job div {step} % {size} + 1 AS INT)")  # 1-based
            texts[name] = F.element_at(lists.entries[name], index[name])
            step *= size
        if "special" in names:
            texts["special_description"] = F.element_at(lists.entries["special_description"], index["special"])
        per_strategy.append(F.array(*[_row(strategy, t, texts, index, lists) for t in templates]))
    chosen = per_strategy[-1]
    for turn, rows in reversed(list(enumerate(per_strategy[:-1]))):
        chosen = F.when(number % len(per_strategy) == turn, rows).otherwise(chosen)
    numbered = jobs.select(F.col(job).cast("bigint").alias("job"))
    return numbered.select("job", F.posexplode(chosen).alias("query_idx", "q")).select("job", "query_idx", "q.*")


def single_job_queries(spark: SparkSession, scheme: str = "fine") -> DataFrame:
    """The fixed query list of a run with one job, in the columns of `queries_for`."""
    rows = [
        (0, i, query, text, n, "single", *[_fixed(query, name) for name in _PLAIN], *_fixed_bounds(query))
        for i, (query, text, n) in enumerate(scheme_of(scheme).single)
    ]
    schema = T.StructType([*QUERY.fields])
    for name in ("strategy", *_PLAIN):
        schema = schema.add(name, T.StringType())
    for column, _, sql in _bounds_columns():
        schema = schema.add(column, T.DateType() if sql == "date" else T.LongType())
    return spark.createDataFrame(rows, schema)


def query_matrix(spark: SparkSession, total: int, scheme: str = "fine") -> DataFrame:
    """All queries of a matrix of `total` jobs; one job runs a fixed list instead."""
    if total == 1:
        return single_job_queries(spark, scheme)
    return queries_for(spark.range(total).select(F.col("id").alias("job")), scheme)
