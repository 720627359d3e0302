"""Coverage by matrices of any bounds, and by sets of predicates.

`coverage` reads the shipped lists, whose bands are disjoint. Bounds of other matrices may overlap. Their star ranges are cut into
aligned blocks of 1, 2, 4, ... values; a value lies in one block of each size, so the range join becomes an equi join on the size
and the number of the block. What a query asks for plainly (language, license, topic) is part of the join key too; the queries
that leave one free form a shape of their own. The other ranges are compared after the join.

Pairs grow with rows times queries. `free_coverage_totals` counts without them: rows are counted per block of every range, and a query adds
up the blocks that make up its bounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from harvest.functions.qualifiers import RANGE_QUALIFIERS, predicate

#: Star counts below 0 count as 0 and those above the end as the end.
LAST_STAR = (1 << 40) - 1
LEVELS = 41
PLAIN = ("language", "license", "topic")
#: Range columns of a matrix beside the stars, and the list names they belong to.
OTHER_RANGES = {"created": "date", "size": "bigint", "pushed": "date"}
#: A matrix cut into more blocks than this is joined by a shuffle: a broadcast passes through the driver.
BROADCAST_BLOCKS = 100_000


def blocks_of(low: Column, high: Column, levels: int = LEVELS) -> Column:
    """The aligned blocks that make up [low, high], as an array of (level, block): two of each level at most."""

    def step(state: Column, level: Column) -> Column:
        lo, hi, found = state["lo"], state["hi"], state["found"]
        block = lambda at: F.array(F.struct(level.alias("level"), at.alias("block")))
        none = F.array().cast("array<struct<level:int,block:bigint>>")
        left = F.when((lo <= hi) & (lo % 2 == 1), block(lo)).otherwise(none)
        next_lo = F.when(lo % 2 == 1, lo + 1).otherwise(lo)
        right = F.when((next_lo <= hi) & (hi % 2 == 0), block(hi)).otherwise(none)
        next_hi = F.when(hi % 2 == 0, hi - 1).otherwise(hi)
        # An empty rest stays empty on all further levels.
        rest = next_lo <= next_hi
        return F.struct(
            F.when(rest, F.shiftright(next_lo, 1)).otherwise(F.lit(1).cast("bigint")).alias("lo"),
            F.when(rest, F.shiftright(next_hi, 1)).otherwise(F.lit(0).cast("bigint")).alias("hi"),
            F.concat(found, left, right).alias("found"),
        )

    start = F.struct(low.alias("lo"), high.alias("hi"), F.array().cast("array<struct<level:int,block:bigint>>").alias("found"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), start, step, lambda s: s["found"])


def _star(value: Column, default: int) -> Column:
    return F.least(F.greatest(F.coalesce(value, F.lit(default)), F.lit(0)), F.lit(LAST_STAR)).cast("bigint")


def _asked_columns(matrix: DataFrame, columns: Mapping[str, str]) -> tuple[list[str], list[str]]:
    """The plain lists and the bounds of ranges beside the stars that `matrix` states of mapped columns; one that is not mapped raises."""
    if "stars" not in columns:
        raise ValueError("no column is mapped to stars")
    bounds = {name: [c for c in (f"{name}_lo", f"{name}_hi") if c in matrix.columns] for name in OTHER_RANGES}
    plain = [name for name in PLAIN if name in matrix.columns]
    unmapped = [c for name in plain if name not in columns for c in (name,)] + [c for name, cs in bounds.items() if name not in columns for c in cs]
    if unmapped:
        used = matrix.agg(*(F.count(c).alias(c) for c in unmapped)).first()
        stated = [c for c in unmapped if used[c]]
        if stated:
            raise ValueError(f"no column is mapped for {stated}")
    return [name for name in plain if name in columns], [c for name, cs in bounds.items() if name in columns for c in cs]


def _own_values(repos: DataFrame, columns: Mapping[str, str], plain: Sequence[str], ranges: Sequence[str], id: str) -> DataFrame:
    """What bounds are compared with: id, stars, the plain columns and the other ranges of every row with a star count."""
    value = F.col(columns["stars"])
    own = {name: F.lower(columns[name]) if name == "language" else F.col(columns[name]) for name in plain}
    return repos.filter(value.isNotNull()).select(
        F.col(id).alias("id"), _star(value, 0).alias("stars"), *(c.alias(name) for name, c in own.items()),
        *(F.col(columns[name]).cast(OTHER_RANGES[name]).alias(name) for name in ranges if name in columns),
    )


def _by_topic(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per topic, if topics are asked for and rows have several."""
    if "topic" in keys and rows.schema["topic"].dataType.typeName() == "array":
        return rows.withColumn("topic", F.explode(F.array_distinct("topic")))
    return rows


def free_coverage(repos: DataFrame, matrix: DataFrame, columns: Mapping[str, str], query: str = "query_string", id: str = "id") -> DataFrame:
    """(id, query) for every row of `repos` that lies within the bounds of a row of `matrix`.

    `matrix` has the query column and any of language, license, topic, star_lo, star_hi, created_lo, created_hi, size_lo, size_hi,
    pushed_lo and pushed_hi, as `queries_for` gives them; NULL, or a column that is absent, leaves that side free. `columns` maps the list
    names (stars, language, license, topic, created, size, pushed) to columns of `repos`. A bound on something that is not mapped raises
    when the matrix has such a column that is not all NULL. A row whose own value is NULL lies in no bound on it. Topics may be an
    array. Queries that occur several times count once; a row meets each at most once, as its blocks do not overlap.
    """
    plain, ranges = _asked_columns(matrix, columns)
    bounds = {name: [c for c in ranges if c.startswith(f"{name}_")] for name in OTHER_RANGES}
    lo, hi = (F.col(c) if c in matrix.columns else F.lit(None).cast("bigint") for c in ("star_lo", "star_hi"))
    asked = matrix.select(F.col(query).alias("_query"), *(F.col(c).alias(f"_{c}") for c in [*plain, *ranges]), lo.alias("_star_lo"), hi.alias("_star_hi")).distinct()
    cut = asked.withColumn("_cell", F.explode(blocks_of(_star(F.col("_star_lo"), 0), _star(F.col("_star_hi"), LAST_STAR))))
    cut = cut.select("*", F.col("_cell.level").alias("_level"), F.col("_cell.block").alias("_block")).drop("_cell", "_star_lo", "_star_hi")
    # Shapes and levels are few: at most 8, and at most 41.
    shape = F.concat(F.lit(""), *(F.col(f"_{name}").isNotNull().cast("int").cast("string") for name in plain))
    cut = cut.withColumn("_shape", shape)
    told = cut.groupBy("_shape").agg(F.collect_set("_level").alias("levels"), F.count(F.lit(1)).alias("blocks")).collect()
    levels: dict[str, list[int]] = {r["_shape"]: sorted(r["levels"]) for r in told}
    if sum(r["blocks"] for r in told) > BROADCAST_BLOCKS:
        cut = cut.hint("merge")

    rows = _own_values(repos, columns, plain, list(OTHER_RANGES), id)
    found = []
    for kind, used in levels.items():
        keys = [name for name, flag in zip(plain, kind, strict=True) if flag == "1"]
        side = _by_topic(rows, keys)
        cells = F.array(*(F.struct(F.lit(n).alias("level"), F.shiftright("stars", n).alias("block")) for n in used))
        side = side.withColumn("cell", F.explode(cells)).select("*", "cell.level", "cell.block").drop("cell")
        queries = cut.filter(F.col("_shape") == kind)
        same = [F.col(a) == F.col(f"_{a}") for a in ("level", "block", *keys)]
        inside = [
            F.col(f"_{c}").isNull() | ((F.col(name) >= F.col(f"_{c}")) if c.endswith("_lo") else (F.col(name) <= F.col(f"_{c}")))
            for name, cs in bounds.items() if name in columns for c in cs
        ]
        found.append(side.join(queries, reduce(and_, [*same, *(F.coalesce(i, F.lit(False)) for i in inside)])).select("id", F.col("_query").alias(query)))
    if not found:
        return rows.select("id", F.lit(None).cast(matrix.schema[query].dataType).alias(query)).limit(0)
    return reduce(DataFrame.unionByName, found).distinct()


def _alone(df: DataFrame, key: str) -> DataFrame:
    """Per key whether all its rows are equal, and the row `r` if so. Copies fold in the map tasks."""
    rest = F.struct(*[F.col(c) for c in df.columns if c != key])
    both = df.groupBy(key).agg(F.min(rest).alias("r"), F.max(rest).alias("_last"))
    return both.select(key, F.col("r").eqNullSafe(F.col("_last")).alias("alone"), "r")


def free_coverage_totals(
    repos: DataFrame, matrix: DataFrame, columns: Mapping[str, str], query: str = "query_string", id: str = "id"
) -> DataFrame:
    """(query, repos, ids): the number of rows and the sum of the ids of `free_coverage` for every query that has any.

    A row counts once for each block it lies in, so the work grows with rows times the levels of the ranges, not with rows times queries.
    Only ids with several different rows and queries with several bounds go through pairs, which tell what counts once.
    """
    plain, ranges = _asked_columns(matrix, columns)
    names = [name for name in OTHER_RANGES if any(c.startswith(f"{name}_") for c in ranges)]
    star_lo, star_hi = (F.col(c) if c in matrix.columns else F.lit(None).cast("bigint") for c in ("star_lo", "star_hi"))
    asked = matrix.select(F.col(query).alias("_query"), *(F.col(c).alias(f"_{c}") for c in [*plain, *ranges]), star_lo.alias("_stars_lo"), star_hi.alias("_stars_hi"))
    known = _alone(asked, "_query")
    held = _alone(_own_values(repos, columns, plain, names, id), "id")

    number = lambda c, name: F.unix_date(c).cast("bigint") if OTHER_RANGES.get(name) == "date" else c.cast("bigint")
    axes = ["stars", *names]
    rows = held.filter("alone").select("id", "r.*").select("id", *plain, *(number(F.col(name), name).alias(name) for name in axes))
    ends = rows.agg(*(f(name).alias(f"{name}_{f.__name__}") for name in axes for f in (F.min, F.max))).first()
    span = {name: (ends[f"{name}_min"], ends[f"{name}_max"]) for name in axes if ends[f"{name}_min"] is not None}
    levels = {name: (high - low).bit_length() + 1 for name, (low, high) in span.items()}
    if max(levels.values(), default=0) > 60:
        return _totals(free_coverage(repos, matrix, columns, query, id), query)

    def bound(name: str, side: str) -> Column:
        if f"{name}_{side}" not in (*ranges, "stars_lo", "stars_hi"):
            return F.lit(None).cast("bigint")
        value = F.col(f"_{name}_{side}")
        # A star count out of range counts as the nearest in it.
        return F.when(value.isNotNull(), _star(value, 0)) if name == "stars" else number(value.cast(OTHER_RANGES[name]), name)

    # A range that a query leaves free is block 0; the others are numbered from the whole range, 1, down to single values.
    cut = known.filter("alone").select("_query", "r.*")
    for name in span:
        lo, hi, low, high = bound(name, "lo"), bound(name, "hi"), *map(F.lit, span[name])
        last = F.lit((1 << (levels[name] - 1)) - 1).cast("bigint")
        # Bounds are moved into the range of the rows; those beyond it hold no row. A side left free ends with the last whole block.
        first = F.when(lo > high, last + 1).otherwise(F.greatest(F.coalesce(lo, low), low) - low)
        end = F.when(hi < low, F.lit(-1)).when(hi < high, hi - low).otherwise(last)
        start = lambda level, name=name: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(levels[name] - 1) - level)
        cells = F.transform(blocks_of(first.cast("bigint"), end.cast("bigint"), levels[name]), lambda c: c["block"] + start(c["level"]))
        cut = cut.withColumn(f"_{name}_in", F.when(lo.isNull() & hi.isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(cells))
    # A range of which the rows hold no value covers rows for the queries that leave it free.
    for name in axes:
        if name not in span:
            cut = cut.filter(bound(name, "lo").isNull() & bound(name, "hi").isNull())
    shape = F.concat(F.lit(""), *(F.col(f"_{name}").isNotNull().cast("int").cast("string") for name in plain))
    cut = cut.select("_query", shape.alias("_shape"), *(F.col(f"_{name}") for name in plain), *(F.col(f"_{name}_in") for name in span))
    for name in span:
        cut = cut.withColumn(f"_{name}", F.explode(f"_{name}_in")).drop(f"_{name}_in")
    shapes = {r["_shape"]: r["blocks"] for r in cut.groupBy("_shape").agg(F.count(F.lit(1)).alias("blocks")).collect()} if span else {}

    for name in span:
        own = F.col(name) - F.lit(span[name][0])
        cells = F.array(F.lit(0).cast("bigint"), *(F.shiftright(own, n) + F.lit(1 << (levels[name] - 1 - n)) for n in range(levels[name])))
        rows = rows.withColumn(name, F.when(F.col(name).isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(cells))
    parts = []
    for kind in shapes:
        keys = [*(name for name, flag in zip(plain, kind, strict=True) if flag == "1"), *span]
        side = _by_topic(rows, keys).select("id", *keys)
        for name in span:
            side = side.withColumn(name, F.explode(name))
        counted = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("repos"), F.sum("id").alias("ids"))
        mine = cut.filter(F.col("_shape") == kind)
        mine = mine.hint("merge") if sum(shapes.values()) > BROADCAST_BLOCKS else mine
        met = mine.join(counted, reduce(and_, (F.col(name) == F.col(f"_{name}") for name in keys)))
        parts.append(met.select(F.col("_query").alias(query), "repos", "ids"))

    several, shared = known.filter(~F.col("alone")).select("_query"), held.filter(~F.col("alone")).select(F.col("id").alias("_id"))
    in_several = F.col(query).eqNullSafe(F.col("_query"))
    if not several.isEmpty():
        parts.append(_totals(free_coverage(repos, matrix.join(several, in_several, "left_semi"), columns, query, id), query))
        matrix = matrix.join(several, in_several, "left_anti")
    if not shared.isEmpty():
        repeated = repos.join(shared, F.col(id).eqNullSafe(F.col("_id")), "left_semi")
        parts.append(_totals(free_coverage(repeated, matrix, columns, query, id), query))
    if not parts:
        return _totals(free_coverage(repos, matrix.limit(0), columns, query, id), query)
    return reduce(DataFrame.unionByName, parts).groupBy(query).agg(F.sum("repos").alias("repos"), F.sum("ids").alias("ids"))


def _totals(pairs: DataFrame, query: str) -> DataFrame:
    return pairs.groupBy(query).agg(F.count(F.lit(1)).alias("repos"), F.sum("id").alias("ids"))


def spec_of(query: str) -> dict[str, Any]:
    """The qualifiers of a query of the lists, as `predicate` takes them. Visibility and order say nothing of a row."""
    import datetime as dt

    def bound(text: str) -> Any:
        return dt.date.fromisoformat(text) if "-" in text else int(text)

    spec: dict[str, Any] = {}
    for term in query.split():
        name, _, value = term.partition(":")
        if name in ("is", "sort"):
            continue
        if name == "has" or name == "topic":
            spec[name] = [*spec.get(name, []), value]
        elif name in RANGE_QUALIFIERS and value[0] in "<>":
            spec[name] = {value[0]: bound(value[1:])}
        elif name in RANGE_QUALIFIERS:
            low, high = value.split("..")
            spec[name] = (bound(low) if low else None, bound(high) if high else None)
        else:
            spec[name] = {"true": True, "false": False}.get(value, value)
    return spec


def predicate_coverage(repos: DataFrame, specs: Mapping[str, Mapping[str, Any]], columns: Mapping[str, str], id: str = "id") -> DataFrame:
    """(id, query_string) for every predicate of `specs` (query text to qualifiers) that a row satisfies.

    All predicates are evaluated in one scan of `repos`, one array entry each; only entries that hold become rows.
    """
    if not specs:
        return repos.select(F.col(id).alias("id"), F.lit("").alias("query_string")).limit(0)
    held = F.array_compact(F.array(*(F.when(predicate(spec, columns), F.lit(text)) for text, spec in specs.items())))
    return repos.select(F.col(id).alias("id"), F.explode(held).alias("query_string"))


def special_coverage(repos: DataFrame, matrix: DataFrame, columns: Mapping[str, str], id: str = "id") -> DataFrame:
    """(id, query_string) for every special query of the matrix that a row falls in.

    `matrix` are rows of `queries_for`; its special queries are as few as a scheme lists. `columns` maps qualifiers to columns, see `predicate`;
    one that a query needs and that is not mapped raises.
    """
    texts = matrix.filter((F.col("query_idx") == 0) & (F.col("strategy") == "special")).select("query_string").distinct()
    return predicate_coverage(repos, {r[0]: spec_of(r[0]) for r in texts.collect()}, columns, id)
