"""Search qualifiers as plain column predicates, so that they reach the Parquet scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

# The qualifiers by the shape of their argument.
RANGE_QUALIFIERS = ["stars", "created", "size", "pushed", "good-first-issues", "help-wanted-issues"]
EQUAL_QUALIFIERS = ["language", "license", "is", "fork", "archived", "template", "mirror"]
MEMBER_QUALIFIERS = ["topic", "has"]


def _literal(bound: Any) -> Column:
    """A bound as a literal; a time without zone stays one, whatever the session time zone is."""
    if isinstance(bound, dt.datetime) and bound.tzinfo is None:
        return F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(bound)


def in_range(value: Column, bounds: tuple[Any, Any]) -> Column:
    """Inclusive range; None leaves a side open."""
    low, high = bounds
    if low is None and high is None:
        raise ValueError("a range needs at least one bound")
    terms = [value >= _literal(low)] if low is not None else []
    if high is not None:
        terms.append(value < _next_day(high) if _is_day(high) else value <= _literal(high))
    return terms[0] & terms[1] if len(terms) == 2 else terms[0]


def _is_day(bound: Any) -> bool:
    return isinstance(bound, dt.date) and not isinstance(bound, dt.datetime)


def _next_day(bound: dt.date) -> Column:
    """The end of a day. Days are compared as a whole, also with a column of times, and the bare column can be pushed down."""
    return F.lit(bound + dt.timedelta(days=1))


def _beyond(value: Column, sign: str, bound: Any) -> Column:
    if sign == "<":
        return value < _literal(bound)
    return value >= _next_day(bound) if _is_day(bound) else value > _literal(bound)


def predicate(spec: Mapping[str, Any], columns: Mapping[str, str]) -> Column:
    """The conjunction of all qualifiers in `spec`.

    `spec` maps a qualifier to its argument: (low, high) or {">": n} / {"<": n} for ranges, a value for equality,
    one or several members for `topic` and `has`. `columns` maps each qualifier to the column that holds it.
    Members are looked up in an array column. An unknown or unmapped qualifier raises before any job starts.
    """
    if not spec:
        raise ValueError("no qualifier given")
    terms = []
    for name, wanted in spec.items():
        if name not in RANGE_QUALIFIERS + EQUAL_QUALIFIERS + MEMBER_QUALIFIERS:
            raise ValueError(f"unknown qualifier {name!r}")
        if name not in columns:
            raise ValueError(f"no column is mapped to qualifier {name!r}")
        value = F.col(columns[name])
        if name in RANGE_QUALIFIERS:
            if isinstance(wanted, Mapping):
                if not wanted or set(wanted) - {">", "<"}:
                    raise ValueError(f"bounds of {name!r} are (low, high) or use '>' and '<'")
                terms += [_beyond(value, sign, bound) for sign, bound in wanted.items()]
            else:
                terms.append(in_range(value, wanted))
        elif name in EQUAL_QUALIFIERS:
            terms.append(value == F.lit(wanted))
        else:
            members = [wanted] if isinstance(wanted, str) else list(wanted)
            terms += [F.array_contains(value, member) for member in members]
    result = terms[0]
    for term in terms[1:]:
        result = result & term
    return result


def qualify(df: DataFrame, spec: Mapping[str, Any], columns: Mapping[str, str]) -> DataFrame:
    """Rows that satisfy every qualifier of `spec`."""
    return df.filter(predicate(spec, columns))
