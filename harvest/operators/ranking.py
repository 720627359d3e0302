"""Orders and top-n per group."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def columns(names: Sequence[Column | str] | Column | str) -> list[Column]:
    if isinstance(names, (str, Column)):
        names = [names]
    return [F.col(n) if isinstance(n, str) else n for n in names]


def default_salts(spark: SparkSession) -> int:
    """As many sub-groups as the session has shuffle partitions, so that one hot group can use the whole cluster."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def top_n(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, salts: int | None = None
) -> DataFrame:
    """First `n` rows of every group in a total order; without `by`, of the whole table.

    Done in two steps: the first n of each (group, salt), then the first n of what is left of the group. A group
    with a third of all rows is thus spread over many tasks, and the last step sees at most n x salts rows of it.
    Unless given, the number of salts is the root of the number of shuffle partitions, so that both steps stay small.
    `salts=1` saves the first shuffle where groups are known to be small. Map tasks prune to n rows by themselves
    if n is within spark.sql.optimizer.windowGroupLimitThreshold, see `harvest.settings`.
    """
    if n <= 0:
        return df.limit(0)
    salts = isqrt(default_salts(df.sparkSession)) if salts is None else salts
    by, order = list(by), columns(order)
    if salts > 1 and by:
        # Input partitions are dealt to the salts, so that all rows of a map task share one salt.
        df = _first(df.withColumn("_salt", F.spark_partition_id() % salts), [*by, "_salt"], order, n).drop("_salt")
    return _first(df, by, order, n) if by else df.orderBy(*order).limit(n)


def _first(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_seen(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column | str] | Column | str) -> DataFrame:
    """The first row of every key in a total order.

    Map tasks keep one row per key before the shuffle, so a key with very many copies does no harm.
    """
    return _first(df, [keys] if isinstance(keys, str) else list(keys), columns(order), 1)


def cap(
    df: DataFrame,
    n: int,
    by: Sequence[str] | str | None = "job",
    order: Sequence[Column | str] = ("query_idx", "page_idx", "pos"),
    salts: int | None = None,
) -> DataFrame:
    """Cut every job at its target: the first `n` rows in crawl order; without `by`, of the whole table."""
    return top_n(df, [by] if isinstance(by, str) else list(by or ()), order, n, salts)


def ranked(df: DataFrame, by: str = "stars", id: str = "id") -> DataFrame:
    """Largest or latest first, id as tie-break. The tie-break also lets the range sort split a frequent value."""
    return df.orderBy(F.col(by).desc(), F.col(id))


def result_window(
    df: DataFrame, query_cols: Sequence[str], by: Sequence[Column | str], n: int = 1000, salts: int | None = None
) -> DataFrame:
    """What one query can return: its first 1000 rows (10 pages of 100)."""
    return top_n(df, list(query_cols), by, n, salts)


def preview(df: DataFrame, n: int = 5, order: Sequence[Column | str] = ()) -> DataFrame:
    """A few rows to look at, the first in `order` if given."""
    return (df.orderBy(*columns(order)) if order else df).limit(n)
