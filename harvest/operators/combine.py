"""Consolidation of the outputs of many jobs, and the export view."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from harvest.functions.names import owner_slash_name
from harvest.operators.ranking import default_salts, first_seen
from harvest.schemas import EXPORT_COLUMNS

#: Copies of a value that one row of `only_left` stands for before they are written out.
COPIES = 100_000


def consolidate(
    dfs: Sequence[DataFrame] | DataFrame, order: Sequence[Column | str] = ("job",), key: str = "id"
) -> DataFrame:
    """Union of all job outputs, the first row of every key in job order."""
    parts = [dfs] if isinstance(dfs, DataFrame) else list(dfs)
    return first_seen(reduce(DataFrame.unionByName, parts), key, order)


def _jobs_per_id(df: DataFrame, job: str, id: str) -> DataFrame:
    return df.groupBy(id).agg(F.count_distinct(job).alias("jobs"))


def overlap(df: DataFrame, job: str = "job", id: str = "id") -> DataFrame:
    """Ids found by more than one job, with the number of jobs."""
    return _jobs_per_id(df, job, id).filter(F.col("jobs") > 1)


def exclusive(df: DataFrame, job: str = "job", id: str = "id") -> DataFrame:
    """Ids found by one job only. The lowest and highest job of an id are equal, so plain partial aggregation does."""
    lowest_highest = df.groupBy(id).agg(F.min(job).alias("job"), F.max(job).alias("_highest"))
    return lowest_highest.filter(F.col("job") == F.col("_highest")).select(id, F.col("job").alias(job))


def in_both(left: DataFrame, right: DataFrame, col: str = "id") -> DataFrame:
    """Distinct values that two inputs share."""
    return left.select(col).intersect(right.select(col))


def only_left(left: DataFrame, right: DataFrame, col: str = "id") -> DataFrame:
    """Values of the first input that the second lacks, each as often as it is left over.

    Values are counted first, and the copies of a frequent value are written out by many tasks.
    """
    signed = left.select(col, F.lit(1).alias("_n")).union(right.select(col, F.lit(-1)))
    over = signed.groupBy(col).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
    parts = over.select(col, "_n", F.explode(F.expr(f"sequence(0, (_n - 1) div {COPIES})")).alias("_part"))
    spread = parts.repartition(default_salts(left.sparkSession), col, "_part")
    copies = F.array_repeat(F.lit(1), F.least(F.lit(COPIES), F.col("_n") - F.col("_part") * COPIES).cast("int"))
    return spread.select(col, F.explode(copies)).select(col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def export_view(repo: DataFrame, stats: DataFrame) -> DataFrame:
    """Repo rows with their star counts in the columns of the export; give `latest_stats` for one row per repo."""
    joined = repo.join(stats, repo["id"] == stats["repo_id"]).withColumns(
        {"name_with_owner": F.coalesce("name_with_owner", owner_slash_name()), "crawled_at": F.col("fetched_date")}
    )
    return joined.select(*EXPORT_COLUMNS)
