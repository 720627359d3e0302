"""Derived columns of the repo and stats tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: prefix of the partition label.
PARTITION_PREFIX = "matrix_"


def owner_slash_name(owner: Column | str = "owner", name: Column | str = "name") -> Column:
    """`owner/name`, NULL if either part is NULL."""
    return F.concat(owner, F.lit("/"), name)


def with_name(df: DataFrame) -> DataFrame:
    return df.withColumn("name_with_owner", owner_slash_name())


def with_partition(df: DataFrame, job: Column | str | int = "job") -> DataFrame:
    """Label every row with the job that found it; `job` is a column or a job number."""
    number = F.lit(job) if isinstance(job, int) else (F.col(job) if isinstance(job, str) else job)
    return df.withColumn("alphabet_partition", F.concat(F.lit(PARTITION_PREFIX), number.cast("string")))


def with_fetched(df: DataFrame, date: Column | dt.date | str) -> DataFrame:
    """Stamp the fetch day. The day is an argument, so that a run can be repeated."""
    return df.withColumn("fetched_date", (date if isinstance(date, Column) else F.lit(date)).cast("date"))
