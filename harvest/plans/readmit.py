"""Rejected rows taken again once the rules are wider, such as a longer partition label."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from harvest.functions import rules
from harvest.plans.load import Roots, checked_records, store_good, write_order
from harvest.schemas import PARTITION_WIDTH
from harvest.sources.exports import LOAD, replace_bad
from harvest.sources.scratch import folder_of, staged


def read_bad(spark: SparkSession, path: str) -> DataFrame | None:
    """The rejected rows of all loads with the label of their `load`, None if nothing was ever loaded.

    Columns that some loads lack are NULL there; loads must agree in the types of the columns that they share.
    """
    fs, where = folder_of(spark, path)
    if not fs.exists(where) or not any(s.getPath().getName().startswith(f"{LOAD}=") for s in fs.listStatus(where)):
        return None
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    # Labels are text, also those that look like numbers or days.
    schema = T.StructType([f for f in found.fields if f.name != LOAD] + [T.StructField(LOAD, T.StringType())])
    return spark.read.schema(schema).parquet(path)


def _judged_again() -> Iterable[str]:
    """Rules on fields that a rejected row still has. Other reasons tell of a node or page whose text is not kept."""
    fields = [F.lit(None)] * 4
    groups = rules.repo_rules(*fields), rules.repo_table_rules(*fields, F.lit("")), rules.stats_table_rules(*fields[:3])
    return sorted({name for group in groups for name, _ in group})


def readmit(spark: SparkSession, roots: Roots, date: dt.date, policy: str = "keep_first", width: int = PARTITION_WIDTH) -> list[str]:
    """Store the rejected rows that pass the present rules and return the labels of the loads whose rejected rows changed.

    The rows that pass are upserted like one load, in write order. The others stay among the rejected rows, with the reason that
    holds now. Only loads with a row that passes or changes its reason are written anew, from a copy written aside; the labels of
    those loads reach the driver. The tables are written first, so after a failure half-way the same call repairs all; a second
    call changes nothing. A star count of a row that passes replaces one of the same id and day, as any later write does.
    """
    rows = read_bad(spark, roots.bad)
    if rows is None or not {"id", "name", "owner", "url", "job"} <= set(rows.columns):
        return []
    fields, was = rows.columns, F.col("_was")
    now = checked_records(rows.withColumnRenamed("reason", "_was"), date, width)
    told = now.withColumn("reason", F.when(was.isin(*_judged_again()), F.col("reason")).otherwise(was))
    changed = told.filter(~was.eqNullSafe(F.col("reason")))
    labels = sorted(r[0] for r in changed.select(LOAD).distinct().collect())
    if not labels:
        return []
    with staged(told.filter(F.col(LOAD).isin(labels)).drop("_was"), "readmitted") as copy:
        good = copy.filter(F.col("reason").isNull())
        store_good(good, roots, policy, write_order(good), None)
        replace_bad(copy.filter(F.col("reason").isNotNull()).select(*fields), roots.bad, labels)
    return labels
