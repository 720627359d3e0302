"""Repo and stats tables on plain Parquet.

A repo table may be a folder of complete versions: an upsert writes a new version beside the one it reads, and the version
counts from the moment its _SUCCESS file exists, so readers never see half a table. That moves the whole table for any batch; `buckets`
keeps it in hash buckets instead, and loads do so for new tables. The stats table is partitioned by day and only the days a batch
touches are rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harvest.operators.upsert import upsert_repo, upsert_stats
from harvest.schemas import REPO, STATS, conform
from harvest.sources.buckets import delete_buckets, read_bucketed_repo
from harvest.sources.scratch import drop_folder, folder_of, staged

_VERSION = "version-"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions under `root`, ascending."""
    fs, where = folder_of(spark, root)
    if not fs.exists(where):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(where) if status.isDirectory()]
    found = [int(name.removeprefix(_VERSION)) for name in names if name.startswith(_VERSION)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n in found if fs.exists(done(f"{version_path(root, n)}/_SUCCESS")))


def version_path(root: str, number: int) -> str:
    return f"{root}/{_VERSION}{number:010d}"


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all complete versions but the newest `keep`."""
    if keep < 1:
        raise ValueError("the newest version has to stay")
    for number in versions(spark, root)[:-keep]:
        drop_folder(spark, version_path(root, number))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_repo(spark: SparkSession, root: str) -> DataFrame:
    """The repo table in buckets, or the newest version of one in versions, empty if there is none.

    Versions written before a column was added read it as NULL.
    """
    done = versions(spark, root)
    if not done:
        return read_bucketed_repo(spark, root)
    return conform(spark.read.parquet(version_path(root, done[-1])), REPO)


def publish_repo(df: DataFrame, root: str) -> int:
    """Write the next version of the repo table and return its number. What a failed write left of it is replaced."""
    done = versions(df.sparkSession, root)
    number = done[-1] + 1 if done else 1
    conform(df, REPO).write.mode("overwrite").parquet(version_path(root, number))
    return number


def store_repo(
    batch: DataFrame,
    root: str,
    policy: str = "keep_first",
    seq: Sequence[Column | str] | str = "seq",
    derive_name: bool = True,
) -> int:
    """Upsert a batch into the repo table under `root` and return the new version. One writer at a time."""
    target = read_repo(batch.sparkSession, root)
    return publish_repo(upsert_repo(target, batch, policy, seq, derive_name), root)


def read_stats(spark: SparkSession, root: str) -> DataFrame:
    """The stats table; filters on fetched_date prune its folders."""
    fs, where = folder_of(spark, root)
    if not fs.exists(where):
        return empty(spark, STATS)
    return conform(spark.read.schema(STATS).parquet(root), STATS)


def touched_dates(batch: DataFrame) -> list[dt.date]:
    """Days in a batch: one value per day is all that reaches the driver."""
    return [row[0] for row in batch.select("fetched_date").distinct().collect()]


def store_stats(
    batch: DataFrame, root: str, seq: Sequence[Column | str] | str = "seq", dates: Sequence[dt.date] | None = None
) -> None:
    """Upsert a batch into the stats table, rewriting only its days.

    The merged days are written aside first. The overwrite then reads that copy and not the folders it replaces, so a
    failure half-way loses nothing, and writing the batch again repairs the table. The copy goes when the days are written.
    """
    spark = batch.sparkSession
    dates = touched_dates(batch) if dates is None else list(dates)
    if not dates:
        return
    target = read_stats(spark, root).filter(F.col("fetched_date").isin(dates))
    with staged(upsert_stats(target, batch.filter(F.col("fetched_date").isin(dates)), seq), "stats") as merged:
        _overwrite_days(merged, root)


def _overwrite_days(rows: DataFrame, root: str) -> None:
    """Rebalancing gathers the rows of a day into few files and splits a day that is too large for one."""
    days = rows.hint("rebalance", F.col("fetched_date"))
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fetched_date").parquet(root)


def delete_stored(ids: DataFrame, repo_root: str, stats_root: str) -> None:
    """Delete repos by `id` from the stored tables, their stats first, so that a failure half-way leaves no stats without a repo.

    Only the days that hold one of the ids are rewritten. Deleting again changes nothing. One writer at a time.
    """
    spark, gone = ids.sparkSession, ids.select("id").distinct()
    stats = read_stats(spark, stats_root)
    dates = touched_dates(stats.join(gone, stats["repo_id"] == gone["id"], "left_semi"))
    if dates:
        days = stats.filter(F.col("fetched_date").isin(dates))
        with staged(days.join(gone, days["repo_id"] == gone["id"], "left_anti"), "stats") as kept:
            _overwrite_days(kept, stats_root)
            # The overwrite leaves a day alone that has no rows any more.
            for day in set(dates) - set(touched_dates(kept)):
                drop_folder(spark, f"{stats_root}/fetched_date={day}")
    if versions(spark, repo_root):
        publish_repo(read_repo(spark, repo_root).join(gone, "id", "left_anti"), repo_root)
    else:
        delete_buckets(gone, repo_root)

