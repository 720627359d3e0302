"""A run into the tables and out again: replay, check, stage, upsert, report, export."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from harvest.functions.names import with_fetched, with_partition
from harvest.operators.combine import export_view
from harvest.operators.history import latest_stats
from harvest.operators.measure import crawl_metrics, load_report
from harvest.operators.pages import MAX_PAGES
from harvest.operators.records import marked, repo_reason, table_reason
from harvest.plans.replay import page_outcomes, taken_nodes
from harvest.schemas import PARTITION_WIDTH, page_key, run_key
from harvest.sources.buckets import store_buckets
from harvest.sources.exports import export_csv, write_bad
from harvest.sources.scratch import drop_folder, new_path, shuffles_dropped, staged
from harvest.sources.tables import drop_versions, read_repo, read_stats, store_repo, store_stats, versions


class Roots(NamedTuple):
    """Folders of the tables."""

    repo: str
    stats: str
    bad: str


class Loaded(NamedTuple):
    """Outcome of a load: stored and failed rows by reason, and the metrics of every job's stored rows.

    Both are counted when they are read, from the staged copy of the records. `release` deletes that copy.
    """

    report: DataFrame
    metrics: DataFrame
    staged: str

    def release(self) -> None:
        drop_folder(self.report.sparkSession, self.staged)


def write_order(records: DataFrame) -> list[str]:
    """The order in which the runs would have written: by day, run, job, and place in the crawl."""
    attempt = ["attempt"] if "attempt" in records.columns else []
    return ["fetched_date", *page_key(records), *attempt, "pos"]


def checked_records(records: DataFrame, date, width: int = PARTITION_WIDTH) -> DataFrame:
    """Records as they would be stored, each with the `reason` it is rejected for or NULL.

    A reason or a fetch day that they bring stays.
    """
    day = F.lit(date).cast("date")
    own = F.coalesce("fetched_date", day) if "fetched_date" in records.columns else day
    rows = with_fetched(with_partition(records), own)
    known = F.col("reason") if "reason" in records.columns else F.lit(None).cast("string")
    return marked(rows, F.coalesce(known, repo_reason(), table_reason(rows, width)))


def store_good(good: DataFrame, roots: Roots, policy: str, order: list[str], days: list[dt.date] | None) -> None:
    """Upsert checked records into both tables; `days` are their fetch days, None if they tell."""
    spark = good.sparkSession
    if versions(spark, roots.repo):
        store_repo(good, roots.repo, policy, order)
        drop_versions(spark, roots.repo)
    else:
        store_buckets(good, roots.repo, policy, order)
    stats = good.select(F.col("id").alias("repo_id"), F.col("stars").cast("int").alias("stars"), *order)
    store_stats(stats, roots.stats, order, days)


def store_checked(rows: DataFrame, roots: Roots, policy: str, label: str | None, days: list[dt.date] | None) -> None:
    """Store checked records in both tables and among the rejected rows; `days` are their fetch days, None if they tell.

    The rows are read several times, so they should lie in files. The shuffle files of each step go when it ends.
    """
    with shuffles_dropped(rows.sparkSession):
        store_good(rows.filter(F.col("reason").isNull()), roots, policy, write_order(rows), days)
        write_bad(rows.filter(F.col("reason").isNotNull()), roots.bad, label)


def load_records(
    records: DataFrame,
    roots: Roots,
    date: dt.date,
    policy: str = "keep_first",
    label: str | None = None,
    target: int = 4000,
    width: int = PARTITION_WIDTH,
) -> Loaded:
    """Store the records of one or more jobs and runs; `date` is the fetch day of records that bring none.

    The checked records are staged once; both tables, the rejected rows, the report and the metrics read the staged
    copy. A new repo table is kept in buckets, of which a load rewrites those that it touches; one that is kept in versions stays so, and
    its newest two versions stay. Loading the same records again changes neither table; give the same `label` to replace the rejected rows too.
    `width` is that of the partition column; `readmit` takes rows again that a narrower one had no room for.
    """
    path, checked = new_path(records.sparkSession, "records"), checked_records(records, date, width)
    checked.write.parquet(path)
    rows = records.sparkSession.read.schema(checked.schema).parquet(path)
    store_checked(rows, roots, policy, label, None if "fetched_date" in records.columns else [date])
    good = rows.filter(F.col("reason").isNull())
    return Loaded(load_report(rows), crawl_metrics(good, [*run_key(good), "job"], target=target), path)


def harvest_pages(
    pages: DataFrame,
    roots: Roots,
    date: dt.date,
    target: int = 4000,
    on_bad: str = "page",
    policy: str = "keep_first",
    label: str | None = None,
    max_pages: int = MAX_PAGES,
) -> Loaded:
    """Whole runs on landed pages: replay the jobs, store what they collect, measure it.

    Nodes that break a rule and pages that were not read (except attempts that a later one replaced) go to the rejected
    rows, pages with the raw answer. The pages are parsed once, into a staged copy that goes when the load is over.
    """
    with staged(page_outcomes(pages, on_bad, max_pages), "pages") as outcomes:
        taken = taken_nodes(outcomes, target)
        unread = outcomes.filter(~F.col("outcome").isin("reached", "retried")).withColumn("reason", F.concat(F.lit("page_"), "outcome"))
        unread = unread.drop("records", "status", "outcome")
        return load_records(taken.unionByName(unread, allowMissingColumns=True), roots, date, policy, label, target)


def export_latest(spark: SparkSession, roots: Roots, path: str, files: int | None = None) -> None:
    """Replace the CSV export by the repo table with the newest star count of every row."""
    export_csv(export_view(read_repo(spark, roots.repo), latest_stats(read_stats(spark, roots.stats))), path, files)
