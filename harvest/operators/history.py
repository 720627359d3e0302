"""Star history. The stats table has one row per repo and day, so a repo holds no more rows than days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def latest_stats(stats: DataFrame) -> DataFrame:
    """The newest row of every repo, by hash aggregation without a sort."""
    newest = stats.groupBy("repo_id").agg(
        F.max("fetched_date").alias("fetched_date"), F.max_by("stars", "fetched_date").alias("stars")
    )
    return newest.select("repo_id", "fetched_date", "stars")


def star_growth(stats: DataFrame) -> DataFrame:
    """Change of stars and days passed since the previous fetch; NULL on the first fetch of a repo."""
    by_date = W.partitionBy("repo_id").orderBy("fetched_date")
    return stats.select(
        "repo_id",
        "fetched_date",
        "stars",
        (F.col("stars") - F.lag("stars").over(by_date)).alias("star_change"),
        F.date_diff("fetched_date", F.lag("fetched_date").over(by_date)).alias("days"),
    )
