"""Metrics of a run, of its pages and of a consolidation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F



def crawl_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    total_found: Column | str | int | None = None,
    target: int = 4000,
) -> DataFrame:
    """Rows, unique owners, total and average stars, success rate, and shortfall against the target.

    Without `by` one row, zeros on empty input. `total_found` is a number or a column that is constant per group;
    left out, it is the number of rows, as in a run that stops at its target.
    """
    rows = F.count(F.lit(1))
    if total_found is None:
        found = rows
    elif isinstance(total_found, int):
        found = F.lit(total_found)
    else:
        found = F.coalesce(F.max(total_found), F.lit(0))
    return df.groupBy(*by).agg(
        rows.alias("rows"),
        F.count_distinct("owner").alias("unique_owners"),
        F.coalesce(F.sum("stars"), F.lit(0)).cast("bigint").alias("total_stars"),
        F.coalesce(F.avg("stars"), F.lit(0.0)).alias("average_stars"),
        F.when(found == 0, F.lit(0.0)).otherwise(rows / found).alias("success_rate"),
        F.greatest(F.lit(target) - rows, F.lit(0)).cast("bigint").alias("shortfall"),
    )


def page_yield(hits: DataFrame) -> DataFrame:
    """Hits and new ids of every page. An id is new on the page that is first, in crawl order, to show it to its job.

    Every hit counts once for its page and once for its id. Both counts go through one scan and two partial
    aggregations, so that no id and no page has to gather all its copies.
    """
    query, page = F.col("query_idx"), F.col("page_idx")
    at = F.struct(query, page, F.col("pos"))

    def side(q: Column, p: Column, id: Column, first: Column) -> Column:
        return F.struct(q.alias("q"), p.alias("p"), id.alias("id"), first.alias("at"))

    none = F.lit(None)
    both = F.array(side(query, page, none, none), side(none, none, F.col("id"), at))
    rows = hits.select("job", F.explode(both).alias("r")).select("job", "r.*")
    once = rows.groupBy("job", "q", "p", "id").agg(F.count(F.lit(1)).alias("hits"), F.min("at").alias("at"))
    per_page = once.groupBy(
        "job", F.coalesce("q", "at.query_idx").alias("query_idx"), F.coalesce("p", "at.page_idx").alias("page_idx")
    )
    return per_page.agg(F.sum(F.when(F.col("at").isNull(), F.col("hits"))).alias("hits"), F.count("at").alias("new_ids"))


def load_report(marked: DataFrame) -> DataFrame:
    """Stored rows, and failed rows by reason, from rows marked with a `reason`."""
    outcome = F.coalesce("reason", F.lit("stored")).alias("outcome")
    return marked.groupBy(outcome).agg(F.count(F.lit(1)).alias("rows"))


def dedup_report(df: DataFrame, key: str = "id") -> DataFrame:
    """Total rows, unique keys, duplicates skipped and the share of duplicates."""
    total, unique = F.count(F.lit(1)), F.count_distinct(F.col(key))
    return skipped_and_rate(df.agg(total.alias("total_rows"), unique.alias("unique_rows")))


def skipped_and_rate(report: DataFrame) -> DataFrame:
    """Total and unique rows with the duplicates between them and their share."""
    skipped = F.col("total_rows") - F.col("unique_rows")
    rate = F.when(F.col("total_rows") == 0, F.lit(0.0)).otherwise(skipped / F.col("total_rows"))
    return report.select("total_rows", "unique_rows", skipped.alias("duplicates_skipped"), rate.alias("overlap_rate"))


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct languages and star ranges a set of queries asks for, and how many queries ask for each."""
    terms = F.array(
        *[
            F.struct(F.lit(name).alias("term"), F.regexp_extract("query_string", rf"(?:^|\s){name}:(\S+)", 1).alias("value"))
            for name in ("language", "stars")
        ]
    )
    rows = queries.select(F.explode(terms).alias("t")).select("t.*").filter(F.col("value") != "")
    return rows.groupBy("term", "value").agg(F.count(F.lit(1)).alias("queries"))


def matrix_report(queries: DataFrame) -> DataFrame:
    """Reach of a query matrix: how many jobs share each primary query, and the first of them."""
    primary = queries.filter(F.col("query_idx") == 0)
    return primary.groupBy("query_string").agg(F.count(F.lit(1)).alias("jobs"), F.min("job").alias("first_job"))
