"""Status of a landed page, retry collapse, and the cut of page chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from harvest.operators.ranking import first_seen
from harvest.schemas import page_key
from harvest.sources.pages import nodes_of

# Result window of the search service and the tokens its answers are told apart by.
MAX_PAGES = 10
SERVER_ERRORS = [502, 503, 504]
RATE_LIMIT_TEXT = "rate limit"
AUTH_TOKENS = ["FORBIDDEN", "Unauthorized"]
RATE_TOKEN = "RATE_LIMITED"

USABLE = ["ok", "ok_with_errors"]


def status_of() -> Column:
    """ok, ok_with_errors, auth, rate_limited, server_error or failed.

    The first telling entry of `errors` decides; a page without nodes, page info, result count or rate-limit entry
    is failed. A null page info or count reads like an absent one.
    """
    code, body, errors = F.col("http_status"), F.col("body"), F.col("body.errors")

    def has_auth(error: Column) -> Column:
        return error.contains(AUTH_TOKENS[0]) | error.contains(AUTH_TOKENS[1])

    kinds = F.transform(errors, lambda e: F.when(has_auth(e), "auth").when(e.contains(RATE_TOKEN), "rate_limited"))
    telling = F.try_element_at(F.filter(kinds, lambda k: k.isNotNull()), F.lit(1))
    search = body["data"]["search"]
    complete = (
        search["nodes"].isNotNull()
        & search["pageInfo"].isNotNull()
        & search["repositoryCount"].isNotNull()
        & F.map_contains_key(body["data"]["rateLimit"], "remaining")
    )
    limited = F.lower(F.col("text")).contains(RATE_LIMIT_TEXT)
    return (
        F.when(code == 401, "auth")
        .when((code == 403) & limited, "rate_limited")
        .when(code.isin(SERVER_ERRORS), "server_error")
        .when(code.isNull() | (code != 200), "failed")
        .when(telling.isNotNull(), telling)
        .when(complete, F.when(F.size(errors) > 0, "ok_with_errors").otherwise("ok"))
        .otherwise("failed")
    )


def page_status(pages: DataFrame) -> DataFrame:
    return pages.withColumn("status", status_of())


def goes_on() -> Column:
    """True where the page leads to a next one: hasNextPage is true and the rate-limit counter is a number."""
    data = F.col("body.data")
    more = data["search"]["pageInfo"]["hasNextPage"] & data["rateLimit"]["remaining"].try_cast("bigint").isNotNull()
    return F.coalesce(more, F.lit(False))


def attempt_order(pages: DataFrame) -> list[Column]:
    """Last attempt first. Of attempts with one number a usable one leads, then the content decides."""
    ties = [name for name in ("http_status", "status", "has_next", "text", "records") if name in pages.columns]
    usable = [F.col("ok").desc()] if "ok" in pages.columns else []
    return [F.col("attempt").desc(), *usable, *map(F.col, ties)]


def last_attempt(pages: DataFrame) -> DataFrame:
    """The last attempt of every page of a run decides. Earlier attempts are dropped before the shuffle, if there is one."""
    return first_seen(pages, page_key(pages), attempt_order(pages))


def valid_pages(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Pages a chain reaches: up to the first page that fails, is missing, or has no next page, at most `max_pages`.

    Needs one row per page with boolean `ok` and `has_next`. Failed pages are dropped first: page k is reached when
    all pages before it are there and go on. A chain never holds more than `max_pages` rows here.
    """
    before = W.partitionBy(*page_key(pages)[:-1]).orderBy("page_idx").rowsBetween(W.unboundedPreceding, -1)
    leading = F.count(F.when(F.col("has_next"), 1)).over(before)
    reached = pages.filter(F.col("page_idx").between(0, max_pages - 1) & F.col("ok")).withColumn("_leading", leading)
    return reached.filter(F.col("_leading") == F.col("page_idx")).drop("_leading")


def page_flags(pages: DataFrame) -> DataFrame:
    """Add the `ok` and `has_next` flags that `valid_pages` needs, from the status and the body."""
    return page_status(pages).withColumns({"ok": F.col("status").isin(USABLE), "has_next": goes_on()})


def query_yield(pages: DataFrame) -> DataFrame:
    """Rows a query returned against the result count its pages report."""
    rows = F.coalesce(F.size(nodes_of()), F.lit(0))
    return pages.groupBy(*page_key(pages)[:-1]).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(rows).alias("rows"),
        F.max("body.data.search.repositoryCount").alias("reported"),
    )
