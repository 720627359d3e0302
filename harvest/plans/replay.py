"""What a sequential harvest run would have collected from a set of landed pages, and what became of the rest."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from harvest.functions import rules
from harvest.functions.timestamps import parse_ts
from harvest.operators.pages import MAX_PAGES, USABLE, attempt_order, last_attempt, page_flags, valid_pages
from harvest.operators.ranking import cap, first_seen
from harvest.operators.records import record_fields
from harvest.schemas import MALFORMED, PAGE_KEY, page_key, run_key
from harvest.sources.pages import nodes_of, parsed_nodes

CRAWL_ORDER = ["query_idx", "page_idx", "pos"]


def node_records(nodes: Column) -> Column:
    """Raw nodes to an array of (record fields, reason), in page order. The time of a node is parsed once and only then used twice."""

    def record(raw: Column, node: Column) -> Column:
        return F.transform(F.array(parse_ts(node["createdAt"])), lambda at: judged(raw, node, at))[0]

    def judged(raw: Column, node: Column, at: Column) -> Column:
        sound = F.coalesce(rules.sound_node(node, at), F.lit(False))
        reason = F.when(~sound, rules.first_broken(rules.node_rules(raw, node, at)))
        return F.struct(*record_fields(node, created_at=at), reason.alias("reason"))

    return parsed_nodes(nodes, record)


def _day(pages: DataFrame) -> list[str]:
    return ["fetched_date"] if "fetched_date" in pages.columns else []


def parsed_pages(pages: DataFrame, on_bad: str = "row", extra: tuple[Column, ...] = ()) -> DataFrame:
    """Page keys, attempt, status flags and the node records: all that later steps need, without the page text.

    With `on_bad="page"` a page with a bad node is not `ok`.
    """
    if on_bad not in ("page", "row"):
        raise ValueError(f"on_bad must be 'page' or 'row', not {on_bad!r}")
    parsed = page_flags(pages).select(
        *page_key(pages), *_day(pages), "attempt", "status", "ok", "has_next", node_records(nodes_of()).alias("records"), *extra
    )
    if on_bad == "row":
        return parsed
    clean = F.forall("records", lambda r: r["reason"].isNull())
    return parsed.withColumn("ok", F.col("ok") & F.coalesce(clean, F.lit(False)))


def _collected(good: DataFrame, target: int, salts: int | None) -> tuple[DataFrame, DataFrame]:
    """First hits of every id of a job, and those of them within the target."""
    job = [*run_key(good), "job"]
    firsts = first_seen(good, [*job, "id"], CRAWL_ORDER)
    return firsts, cap(firsts, target, job, CRAWL_ORDER, salts)


def replay(
    pages: DataFrame, target: int = 4000, on_bad: str = "page", max_pages: int = MAX_PAGES, salts: int | None = 1
) -> DataFrame:
    """Records a run collects, one row per run, job and id, in crawl order up to `target` per job.

    A page counts if its last attempt is usable; a chain ends at its first unusable page. With `on_bad="page"` one
    bad node makes its page unusable, with `on_bad="row"` only the node is left out. What is left out, and why, is in
    `page_outcomes` and `node_outcomes`.

    One shuffle by chain serves both the choice of the attempt and the cut of the chain. The target needs no salts: map
    tasks keep `target` rows of a job each.
    """
    parsed = parsed_pages(pages.filter(F.col("page_idx").between(0, max_pages - 1)), on_bad)
    by_chain = parsed.repartition(*page_key(parsed)[:-1])
    chain = valid_pages(last_attempt(by_chain), max_pages)
    keep = [*page_key(chain), *_day(chain)]
    hits = chain.select(*keep, F.posexplode("records").alias("pos", "r")).select(*keep, "pos", "r.*")
    return _collected(hits.filter(F.col("reason").isNull()).drop("reason"), target, salts)[1]


def page_outcomes(pages: DataFrame, on_bad: str = "page", max_pages: int = MAX_PAGES) -> DataFrame:
    """Every landed page with its `outcome`, its node `records`, and the raw text of an answer that was not usable.

    reached: its nodes were read. retried: a later attempt decided. outside_window: beyond the pages a query can return.
    not_reached: a page before it failed, is missing, or was the last. The status (failed, auth, rate_limited,
    server_error) or bad_nodes: it ended its chain. malformed: a line that is not JSON or lacks a part of its key; such
    lines are kept apart, so that they do not meet in one task.
    """
    has = set(pages.columns)
    texts = [F.col(name) for name in (MALFORMED, "text") if name in has]
    raw = F.coalesce(*texts) if texts else F.lit(None).cast("string")
    keyed = reduce(and_, (F.col(name).isNotNull() for name in PAGE_KEY))
    if MALFORMED in has:
        keyed &= F.col(MALFORMED).isNull()
    flagged = parsed_pages(pages.filter(keyed), on_bad, extra=(F.when(~F.col("status").isin(USABLE), raw).alias("raw"),))
    key = page_key(flagged)
    inside = F.col("page_idx").between(0, max_pages - 1)
    last = F.row_number().over(W.partitionBy(*key).orderBy(*attempt_order(flagged))) == 1
    judged = flagged.repartition(*key[:-1]).withColumn("_last", last)
    before = W.partitionBy(*key[:-1]).orderBy("page_idx").rangeBetween(W.unboundedPreceding, -1)
    leading = F.count(F.when(F.col("_last") & F.col("ok") & F.col("has_next") & inside, 1)).over(before)
    outcome = (
        F.when(~inside, "outside_window")
        .when(~F.col("_last"), "retried")
        .when(F.col("_leading") != F.col("page_idx"), "not_reached")
        .when(F.col("ok"), "reached")
        .when(F.col("status").isin(USABLE), "bad_nodes")
        .otherwise(F.col("status"))
    )
    told = judged.withColumn("_leading", leading).withColumn("outcome", outcome).drop("_last", "_leading", "ok", "has_next")
    nodes = F.lit(None).cast(told.schema["records"].dataType)
    lost = pages.filter(~keyed).select(
        *key, *_day(pages), "attempt", F.lit("failed").alias("status"), nodes.alias("records"), raw.alias("raw"),
        F.lit("malformed").alias("outcome"),
    )
    return told.unionByName(lost)


def _landed_nodes(outcomes: DataFrame) -> DataFrame:
    keep = [*page_key(outcomes), *_day(outcomes), "attempt", F.col("outcome").alias("page")]
    names = [*page_key(outcomes), *_day(outcomes), "attempt", "page"]
    return outcomes.select(*keep, F.posexplode("records").alias("pos", "r")).select(*names, "pos", "r.*")


def taken_nodes(outcomes: DataFrame, target: int = 4000, salts: int | None = 1) -> DataFrame:
    """The nodes of `page_outcomes` that a run stores, and those of read pages that break a rule, with the reason. No join."""
    nodes = _landed_nodes(outcomes)
    kept = _collected(nodes.filter((F.col("page") == "reached") & F.col("reason").isNull()), target, salts)[1]
    broken = nodes.filter(F.col("reason").isNotNull() & F.col("page").isin("reached", "bad_nodes"))
    return kept.unionByName(broken).drop("page")


def node_outcomes(outcomes: DataFrame, target: int = 4000, salts: int | None = 1) -> DataFrame:
    """Every landed node of `page_outcomes` with its `outcome`, and the `reason` of a node that breaks a rule.

    stored; repeated: its job met the id before; over_target: its job was full; the reason, if the node breaks a rule; else
    page_ and the outcome of its page. The pages are read several times: write them first if they are costly.
    """
    nodes = _landed_nodes(outcomes)
    read = F.col("page") == "reached"
    firsts, kept = _collected(nodes.filter(read & F.col("reason").isNull()), target, salts)
    place = [*page_key(nodes), "pos"]
    marks = firsts.select(*place, F.lit(1).alias("mark")).unionByName(kept.select(*place, F.lit(2).alias("mark")))
    best = marks.groupBy(*place).agg(F.max("mark").alias("mark")).alias("m")
    same = reduce(and_, (F.col(f"n.{name}").eqNullSafe(F.col(f"m.{name}")) for name in place))
    joined = nodes.alias("n").join(best, same & (F.col("n.page") == "reached"), "left").select("n.*", "m.mark")
    judged = F.col("page").isin("reached", "bad_nodes")
    outcome = (
        F.when(judged & F.col("reason").isNotNull(), F.col("reason"))
        .when(~read, F.concat(F.lit("page_"), "page"))
        .when(F.col("mark") == 2, "stored")
        .when(F.col("mark") == 1, "over_target")
        .otherwise("repeated")
    )
    return joined.withColumn("outcome", outcome).drop("mark")
