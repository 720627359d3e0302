"""Page status, chains, replay, first sightings, caps, page and query yield."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import standins as s
from checks.catalog import Tables, check
from harvest.operators import measure, pages, ranking
from harvest.operators.records import record_fields
from harvest.plans import replay as plans
from harvest.plans.replay import replay as run_replay
from harvest.sources.pages import explode_nodes
from harvest.sources.scratch import written

TARGET = 40


@check(f"WITH {s.PAGES_SQL} SELECT job, query_idx, page_idx, attempt, status FROM landed")
def page_status(t: Tables) -> DataFrame:
    return pages.page_status(s.pages(t.events)).select("job", "query_idx", "page_idx", "attempt", "status")


@check(
    f"""
    WITH {s.PAGES_SQL}
    SELECT job, query_idx, page_idx, attempt FROM landed
    QUALIFY row_number() OVER (PARTITION BY job, query_idx, page_idx ORDER BY attempt DESC) = 1
    """
)
def last_attempt(t: Tables) -> DataFrame:
    return pages.last_attempt(s.page_texts(t.events).select("job", "query_idx", "page_idx", "attempt"))


@check(f"WITH {s.PAGES_SQL}, {s.CHAIN_SQL.format(clean='')} SELECT job, query_idx, page_idx, attempt FROM reached")
def valid_page_chain(t: Tables) -> DataFrame:
    flagged = pages.page_flags(s.pages(t.events)).select("job", "query_idx", "page_idx", "attempt", "ok", "has_next")
    return pages.valid_pages(pages.last_attempt(flagged)).drop("ok", "has_next")


def replay_sql(clean: str) -> str:
    return f"""
    WITH {s.PAGES_SQL}, {s.CHAIN_SQL.format(clean=clean)},
    hits AS (
      SELECT n.* FROM nodes n JOIN reached r USING (job, query_idx, page_idx, attempt) WHERE n.id > 0
    ),
    firsts AS (
      SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY job, id ORDER BY query_idx, page_idx, pos) = 1
    )
    SELECT job, query_idx, page_idx, pos, id, 'n' || id AS name, owner, 'https://example.com/n' || id AS url, stars,
           TIMESTAMP '2024-01-01' AS created_at
    FROM firsts QUALIFY row_number() OVER (PARTITION BY job ORDER BY query_idx, page_idx, pos) <= {TARGET}
    """


@check(replay_sql(s.CLEAN_SQL))
def replay(t: Tables) -> DataFrame:
    return run_replay(s.pages(t.events), TARGET, "page")


@check(replay_sql(""))
def replay_skipping_bad_rows(t: Tables) -> DataFrame:
    return run_replay(s.pages(t.events), TARGET, "row")


# Two runs on two days share their page keys.
RUNS_SQL = "'run' || job % 2 AS run, DATE '2024-03-01' + job % 2 AS fetched_date, job // 2 AS job"


def two_runs(t: Tables) -> DataFrame:
    """The landed pages as those of two runs, the odd jobs a day after the even ones."""
    odd = F.col("job") % 2
    runs = {
        "run": F.concat(F.lit("run"), odd.cast("string")),
        "fetched_date": F.date_add(F.lit("2024-03-01").cast("date"), odd),
        "job": F.expr("job div 2").cast("int"),
    }
    return s.pages(t.events).withColumns(runs)


@check(f"SELECT * EXCLUDE (job), {RUNS_SQL} FROM ({replay_sql(s.CLEAN_SQL)})")
def replay_two_runs(t: Tables) -> DataFrame:
    return run_replay(two_runs(t), TARGET, "page")


OUTCOMES_SQL = f"""
    WITH {s.PAGES_SQL}, {s.CHAIN_SQL.format(clean=s.CLEAN_SQL)},
    counted AS MATERIALIZED (
      SELECT job, query_idx, page_idx, ok, attempt AS last, coalesce(count(*) FILTER (ok AND has_next) OVER (
               PARTITION BY job, query_idx ORDER BY page_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = page_idx AS gapless
      FROM last_try
    ),
    led AS (
      SELECT l.job, l.query_idx, l.page_idx, l.attempt, l.status, c.ok, c.last, c.gapless
      FROM landed l JOIN counted c USING (job, query_idx, page_idx)
    ),
    page_outcomes AS MATERIALIZED (
      SELECT job, query_idx, page_idx, attempt, status,
             CASE WHEN page_idx >= 10 THEN 'outside_window' WHEN attempt <> last THEN 'retried' WHEN NOT gapless THEN 'not_reached'
                  WHEN ok THEN 'reached' WHEN status IN ('ok', 'ok_with_errors') THEN 'bad_nodes' ELSE status END AS outcome
      FROM led
    )"""


@check(f"{OUTCOMES_SQL} SELECT * FROM page_outcomes")
def page_outcomes(t: Tables) -> DataFrame:
    return plans.page_outcomes(s.pages(t.events)).drop("records", "raw")


@check(
    f"""
    {OUTCOMES_SQL},
    landed_nodes AS MATERIALIZED (
      SELECT n.job, n.query_idx, n.page_idx, n.attempt, n.pos, n.id, p.outcome AS page
      FROM nodes n JOIN page_outcomes p USING (job, query_idx, page_idx, attempt)
      JOIN landed l USING (job, query_idx, page_idx, attempt)
      WHERE l.status IN ('ok', 'ok_with_errors') OR (l.event_type = 'error' AND l.value >= 50 AND l.value < 55)
    ),
    hits AS (SELECT * FROM landed_nodes WHERE page = 'reached'),
    firsts AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY job, id ORDER BY query_idx, page_idx, pos) = 1),
    placed AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY query_idx, page_idx, pos) AS place FROM firsts)
    SELECT job, query_idx, page_idx, attempt, pos, n.id,
           CASE WHEN n.page IN ('reached', 'bad_nodes') AND n.id <= 0 THEN 'id_not_positive' WHEN n.page <> 'reached' THEN 'page_' || n.page
                WHEN place <= {TARGET} THEN 'stored' WHEN place > {TARGET} THEN 'over_target' ELSE 'repeated' END AS outcome
    FROM landed_nodes n LEFT JOIN placed USING (job, query_idx, page_idx, attempt, pos)
    """
)
def node_outcomes(t: Tables) -> DataFrame:
    outcomes = written(plans.page_outcomes(s.pages(t.events)), "outcomes")
    return plans.node_outcomes(outcomes, TARGET).select("job", "query_idx", "page_idx", "attempt", "pos", "id", "outcome")


def _hits(t: Tables) -> DataFrame:
    usable = pages.page_status(s.pages(t.events)).filter(F.col("status").isin(pages.USABLE))
    return explode_nodes(usable).select("job", "query_idx", "page_idx", "pos", *record_fields(F.col("node")))


@check(
    f"""
    WITH {s.PAGES_SQL}, hits AS (
      SELECT *, row_number() OVER (PARTITION BY job, id ORDER BY query_idx, page_idx, pos) = 1 AS is_new
      FROM nodes WHERE status IN ('ok', 'ok_with_errors')
    )
    SELECT job, query_idx, page_idx, count(*) AS hits, count(*) FILTER (is_new) AS new_ids FROM hits GROUP BY 1, 2, 3
    """
)
def page_yield(t: Tables) -> DataFrame:
    return measure.page_yield(_hits(t))


@check(
    f"""
    WITH {s.PAGES_SQL}
    SELECT job, query_idx, count(*) AS pages, 8 * count(*) AS rows, CAST(500 AS BIGINT) AS reported
    FROM landed WHERE status IN ('ok', 'ok_with_errors') GROUP BY 1, 2
    """
)
def query_yield(t: Tables) -> DataFrame:
    return pages.query_yield(pages.page_status(s.pages(t.events)).filter(F.col("status").isin(pages.USABLE)))


_SIGHTING = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@check(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
    """
)
def first_seen(t: Tables) -> DataFrame:
    return ranking.first_seen(t.lineitem.select("l_orderkey", *_SIGHTING), "l_orderkey", _SIGHTING)


@check(
    """
    SELECT l_linenumber, l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_linenumber ORDER BY l_orderkey, l_partkey, l_suppkey, l_extendedprice) <= 4000
    """
)
def target_cap(t: Tables) -> DataFrame:
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
    return ranking.cap(t.lineitem.select("l_linenumber", *order), 4000, "l_linenumber", order)


@check(
    """
    SELECT l_returnflag, l_extendedprice, l_orderkey, l_linenumber FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 1000
    """
)
def top_1000_per_query(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber")
    return ranking.result_window(rows, ["l_returnflag"], [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"])
