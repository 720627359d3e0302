"""Upserts, key relations, metrics, consolidation, history, coverage, outputs, stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from checks import standins as s
from checks.catalog import Tables, check
from checks.page_checks import RUNS_SQL, TARGET, replay_sql, two_runs
from harvest.operators import combine, coverage, history, measure, upsert
from harvest.plans.load import Roots, export_latest, harvest_pages, load_records
from harvest.plans.readmit import readmit
from harvest.sources import matrix, matrix_values as v
from harvest.sources.exports import export_csv, write_jobs
from harvest.sources.scratch import drop_folder, new_path, shuffles_dropped
from harvest.sources.tables import delete_stored, publish_repo, read_repo, read_stats, store_repo, store_stats, version_path
from harvest.streaming.ingest import ingest_stream
from harvest.streaming.sightings import stream_sightings

DAY = dt.date.fromisoformat(s.FETCHED)
#: Events whose pages make up a landed file of about 700 MB.
EVENTS_IN_FILE = 500_000
#: Landed files that a stream finds at a time where more pages land than fit into so many.
FILES_AT_A_TIME = 12
_EXPORT_SCHEMA = "id bigint, name string, name_with_owner string, url string, created_at string, stars int, crawled_at date"

_FOLD_SQL = f"""
    WITH {s.CUSTOMER_REPO_SQL}, {s.ORDER_BATCH_SQL},
    first AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1),
    last AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1),
    labels AS (
      SELECT id, alphabet_partition FROM batch WHERE alphabet_partition IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1
    )"""


@check(
    f"""{_FOLD_SQL}
    SELECT f.id, f.name, f.owner, f.url, f.created_at, l.alphabet_partition, l.owner || '/' || l.name AS last_name_with_owner
    FROM first f JOIN last l USING (id)
    """
)
def fold_keep_first(t: Tables) -> DataFrame:
    return upsert.fold_batch(s.order_batch(t.orders), "seq", "keep_first")


@check(
    f"""{_FOLD_SQL}
    SELECT l.id, l.name, l.owner, l.url, l.created_at, p.alphabet_partition, l.owner || '/' || l.name AS last_name_with_owner
    FROM last l LEFT JOIN labels p USING (id)
    """
)
def fold_overwrite(t: Tables) -> DataFrame:
    return upsert.fold_batch(s.order_batch(t.orders), "seq", "overwrite")


KEEP_FIRST_SQL = f"""{_FOLD_SQL}
    SELECT coalesce(t.id, f.id) AS id,
           CASE WHEN t.id IS NOT NULL THEN t.name ELSE f.name END AS name,
           CASE WHEN t.id IS NOT NULL THEN t.owner ELSE f.owner END AS owner,
           CASE WHEN t.id IS NOT NULL THEN t.url ELSE f.url END AS url,
           CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE f.created_at END AS created_at,
           CASE WHEN l.id IS NOT NULL THEN l.alphabet_partition ELSE t.alphabet_partition END AS alphabet_partition,
           CASE WHEN l.id IS NULL THEN t.name_with_owner WHEN t.id IS NOT NULL THEN t.owner || '/' || t.name
                ELSE f.owner || '/' || f.name END AS name_with_owner
    FROM target t FULL JOIN (first f JOIN last l USING (id)) ON t.id = f.id
    """


@check(KEEP_FIRST_SQL)
def upsert_keep_first(t: Tables) -> DataFrame:
    return upsert.upsert_repo(s.customer_repo(t.customer), s.order_batch(t.orders), "keep_first")


OVERWRITE_SQL = f"""{_FOLD_SQL}
    SELECT coalesce(t.id, l.id) AS id,
           CASE WHEN l.id IS NOT NULL THEN l.name ELSE t.name END AS name,
           CASE WHEN l.id IS NOT NULL THEN l.owner ELSE t.owner END AS owner,
           CASE WHEN l.id IS NOT NULL THEN l.url ELSE t.url END AS url,
           CASE WHEN l.id IS NOT NULL THEN l.created_at ELSE t.created_at END AS created_at,
           coalesce(p.alphabet_partition, t.alphabet_partition) AS alphabet_partition,
           CASE WHEN l.id IS NOT NULL THEN l.owner || '/' || l.name ELSE t.name_with_owner END AS name_with_owner
    FROM target t FULL JOIN last l ON t.id = l.id LEFT JOIN labels p ON p.id = l.id
    """


@check(OVERWRITE_SQL)
def upsert_overwrite(t: Tables) -> DataFrame:
    return upsert.upsert_repo(s.customer_repo(t.customer), s.order_batch(t.orders), "overwrite")


_STATS_UPSERT_SQL = f"""
    WITH {s.STATS_SQL}, later AS (
      SELECT repo_id, fetched_date + 1 AS fetched_date, stars + 1 AS stars, seq FROM stats_rows
    ),
    folded AS (
      SELECT repo_id, CAST(fetched_date AS DATE) AS fetched_date, stars FROM later
      QUALIFY row_number() OVER (PARTITION BY repo_id, fetched_date ORDER BY seq DESC) = 1
    )
    SELECT repo_id, fetched_date, CAST(coalesce(f.stars, s.stars) AS INTEGER) AS stars
    FROM stats s FULL JOIN folded f USING (repo_id, fetched_date)
    """


def _later_batch(t: Tables) -> DataFrame:
    return s.stats_rows(t.events).withColumns(
        {"fetched_date": F.date_add("fetched_date", 1), "stars": F.col("stars") + 1}
    )


def _stats(t: Tables) -> DataFrame:
    return upsert.fold_stats(s.stats_rows(t.events))


@check(_STATS_UPSERT_SQL)
def upsert_stats(t: Tables) -> DataFrame:
    return upsert.upsert_stats(_stats(t), _later_batch(t))


@check(f"WITH {s.STATS_SQL} SELECT repo_id, fetched_date, stars FROM stats_rows r WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = repo_id)")
def orphans(t: Tables) -> DataFrame:
    return upsert.orphans(s.stats_rows(t.events).drop("seq"), s.customer_repo(t.customer))


@check(f"WITH {s.STATS_SQL} SELECT repo_id, fetched_date, stars FROM stats_rows r WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = repo_id)")
def stats_with_parent(t: Tables) -> DataFrame:
    return upsert.with_parent(s.stats_rows(t.events).drop("seq"), s.customer_repo(t.customer))


@check(
    """
    SELECT 'repo' AS source, o_orderkey AS id, count(*) AS rows FROM orders
    WHERE o_orderkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2
    UNION ALL
    SELECT 'stats', l_orderkey, count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2
    """
)
def cascade_delete(t: Tables) -> DataFrame:
    repo = t.orders.select(F.col("o_orderkey").alias("id"))
    stats = t.lineitem.select(F.col("l_orderkey").alias("repo_id"))
    left, facts = upsert.delete_repos(repo, stats, t.part.select(F.col("p_partkey").alias("id")))
    rows = left.select(F.lit("repo").alias("source"), "id").unionByName(
        facts.select(F.lit("stats").alias("source"), F.col("repo_id").alias("id"))
    )
    return rows.groupBy("source", "id").agg(F.count(F.lit(1)).alias("rows"))


@check("SELECT l_orderkey AS id, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def not_seen(t: Tables) -> DataFrame:
    seen = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    return upsert.not_seen(t.lineitem.select(F.col("l_orderkey").alias("id"), "l_partkey"), seen)


@check(
    f"""
    WITH {s.CUSTOMER_REPO_SQL}
    SELECT id, coalesce(name_with_owner, owner || '/' || name) AS name_with_owner FROM target
    """
)
def backfill_name(t: Tables) -> DataFrame:
    return upsert.backfill_name(s.customer_repo(t.customer)).select("id", "name_with_owner")


_METRICS_SQL = """count(*) AS rows, count(DISTINCT owner) AS unique_owners, CAST(coalesce(sum(stars), 0) AS BIGINT) AS total_stars,
    round(coalesce(avg(stars), 0.0), 6) AS average_stars"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("average_stars", "success_rate")})


@check(
    f"""
    WITH {s.REPO_SQL}
    SELECT language, {_METRICS_SQL}, CAST(1.0 AS DOUBLE) AS success_rate, CAST(greatest(500 - count(*), 0) AS BIGINT) AS shortfall
    FROM repo GROUP BY language
    """
)
def crawl_metrics(t: Tables) -> DataFrame:
    return _rounded(measure.crawl_metrics(s.repo(t.part), ["language"], target=500))


@check(
    f"""
    WITH {s.REPO_SQL}
    SELECT {_METRICS_SQL}, round(CAST(count(*) AS DOUBLE) / (max(id) * 2), 6) AS success_rate,
           CAST(greatest(4000 - count(*), 0) AS BIGINT) AS shortfall
    FROM repo
    """
)
def crawl_metrics_total(t: Tables) -> DataFrame:
    """The whole table as one run that found twice as many rows as its largest id."""
    return _rounded(measure.crawl_metrics(s.repo(t.part).withColumn("found", F.col("id") * 2), total_found="found"))


@check(
    f"""
    WITH {s.REPO_SQL}
    SELECT {_METRICS_SQL}, CAST(0.0 AS DOUBLE) AS success_rate, CAST(4000 AS BIGINT) AS shortfall FROM repo WHERE stars < 0
    """
)
def crawl_metrics_empty(t: Tables) -> DataFrame:
    return _rounded(measure.crawl_metrics(s.repo(t.part).filter(F.col("stars") < 0)))


def _job_rows(t: Tables) -> DataFrame:
    """Line items as the outputs of seven jobs with overlapping ids."""
    return t.lineitem.select(F.col("l_linenumber").alias("job"), F.col("l_orderkey").alias("id"), "l_partkey", "l_extendedprice")


@check(
    """
    SELECT l_linenumber AS job, l_orderkey AS id, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) = 1
    """
)
def consolidate(t: Tables) -> DataFrame:
    return combine.consolidate(_job_rows(t), ["job", "l_partkey", "l_extendedprice"])


@check(
    """
    SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS unique_rows, count(*) - count(DISTINCT l_orderkey) AS duplicates_skipped,
           round(1 - CAST(count(DISTINCT l_orderkey) AS DOUBLE) / count(*), 6) AS overlap_rate
    FROM lineitem
    """
)
def dedup_report(t: Tables) -> DataFrame:
    return measure.dedup_report(_job_rows(t)).withColumn("overlap_rate", F.round("overlap_rate", 6))


@check("SELECT l_orderkey AS id, count(DISTINCT l_linenumber) AS jobs FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) > 1")
def job_overlap(t: Tables) -> DataFrame:
    return combine.overlap(_job_rows(t))


@check("SELECT l_orderkey AS id, min(l_linenumber) AS job FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linenumber) = 1")
def single_job_ids(t: Tables) -> DataFrame:
    return combine.exclusive(_job_rows(t))


@check("SELECT l_orderkey AS id FROM lineitem INTERSECT SELECT p_partkey FROM part")
def ids_in_both(t: Tables) -> DataFrame:
    return combine.in_both(_job_rows(t), s.repo(t.part))


@check("SELECT l_partkey AS id FROM lineitem EXCEPT ALL SELECT o_custkey FROM orders")
def ids_left_over(t: Tables) -> DataFrame:
    return combine.only_left(t.lineitem.select(F.col("l_partkey").alias("id")), t.orders.select(F.col("o_custkey").alias("id")))


@check("SELECT DISTINCT p_brand AS owner FROM part")
def distinct_owners(t: Tables) -> DataFrame:
    return combine.distinct_values(s.repo(t.part), "owner")


@check(
    f"""
    WITH {s.STATS_SQL}
    SELECT repo_id, fetched_date, stars FROM stats QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY fetched_date DESC) = 1
    """
)
def latest_stats(t: Tables) -> DataFrame:
    return history.latest_stats(_stats(t))


@check(
    f"""
    WITH {s.STATS_SQL}
    SELECT repo_id, fetched_date, stars, stars - lag(stars) OVER w AS star_change,
           CAST(date_diff('day', lag(fetched_date) OVER w, fetched_date) AS INTEGER) AS days
    FROM stats WINDOW w AS (PARTITION BY repo_id ORDER BY fetched_date)
    """
)
def star_growth(t: Tables) -> DataFrame:
    return history.star_growth(_stats(t))


_EXPORT_SQL = f"""
    WITH {s.CUSTOMER_REPO_SQL}, {s.STATS_SQL}, newest AS (
      SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY fetched_date DESC) = 1
    )
    SELECT id, name, coalesce(name_with_owner, owner || '/' || name) AS name_with_owner, url, created_at, stars,
           fetched_date AS crawled_at
    FROM target JOIN newest ON id = repo_id
    """


@check(_EXPORT_SQL)
def export_view(t: Tables) -> DataFrame:
    return combine.export_view(s.customer_repo(t.customer), history.latest_stats(_stats(t)))


# Matrix and coverage


def _list_sql(values: list, cast: str = "") -> str:
    return "[" + ", ".join("NULL" if x is None else "'" + str(x).replace("'", "''") + "'" for x in values) + "]" + cast


def matrix_sql(scheme: str, jobs: str) -> str:
    """Matrix rows of the jobs in a one-column query, written out strategy by strategy."""
    plan = matrix.scheme_of(scheme)
    parts = []
    for number, (strategy, lists, templates) in enumerate(plan.strategies):
        fields, step = {"job": "CAST(job AS VARCHAR)"}, 1
        for name in lists:
            entries = plan.specials if name == "special" else plan.lists[name]
            index = f"[job // {step} % {len(entries)} + 1]"
            if name == "special":
                fields["special"] = _list_sql([query for query, _ in entries]) + index
                fields["special_description"] = _list_sql([text for _, text in entries]) + index
            else:
                fields[name] = _list_sql(entries) + index
            step *= len(entries)
        for position, (query, description, expected) in enumerate(templates):
            q, d = ("'" + x + "'" for x in (query, description))
            for name, value in fields.items():
                q, d = (x.replace("{" + name + "}", f"' || {value} || '") for x in (q, d))
            parts.append(
                f"SELECT job, {position} AS query_idx, {q} AS query_string, {d} AS description, {expected} AS expected_results, "
                f"'{strategy}' AS strategy FROM jobs WHERE job % {len(plan.strategies)} = {number}"
            )
    return f"jobs AS ({jobs}), matrix AS (" + " UNION ALL ".join(parts) + ")"


_CUSTOMER_JOBS = "SELECT c_custkey AS job FROM customer"
_MATRIX_COLUMNS = ["job", "query_idx", "query_string", "description", "expected_results", "strategy"]


def customer_matrix(t: Tables, scheme: str) -> DataFrame:
    """A matrix with a job per customer."""
    return matrix.queries_for(t.customer.select(F.col("c_custkey").alias("job")), scheme)


@check(f"WITH {matrix_sql('fine', _CUSTOMER_JOBS)} SELECT * FROM matrix")
def matrix_queries(t: Tables) -> DataFrame:
    return customer_matrix(t, "fine").select(*_MATRIX_COLUMNS)


@check(f"WITH {matrix_sql('coarse', _CUSTOMER_JOBS)} SELECT * FROM matrix")
def matrix_queries_coarse(t: Tables) -> DataFrame:
    return customer_matrix(t, "coarse").select(*_MATRIX_COLUMNS)


_BOUNDS_SQL = r"""
    SELECT job, query_idx, nullif(regexp_extract(query_string, 'language:(\S+)', 1), '') AS language,
      nullif(regexp_extract(query_string, 'topic:(\S+)', 1), '') AS topic,
      nullif(regexp_extract(query_string, 'license:(\S+)', 1), '') AS license,
      CASE WHEN query_string LIKE '%stars:>%' THEN CAST(regexp_extract(query_string, 'stars:>(\d+)', 1) AS BIGINT) + 1
        ELSE TRY_CAST(regexp_extract(query_string, 'stars:(\d+)\.\.', 1) AS BIGINT) END AS star_lo,
      TRY_CAST(regexp_extract(query_string, 'stars:\d+\.\.(\d+)', 1) AS BIGINT) AS star_hi,
      TRY_CAST(regexp_extract(query_string, 'created:([0-9-]*)\.\.', 1) AS DATE) AS created_lo,
      TRY_CAST(regexp_extract(query_string, 'created:[0-9-]*\.\.(\S+)', 1) AS DATE) AS created_hi,
      CASE WHEN query_string LIKE '%size:>%' THEN CAST(regexp_extract(query_string, 'size:>(\d+)', 1) AS BIGINT) + 1
        ELSE TRY_CAST(regexp_extract(query_string, 'size:(\d+)\.\.', 1) AS BIGINT) END AS size_lo,
      CASE WHEN query_string LIKE '%size:<%' THEN CAST(regexp_extract(query_string, 'size:<(\d+)', 1) AS BIGINT) - 1
        ELSE TRY_CAST(regexp_extract(query_string, 'size:\d+\.\.(\d+)', 1) AS BIGINT) END AS size_hi,
      TRY_CAST(regexp_extract(query_string, 'pushed:>(\S+)', 1) AS DATE) + 1 AS pushed_lo, CAST(NULL AS DATE) AS pushed_hi
    FROM matrix
"""


@check(f"WITH {matrix_sql('fine', _CUSTOMER_JOBS)} {_BOUNDS_SQL}")
def matrix_bounds(t: Tables) -> DataFrame:
    return customer_matrix(t, "fine").drop("query_string", "description", "expected_results", "strategy")


@check(f"WITH {matrix_sql('coarse', _CUSTOMER_JOBS)} {_BOUNDS_SQL}")
def matrix_bounds_coarse(t: Tables) -> DataFrame:
    return customer_matrix(t, "coarse").drop("query_string", "description", "expected_results", "strategy")


@check(
    f"""
    WITH {matrix_sql('fine', _CUSTOMER_JOBS)}
    SELECT query_string, count(*) AS jobs, min(job) AS first_job FROM matrix WHERE query_idx = 0 GROUP BY 1
    """
)
def matrix_report(t: Tables) -> DataFrame:
    return measure.matrix_report(customer_matrix(t, "fine"))


@check(
    rf"""
    WITH {matrix_sql('coarse', _CUSTOMER_JOBS)}, terms AS (
      SELECT 'language' AS term, regexp_extract(query_string, '(?:^|\s)language:(\S+)', 1) AS value FROM matrix
      UNION ALL SELECT 'stars', regexp_extract(query_string, '(?:^|\s)stars:(\S+)', 1) FROM matrix
    )
    SELECT term, value, count(*) AS queries FROM terms WHERE value <> '' GROUP BY 1, 2
    """
)
def query_terms(t: Tables) -> DataFrame:
    return measure.query_terms(customer_matrix(t, "coarse"))


# The parts speak the first six languages of the list, so that language partitions have members.
_LANGUAGE_OF = dict(zip(["economy", "promo", "large", "medium", "standard", "small"], v.LANGUAGES))
_COVERED_SQL = f"""
    {s.REPO_SQL},
    coded AS (
      SELECT *, CASE language {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _LANGUAGE_OF.items())} END AS lang FROM repo
    ),
    parts AS (
      SELECT DISTINCT query_string, strategy, nullif(regexp_extract(query_string, 'language:(\\S+)', 1), '') AS lang,
        TRY_CAST(regexp_extract(query_string, 'stars:>?(\\d+)', 1) AS BIGINT)
          + CASE WHEN query_string LIKE '%stars:>%' THEN 1 ELSE 0 END AS star_lo,
        coalesce(TRY_CAST(regexp_extract(query_string, 'stars:\\d+\\.\\.(\\d+)', 1) AS BIGINT), 9000000000) AS star_hi,
        coalesce(TRY_CAST(regexp_extract(query_string, 'created:([0-9-]*)\\.\\.', 1) AS DATE), DATE '0001-01-01') AS created_lo,
        coalesce(TRY_CAST(regexp_extract(query_string, 'created:[0-9-]*\\.\\.(\\S+)', 1) AS DATE), DATE '9999-01-01') AS created_hi
      FROM matrix WHERE query_idx = 0 AND strategy IN ('language', 'created')
    ),
    covered AS (
      SELECT id, query_string FROM coded c JOIN parts p
      ON c.stars BETWEEN star_lo AND star_hi AND (p.lang IS NULL OR p.lang = c.lang)
         AND CAST(c.created_at AS DATE) BETWEEN created_lo AND created_hi
    )"""
_COVER = {"language": "lang", "stars": "stars", "created": "created_at"}


def _coded(t: Tables) -> DataFrame:
    lang = F.lit(None).cast("string")
    for name, language in _LANGUAGE_OF.items():
        lang = F.when(F.col("language") == name, language).otherwise(lang)
    return s.repo(t.part).withColumn("lang", lang)


@check(f"WITH {matrix_sql('fine', _CUSTOMER_JOBS)}, {_COVERED_SQL} SELECT * FROM covered")
def star_band_coverage(t: Tables) -> DataFrame:
    return coverage.coverage(_coded(t), customer_matrix(t, "fine"), _COVER)


@check(
    f"""
    WITH {matrix_sql('fine', _CUSTOMER_JOBS)}, {_COVERED_SQL}
    SELECT query_string, count(id) AS repos
    FROM (SELECT DISTINCT query_string FROM matrix WHERE query_idx = 0) LEFT JOIN covered USING (query_string) GROUP BY 1
    """
)
def coverage_per_query(t: Tables) -> DataFrame:
    return coverage.coverage_counts(_coded(t), customer_matrix(t, "fine"), _COVER)


@check(
    f"""
    WITH {matrix_sql('coarse', _CUSTOMER_JOBS)}, {_COVERED_SQL}
    SELECT id FROM repo WHERE id NOT IN (SELECT id FROM covered)
    """
)
def uncovered_repos(t: Tables) -> DataFrame:
    return coverage.uncovered(_coded(t), customer_matrix(t, "coarse"), _COVER, "coarse")


@check(
    f"""
    WITH {s.REPO_SQL}, counted AS (
      SELECT CASE WHEN stars * 7 BETWEEN 0 AND 2 THEN 1 WHEN stars * 7 BETWEEN 3 AND 8 THEN 2 WHEN stars * 7 BETWEEN 9 AND 25 THEN 3
                  WHEN stars * 7 BETWEEN 26 AND 80 THEN 4 WHEN stars * 7 BETWEEN 81 AND 300 THEN 5 END AS place
      FROM repo
    ),
    listed(place, query_string) AS (
      VALUES (1, 'is:public stars:0..2 sort:updated'), (2, 'is:public stars:3..8 sort:stars'), (3, 'is:public stars:9..25 sort:updated'),
             (4, 'is:public stars:26..80 sort:stars'), (5, 'is:public stars:81..300 sort:updated')
    )
    SELECT query_string, count(counted.*) AS repos FROM listed FULL JOIN (SELECT place, 1 AS one FROM counted) counted USING (place)
    GROUP BY query_string
    """
)
def single_job_coverage(t: Tables) -> DataFrame:
    """Parts by the queries of the one-job list, which reach up to 300 stars."""
    return coverage.single_job_counts(s.repo(t.part).withColumn("stars", F.col("stars") * 7))


_SORTED_COVER = {
    "language": "lang", "stars": "stars", "size": "size_kb", "license": "license", "topic": "topic", "fork": "fork", "archived": "archived",
}


def _sorted_sql(strategies: str) -> str:
    """Rows under the queries of some strategies, with the flags that these exclude."""
    return f"""
    WITH {matrix_sql('fine', _CUSTOMER_JOBS)}, {_COVERED_SQL},
    stated AS ({_BOUNDS_SQL.replace('SELECT job,', 'SELECT strategy, query_string, job,', 1)}),
    wanted AS (
      SELECT DISTINCT query_string, language, topic, license, coalesce(star_lo, 0) AS s0, coalesce(star_hi, 9000000000) AS s1,
        coalesce(size_lo, 0) AS k0, coalesce(size_hi, 9000000000) AS k1
      FROM stated WHERE query_idx = 0 AND strategy IN ({strategies})
    ),
    kinds AS (
      SELECT id, stars, lang, id * 13 % 6000 AS size_kb, {_list_sql(v.LICENSES)}[id % {len(v.LICENSES)} + 1] AS license,
        {_list_sql(v.TOPICS)}[id % {len(v.TOPICS)} + 1] AS topic, id % 5 = 0 AS fork, id % 7 = 0 AS archived FROM coded
    )
    SELECT id, query_string FROM kinds k JOIN wanted w
    ON stars BETWEEN s0 AND s1 AND size_kb BETWEEN k0 AND k1 AND (w.language IS NULL OR w.language = lang)
       AND (w.topic IS NULL OR w.topic = k.topic) AND (w.license IS NULL OR w.license = k.license)
       AND NOT (fork AND query_string LIKE '%fork:false%') AND NOT (archived AND query_string LIKE '%archived:false%')
    """


def _kinds(t: Tables) -> DataFrame:
    id = F.col("id")

    def entry(values: list[str]):
        return F.element_at(F.array(*map(F.lit, values)), (id % len(values) + 1).cast("int"))

    return _coded(t).withColumns(
        {
            "size_kb": id * 13 % 6000,
            "license": entry(v.LICENSES),
            "topic": entry(v.TOPICS),
            "fork": id % 5 == 0,
            "archived": id % 7 == 0,
        }
    )


@check(_sorted_sql("'topic', 'language'"))
def coverage_by_topic(t: Tables) -> DataFrame:
    cover = {name: column for name, column in _SORTED_COVER.items() if name not in ("size", "license")}
    return coverage.coverage(_kinds(t), customer_matrix(t, "fine"), cover)


@check(_sorted_sql("'topic', 'language', 'size', 'license'"))
def coverage_by_license_and_size(t: Tables) -> DataFrame:
    return coverage.coverage(_kinds(t), customer_matrix(t, "fine"), _SORTED_COVER)


# Outputs: written under the shared folder and read back


@check(KEEP_FIRST_SQL)
def stored_repo(t: Tables) -> DataFrame:
    """The customer table published, then the order batch stored on top."""
    root = new_path(t.spark, "repo")
    start = s.customer_repo(t.customer)
    publish_repo(start, root)
    store_repo(s.order_batch(t.orders), root)
    return read_repo(t.spark, root)


@check(
    f"""
    WITH {s.CUSTOMER_REPO_SQL}, c(name, comment) AS (VALUES
      ('id', 'primary key, the service''s numeric id'), ('name', 'short name'), ('owner', 'login of the owner'),
      ('url', 'address of the record'), ('created_at', 'creation time without zone'),
      ('alphabet_partition', 'label of the partition that found the row, such as matrix_0'), ('name_with_owner', 'owner/name'))
    SELECT c.name, c.comment, CASE c.name WHEN 'created_at' THEN count(created_at) WHEN 'name_with_owner' THEN count(name_with_owner)
           ELSE count(*) END AS filled
    FROM target CROSS JOIN c GROUP BY c.name, c.comment
    """
)
def stored_comments(t: Tables) -> DataFrame:
    """The column comments that the files of a stored table hold, and how many rows fill each column."""
    root = new_path(t.spark, "repo")
    table = t.spark.read.parquet(version_path(root, publish_repo(s.customer_repo(t.customer), root)))
    columns = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.metadata.get("comment")).alias("comment"), F.col(f"n_{f.name}").alias("filled"))
        for f in table.schema.fields
    ]
    counts = table.agg(*(F.count(f.name).alias(f"n_{f.name}") for f in table.schema.fields))
    return counts.select(F.explode(F.array(*columns)).alias("c")).select("c.*")


@check(
    f"""
    WITH {s.CUSTOMER_REPO_SQL}, {s.STATS_SQL}
    SELECT 'repo' AS kept, id, count(*) AS rows FROM target WHERE id NOT IN (SELECT s_suppkey * 20 FROM supplier) GROUP BY id
    UNION ALL
    SELECT 'stats', repo_id, count(*) FROM stats WHERE repo_id NOT IN (SELECT s_suppkey * 20 FROM supplier) GROUP BY repo_id
    """
)
def stored_delete(t: Tables) -> DataFrame:
    """Rows per id that both stored tables keep after ids are deleted."""
    repo, stats = new_path(t.spark, "repo"), new_path(t.spark, "stats")
    publish_repo(s.customer_repo(t.customer), repo)
    store_stats(s.stats_rows(t.events), stats)
    delete_stored(t.supplier.select((F.col("s_suppkey") * 20).alias("id")), repo, stats)
    left = read_repo(t.spark, repo).select(F.lit("repo").alias("kept"), "id")
    left = left.unionByName(read_stats(t.spark, stats).select(F.lit("stats").alias("kept"), F.col("repo_id").alias("id")))
    return left.groupBy("kept", "id").agg(F.count(F.lit(1)).alias("rows"))


@check(_STATS_UPSERT_SQL)
def stored_stats(t: Tables) -> DataFrame:
    root = new_path(t.spark, "stats")
    store_stats(s.stats_rows(t.events), root)
    store_stats(_later_batch(t), root)
    return read_stats(t.spark, root)


@check(
    f"""
    SELECT id, name, name_with_owner, url, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, stars, crawled_at
    FROM ({_EXPORT_SQL})
    """
)
def csv_export(t: Tables) -> DataFrame:
    path = new_path(t.spark, "export")
    export_csv(export_view(t), path)
    return t.spark.read.schema(_EXPORT_SCHEMA).option("header", True).csv(path)


@check(f"WITH {s.CUSTOMER_REPO_SQL} SELECT alphabet_partition, count(*) AS rows FROM target GROUP BY 1")
def job_outputs(t: Tables) -> DataFrame:
    path = new_path(t.spark, "jobs")
    write_jobs(s.customer_repo(t.customer), path)
    return t.spark.read.parquet(path).groupBy("alphabet_partition").agg(F.count(F.lit(1)).alias("rows"))


def _new_roots(t: Tables) -> Roots:
    root = new_path(t.spark, "tables")
    return Roots(f"{root}/repo", f"{root}/stats", f"{root}/bad")


_LOADED_SQL = f"""
    WITH {s.DEFECTS_SQL}, job_rows AS (
      SELECT *, CASE WHEN reason IS NULL OR reason = 'partition_too_long' THEN
               CASE WHEN stars > 2147483647 THEN 'stars_out_of_range' END ELSE reason END AS failed FROM marked
    )
    SELECT coalesce(failed, 'stored') AS outcome, id FROM job_rows
    """


@check(_LOADED_SQL)
def loaded_records(t: Tables) -> DataFrame:
    """Records of many jobs loaded into empty tables: what the tables hold and what was rejected."""
    roots = _new_roots(t)
    load_records(_job_records(t, 200), roots, DAY, label="check")
    return _load_outcomes(t, roots)


def _job_records(t: Tables, jobs: int) -> DataFrame:
    return s.defects(t.part).drop("alphabet_partition").withColumns(
        {
            "job": (F.col("id") * 37 % jobs).cast("int"),
            "query_idx": F.lit(0),
            "page_idx": F.lit(0),
            "pos": F.lit(0),
            "created_at": F.lit(None).cast("timestamp_ntz"),
        }
    )


def _load_outcomes(t: Tables, roots: Roots) -> DataFrame:
    stored = read_stats(t.spark, roots.stats).join(
        read_repo(t.spark, roots.repo).select(F.col("id").alias("repo_id")), "repo_id", "left_semi"
    )
    bad = t.spark.read.parquet(roots.bad)
    return stored.select(F.lit("stored").alias("outcome"), F.col("repo_id").alias("id")).unionByName(
        bad.select(F.col("reason").alias("outcome"), "id")
    )


@check(_LOADED_SQL)
def readmitted(t: Tables) -> DataFrame:
    """Two loads while labels had 10 characters at most; what they reject is taken again under the present width, twice."""
    roots, rows = _new_roots(t), _job_records(t, 5000)
    for odd in (0, 1):
        load_records(rows.filter(F.col("id") % 2 == odd), roots, DAY, label=f"check {odd}", width=10)
    for _ in range(2):
        readmit(t.spark, roots, DAY)
    return _load_outcomes(t, roots)


@check(
    f"""
    WITH replayed AS ({replay_sql(s.CLEAN_SQL)}),
    first AS (SELECT * FROM replayed QUALIFY row_number() OVER (PARTITION BY id ORDER BY job) = 1),
    last AS (SELECT * FROM replayed QUALIFY row_number() OVER (PARTITION BY id ORDER BY job DESC) = 1)
    SELECT f.id, f.name, f.owner || '/' || f.name AS name_with_owner, f.url,
           strftime(f.created_at, '%Y-%m-%d %H:%M:%S') AS created_at, CAST(l.stars AS INTEGER) AS stars, DATE '{s.FETCHED}' AS crawled_at
    FROM first f JOIN last l USING (id)
    """
)
def whole_run(t: Tables) -> DataFrame:
    """Landed pages replayed, stored and exported."""
    roots, path = _new_roots(t), new_path(t.spark, "export")
    harvest_pages(s.pages(t.events), roots, DAY, TARGET, label="check")
    export_latest(t.spark, roots, path)
    return t.spark.read.schema(_EXPORT_SCHEMA).option("header", True).csv(path)


@check(
    f"""
    WITH replayed AS (SELECT * EXCLUDE (job), {RUNS_SQL} FROM ({replay_sql(s.CLEAN_SQL)}))
    SELECT id AS repo_id, fetched_date, CAST(stars AS INTEGER) AS stars FROM replayed
    QUALIFY row_number() OVER (PARTITION BY id, fetched_date ORDER BY job DESC, query_idx DESC, page_idx DESC, pos DESC) = 1
    """
)
def two_runs_stored(t: Tables) -> DataFrame:
    """The runs of two days stored in one load."""
    roots = _new_roots(t)
    harvest_pages(two_runs(t), roots, DAY, TARGET, label="check")
    return read_stats(t.spark, roots.stats)


@check(
    f"""
    WITH {s.PAGES_SQL}, hits AS (SELECT * FROM nodes WHERE status IN ('ok', 'ok_with_errors') AND id > 0),
    first AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY job, query_idx, page_idx, pos) = 1),
    last AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY job DESC, query_idx DESC, page_idx DESC, pos DESC) = 1)
    SELECT f.id, f.owner, 'matrix_' || l.job AS alphabet_partition, f.owner || '/n' || f.id AS name_with_owner,
           CAST(l.stars AS INTEGER) AS stars
    FROM first f JOIN last l USING (id)
    """
)
def stream_ingest(t: Tables) -> DataFrame:
    """Landed page files taken by the stream into empty tables, stored once when all are taken."""
    checkpoint, roots = new_path(t.spark, "stream"), _new_roots(t)
    for landing in _landings(t):
        ingest = ingest_stream(t.spark, landing, roots, checkpoint, DAY, max_files=2)
        ingest.query.awaitTermination()
    ingest.awaitTermination()
    stats = read_stats(t.spark, roots.stats).select(F.col("repo_id").alias("id"), "stars")
    return read_repo(t.spark, roots.repo).join(stats, "id").select("id", "owner", "alphabet_partition", "name_with_owner", "stars")


def _landing(t: Tables) -> str:
    """A folder of landed page files: at least 12 if there are as many partitions, and more only as the pages grow."""
    landing = new_path(t.spark, "landing")
    _land(t.events, landing, _landed_files(t))
    return landing


def _landings(t: Tables) -> Iterator[str]:
    """The same files, a part of them at a time in one folder, so that the landed text takes no more disk as the pages grow.

    A part goes when the next one is asked for.
    """
    landing, files = new_path(t.spark, "landing"), _landed_files(t)
    parts = -(-files // FILES_AT_A_TIME)
    for events in _dealt(t, parts):
        _land(events, landing, -(-files // parts))
        yield landing
        drop_folder(t.spark, landing)


def _dealt(t: Tables, parts: int) -> Iterator[DataFrame]:
    """The events in parts of equal size, from a copy that is read part by part."""
    if parts == 1:
        yield t.events
        return
    path = new_path(t.spark, "events")
    t.events.withColumn("part", F.monotonically_increasing_id() % parts).write.partitionBy("part").parquet(path)
    for part in range(parts):
        yield t.spark.read.parquet(path).filter(F.col("part") == part).drop("part")
    drop_folder(t.spark, path)


def _landed_files(t: Tables) -> int:
    return max(12, t.events.count() // EVENTS_IN_FILE)


def _land(events: DataFrame, landing: str, files: int) -> None:
    landed = s.page_texts(events).select(
        F.to_json(F.struct("http_status", "job", "query_idx", "page_idx", "attempt")).alias("head"), "http_status", "response"
    )
    # A landed line is the head with the response as `body`, or as `text` where it is not a response document.
    tail = F.when(F.col("response").startswith("{"), F.concat(F.lit(',"body":'), "response", F.lit("}"))).otherwise(
        F.concat(F.lit(',"text":'), F.to_json(F.struct("response")).substr(F.lit(13), F.lit(1 << 30)))
    )
    lines = landed.select(F.concat(F.expr("substr(head, 1, length(head) - 1)"), tail)).coalesce(files)
    with shuffles_dropped(events.sparkSession):
        lines.write.text(landing)


@check(f"WITH {s.PAGES_SQL} SELECT DISTINCT job, id FROM nodes WHERE status IN ('ok', 'ok_with_errors') AND id > 0")
def stream_dedup(t: Tables) -> DataFrame:
    """Ids of every job as the page files arrive, each told once; a second start of the stream adds nothing."""
    landing, out, checkpoint = _landing(t), new_path(t.spark, "sightings"), new_path(t.spark, "stream")
    for _ in range(2):
        stream_sightings(t.spark, landing, out, checkpoint, max_files=3).awaitTermination()
    return t.spark.read.parquet(out).select("job", "id")
