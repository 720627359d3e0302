"""Tables in buckets, stored lookups, free matrices, special queries, runs that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import standins as s
from checks.catalog import Tables, check
from checks.page_checks import TARGET, replay_sql
from checks.table_checks import KEEP_FIRST_SQL, OVERWRITE_SQL, customer_matrix, matrix_sql
from harvest.operators import bands, overlaps
from harvest.plans.continued import collected, replay_more
from harvest.sources import buckets, matrix_values as v
from harvest.sources.scratch import new_path


def _stored(t: Tables) -> str:
    root = new_path(t.spark, "buckets")
    buckets.publish_buckets(s.customer_repo(t.customer), root)
    return root


@check(KEEP_FIRST_SQL)
def stored_repo_touched(t: Tables) -> DataFrame:
    """The customer table in buckets, then the order batch upserted into the buckets it touches."""
    root = _stored(t)
    buckets.store_buckets(s.order_batch(t.orders), root)
    return buckets.read_bucketed_repo(t.spark, root)


@check(OVERWRITE_SQL)
def stored_repo_overwritten(t: Tables) -> DataFrame:
    root = _stored(t)
    buckets.store_buckets(s.order_batch(t.orders), root, "overwrite")
    return buckets.read_bucketed_repo(t.spark, root)


@check(f"WITH {s.CUSTOMER_REPO_SQL} SELECT id, name, owner FROM target WHERE id NOT IN (SELECT s_suppkey * 20 FROM supplier)")
def stored_repo_deleted(t: Tables) -> DataFrame:
    root = _stored(t)
    buckets.delete_buckets(t.supplier.select((F.col("s_suppkey") * 20).alias("id")), root)
    return buckets.read_bucketed_repo(t.spark, root).select("id", "name", "owner")


@check(f"WITH {s.CUSTOMER_REPO_SQL} SELECT id, name, owner, name_with_owner FROM target WHERE id IN (3, 7, 11, 1000000007)")
def lookup_stored_id(t: Tables) -> DataFrame:
    """Rows of a few ids: their buckets alone are read."""
    return buckets.by_ids(t.spark, _stored(t), [3, 7, 11, 1000000007]).select("id", "name", "owner", "name_with_owner")


@check(f"WITH {s.CUSTOMER_REPO_SQL} SELECT id, name_with_owner FROM target WHERE name_with_owner IN ('MACHINERY/Customer#000000001', 'BUILDING/Customer#000000002', 'x/y')")
def lookup_stored_name(t: Tables) -> DataFrame:
    names = ["MACHINERY/Customer#000000001", "BUILDING/Customer#000000002", "x/y"]
    return buckets.by_name(t.spark, _stored(t), names).select("id", "name_with_owner")


# Every customer asks for a range of its own; the ranges overlap. Some name a language, some a day from which on.
_FREE_SQL = """
    free AS (
      SELECT c_custkey AS job, 'free ' || c_custkey AS query_string,
        CASE WHEN c_custkey % 3 > 0 THEN (['economy', 'promo', 'large', 'medium'])[c_custkey % 4 + 1] END AS language,
        CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 45 END AS star_lo, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 45 + c_nationkey % 9 END AS star_hi,
        CASE WHEN c_custkey % 4 = 0 THEN DATE '2016-06-01' + CAST(c_custkey % 900 AS INTEGER) END AS created_lo,
        CASE WHEN c_custkey % 6 = 0 THEN DATE '2018-06-01' + CAST(c_custkey % 900 AS INTEGER) END AS created_hi
      FROM customer WHERE c_custkey % 10 = 1
    )"""


def _free_matrix(t: Tables) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    language = F.element_at(F.array(*map(F.lit, ["economy", "promo", "large", "medium"])), (key % 4 + 1).cast("int"))
    day = lambda first: F.date_add(F.lit(first).cast("date"), (key % 900).cast("int"))
    return t.customer.filter(key % 10 == 1).select(
        key.alias("job"),
        F.concat(F.lit("free "), key.cast("string")).alias("query_string"),
        F.when(key % 3 > 0, language).alias("language"),
        F.when(key % 7 > 0, key % 45).alias("star_lo"),
        F.when(key % 5 > 0, key % 45 + nation % 9).alias("star_hi"),
        F.when(key % 4 == 0, day("2016-06-01")).alias("created_lo"),
        F.when(key % 6 == 0, day("2018-06-01")).alias("created_hi"),
    )


@check(
    f"""
    WITH {s.REPO_SQL}, {_FREE_SQL}
    SELECT query_string, count(*) AS repos, CAST(sum(id) AS BIGINT) AS ids FROM repo r JOIN free f
    ON r.stars BETWEEN coalesce(star_lo, 0) AND coalesce(star_hi, 1000000) AND (f.language IS NULL OR f.language = r.language)
       AND (created_lo IS NULL OR CAST(created_at AS DATE) >= created_lo) AND (created_hi IS NULL OR CAST(created_at AS DATE) <= created_hi)
    GROUP BY 1
    """
)
def coverage_free_bands(t: Tables) -> DataFrame:
    """Parts within the overlapping bounds of a matrix that is no list of ours."""
    return bands.free_coverage_totals(s.repo(t.part), _free_matrix(t), {"stars": "stars", "language": "language", "created": "created_at"})


_SPECIAL_COLUMNS = {
    "stars": "stars", "fork": "fork", "archived": "archived", "has": "parts", "pushed": "pushed_at", "good-first-issues": "good", "help-wanted-issues": "help",
    "size": "size_kb", "template": "template", "mirror": "mirror",
}
_WANTED = {
    "has:readme": "id % 3 > 0", "has:issues": "id % 4 > 0", "has:wiki": "id % 6 > 1", "fork:false": "id % 5 > 0", "archived:false": "id % 7 > 0",
    "pushed:>2024-06-01": "id % 200 > 31", "good-first-issues:>0": "id % 9 > 0", "help-wanted-issues:>0": "id % 11 > 0", "size:<100": "id * 13 % 6000 < 100",
    "size:100..1000": "id * 13 % 6000 BETWEEN 100 AND 1000", "template:true": "id % 8 = 0", "mirror:false": "id % 10 > 0",
}


def _special_sql() -> str:
    """One condition for each special query of the list, spelled from its terms."""
    parts = []
    for text, _ in v.SPECIALS:
        low, high = next(x for x in text.split() if x.startswith("stars:")).removeprefix("stars:").split("..")
        terms = [f"stars BETWEEN {low} AND {high}", *(f"({_WANTED[x]})" for x in text.split() if x in _WANTED)]
        parts.append(f"SELECT id, '{text}' AS query_string FROM repo WHERE {' AND '.join(terms)}")
    return " UNION ALL ".join(parts)


@check(
    f"""
    WITH {matrix_sql('fine', 'SELECT c_custkey AS job FROM customer')}, {s.REPO_SQL}, held AS ({_special_sql()})
    SELECT id, query_string FROM held WHERE query_string IN (SELECT query_string FROM matrix WHERE strategy = 'special')
    """
)
def coverage_special(t: Tables) -> DataFrame:
    """Parts by the special queries of the matrix, all in one scan."""
    id = F.col("id")
    has = F.array_compact(F.array(F.when(id % 3 > 0, "readme"), F.when(id % 4 > 0, "issues"), F.when(id % 6 > 1, "wiki")))
    repos = s.repo(t.part).withColumns(
        {
            "fork": id % 5 == 0, "archived": id % 7 == 0, "parts": has, "pushed_at": F.date_add(F.lit("2024-05-01").cast("date"), (id % 200).cast("int")),
            "good": id % 9, "help": id % 11, "size_kb": id * 13 % 6000, "template": id % 8 == 0, "mirror": id % 10 == 0,
        }
    )
    return bands.special_coverage(repos, customer_matrix(t, "fine"), _SPECIAL_COLUMNS)


@check(replay_sql(s.CLEAN_SQL))
def replay_continued(t: Tables) -> DataFrame:
    """The landed pages in two loads, the second taking up the chains, ids and targets of the first, twice."""
    pages, root = s.pages(t.events), new_path(t.spark, "continued")
    early = (F.col("query_idx") == 0) | ((F.col("query_idx") == 1) & (F.col("page_idx") < 4))
    first = replay_more(pages.filter(early), root, TARGET)
    for _ in range(2):
        replay_more(pages.filter(~early), root, TARGET)
    return collected(t.spark, root, first.schema).select("job", "query_idx", "page_idx", "pos", "id", "name", "owner", "url", "stars", "created_at")


def _two_loads(t: Tables) -> DataFrame:
    """The bitmaps of seven jobs, stored by two loads that both bring jobs 3 and 4; the first is loaded twice."""
    rows, root = t.lineitem.select(F.col("l_linenumber").alias("job"), F.col("l_orderkey").alias("id")), new_path(t.spark, "words")
    for label, jobs in (("a", F.col("job") <= 4), ("b", F.col("job") >= 3), ("a", F.col("job") <= 4)):
        overlaps.store_words(rows.filter(jobs), root, label)
    return overlaps.read_words(t.spark, root)


@check(
    """
    WITH r AS (SELECT DISTINCT l_linenumber AS job, l_orderkey AS id FROM lineitem), n AS (SELECT job, count(*) AS ids FROM r GROUP BY 1)
    SELECT CAST(a.job AS BIGINT) AS job, CAST(b.job AS BIGINT) AS other, count(*) AS shared, any_value(x.ids) AS job_ids, any_value(y.ids) AS other_ids
    FROM r a JOIN r b ON a.id = b.id AND a.job < b.job JOIN n x ON x.job = a.job JOIN n y ON y.job = b.job GROUP BY 1, 2
    """
)
def job_overlap_matrix(t: Tables) -> DataFrame:
    """Ids that every two jobs share."""
    return overlaps.job_overlaps(_two_loads(t))


@check(
    """
    WITH r AS (SELECT DISTINCT l_linenumber AS job, l_orderkey AS id FROM lineitem)
    SELECT count(*) AS total_rows, count(DISTINCT id) AS unique_rows, count(*) - count(DISTINCT id) AS duplicates_skipped,
           round(1 - CAST(count(DISTINCT id) AS DOUBLE) / count(*), 6) AS overlap_rate FROM r
    """
)
def dedup_report_kept(t: Tables) -> DataFrame:
    """Totals of all jobs from the kept bitmaps."""
    return overlaps.sightings_report(_two_loads(t)).withColumn("overlap_rate", F.round("overlap_rate", 6))
