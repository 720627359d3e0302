"""Parsing, projections, validity rules, qualifiers, lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from checks import standins as s
from checks.catalog import Tables, check
from harvest.functions.names import with_fetched, with_name, with_partition
from harvest.functions.qualifiers import qualify
from harvest.functions.timestamps import parse_ts
from harvest.operators import measure, ranking, records
from harvest.schemas import REPO, conform
from harvest.sources.pages import explode_nodes, parse_pages


def _part_pages(t: Tables) -> DataFrame:
    """A page per part: the part as a full node, and a twin with the required keys only."""
    full = F.struct(
        F.col("p_partkey").alias("databaseId"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("login")).alias("owner"),
        F.concat(F.lit("https://example.com/"), "p_name").alias("url"),
        F.format_string("2023-%02d-01T0%d:30:00+05:30", F.col("p_size") % 12 + 1, F.col("p_size") % 10).alias("createdAt"),
        F.col("p_size").alias("stargazerCount"),
        (F.col("p_size") * 2).alias("forkCount"),
        F.struct(F.col("p_type").alias("name")).alias("primaryLanguage"),
    )
    twin = F.struct(
        (F.col("p_partkey") + 1000000000).alias("databaseId"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("login")).alias("owner"),
        F.lit("https://example.com/twin").alias("url"),
        F.lit(5).alias("stargazerCount"),
    )
    response = F.concat(F.lit('{"data":{"search":{"nodes":['), F.to_json(full), F.lit(","), F.to_json(twin), F.lit("]}}}"))
    return parse_pages(t.part.select(F.col("p_partkey").alias("page"), response.alias("response")), "response")


@check(
    """
    SELECT p_partkey AS page, 0 AS pos, p_partkey AS id, p_name AS name, p_brand AS owner, 'https://example.com/' || p_name AS url,
           CAST(p_size AS BIGINT) AS stars, make_timestamp(2023, p_size % 12 + 1, 1, p_size % 10, 30, 0) AS created_at,
           p_type AS primary_language, CAST(p_size * 2 AS BIGINT) AS fork_count
    FROM part
    UNION ALL
    SELECT p_partkey, 1, p_partkey + 1000000000, p_name, p_brand, 'https://example.com/twin', 5, NULL, NULL, NULL FROM part
    """
)
def parse_nodes(t: Tables) -> DataFrame:
    rows = records.to_repo(explode_nodes(_part_pages(t)))
    return rows.drop("pushed_at", "updated_at", "license_name")


@check("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def parse_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


_REASON_SQL = """
    WITH raw AS (
      SELECT p_partkey AS page, p_size % 16 AS defect, p_size AS stars FROM part
    )
    SELECT page, CASE defect
      WHEN 1 THEN 'not_an_object' WHEN 2 THEN 'created_at_invalid' WHEN 3 THEN 'id_missing' WHEN 4 THEN 'name_missing'
      WHEN 5 THEN 'owner_missing' WHEN 6 THEN 'url_missing' WHEN 7 THEN 'stars_missing' WHEN 8 THEN 'id_wrong_type'
      WHEN 9 THEN 'id_not_positive' WHEN 10 THEN 'name_or_owner_empty' WHEN 11 THEN 'stars_wrong_type'
      WHEN 12 THEN 'stars_negative' WHEN 13 THEN 'name_or_owner_empty' END AS reason
    FROM raw
"""


@check(_REASON_SQL)
def node_reasons(t: Tables) -> DataFrame:
    """One node per part, as JSON text that breaks the structure in one of 13 ways, is complete, or has a null url."""
    defect = F.col("p_size") % 16

    def key(number: int, good: str, bad: str = "") -> F.Column:
        return F.when(defect == number, F.lit(bad)).otherwise(F.lit(good))

    text = F.concat(
        F.lit("{"),
        F.when(defect == 2, '"createdAt":"junk",').when(defect == 14, '"createdAt":"",').otherwise('"createdAt":"2023-01-01T00:00:00Z",'),
        F.when(defect == 3, "").when(defect == 8, '"databaseId":"7",').when(defect == 9, '"databaseId":0,').otherwise('"databaseId":7,'),
        F.when(defect == 4, "").when(defect == 10, '"name":"",').otherwise('"name":" ",'),
        F.when(defect == 5, '"owner":null,').when(defect == 13, '"owner":{"login":""},').otherwise('"owner":{"login":"o"},'),
        F.when(defect == 6, "").when(defect == 15, '"url":null,').otherwise('"url":"u",'),
        F.when(defect == 7, "").when(defect == 11, '"stargazerCount":"many",').when(defect == 12, '"stargazerCount":-1,')
        .otherwise(F.concat(F.lit('"stargazerCount":'), F.col("p_size").cast("string"), F.lit(","))),
        F.lit('"x":1}'),
    )
    node = F.when(defect == 1, F.lit("null")).otherwise(text)
    response = F.concat(F.lit('{"data":{"search":{"nodes":['), node, F.lit("]}}}"))
    pages = parse_pages(t.part.select(F.col("p_partkey").alias("page"), response.alias("response")), "response")
    return records.marked(explode_nodes(pages), records.node_reason()).select("page", "reason")


@check(
    """
    WITH t AS (
      SELECT o_orderkey, o_orderkey % 11 = 0 AS junk, o_orderkey % 5 AS zone,
             CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 30 MINUTE AS reading
      FROM orders
    )
    SELECT o_orderkey, CASE WHEN NOT junk THEN reading END AS wall,
           CASE WHEN NOT junk THEN CASE zone WHEN 1 THEN reading - INTERVAL 330 MINUTE WHEN 2 THEN reading + INTERVAL 480 MINUTE
             ELSE reading END END AS utc
    FROM t
    """
)
def timestamp_modes(t: Tables) -> DataFrame:
    zone = F.col("o_orderkey") % 5
    suffix = F.when(zone == 0, "Z").when(zone == 1, "+05:30").when(zone == 2, "-0800").when(zone == 3, "+00:00").otherwise("")
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:30:00"), suffix)
    text = F.when(F.col("o_orderkey") % 11 == 0, F.date_format("o_orderdate", "yyyy-MM")).otherwise(iso)
    return t.orders.select("o_orderkey", parse_ts(text, "wall").alias("wall"), parse_ts(text, "utc").alias("utc"))


@check(
    f"WITH {s.REPO_SQL} SELECT id, owner || '/' || name AS name_with_owner, 'matrix_' || (id % 200) AS alphabet_partition FROM repo"
)
def name_with_owner(t: Tables) -> DataFrame:
    rows = with_name(with_partition(s.repo(t.part), F.col("id") % 200))
    return rows.select("id", "name_with_owner", "alphabet_partition")


@check(f"WITH {s.REPO_SQL} SELECT id AS repo_id, DATE '{s.FETCHED}' AS fetched_date, CAST(stars AS INTEGER) AS stars FROM repo")
def stats_projection(t: Tables) -> DataFrame:
    return records.to_stats(s.repo(t.part), dt.date.fromisoformat(s.FETCHED))


@check("SELECT user_id AS repo_id, CAST(ts AS DATE) AS fetched_date, CAST(floor(value) AS INTEGER) AS stars FROM events")
def stats_records(t: Tables) -> DataFrame:
    spelled = t.events.select(F.col("user_id").alias("repoId"), F.col("ts").alias("fetched_date"), F.floor("value").alias("stars"))
    return records.stats_from_records(spelled)


@check(f"WITH {s.DEFECTS_SQL} SELECT id, name, owner, url, stars, alphabet_partition FROM marked WHERE reason IS NULL")
def valid_repo(t: Tables) -> DataFrame:
    return records.check_table(records.check_repo(s.defects(t.part)).ok).ok


@check(f"WITH {s.DEFECTS_SQL} SELECT id, reason FROM marked WHERE reason IS NOT NULL")
def rejected_repo(t: Tables) -> DataFrame:
    rows = s.defects(t.part)
    reason = F.coalesce(records.repo_reason(), records.table_reason(rows))
    return records.split(rows, reason).bad.select("id", "reason")


@check(f"WITH {s.DEFECTS_SQL} SELECT id FROM defects WHERE length(alphabet_partition) > 10 AND id IS NOT NULL AND owner IS NOT NULL AND url IS NOT NULL")
def narrow_partition(t: Tables) -> DataFrame:
    """Rows that the first width of the partition column had no room for."""
    rows = records.check_table(s.defects(t.part).drop("stars"), width=10).bad
    return rows.filter(F.col("reason") == "partition_too_long").select("id")


@check(f"WITH {s.DEFECTS_SQL} SELECT coalesce(reason, 'stored') AS outcome, count(*) AS rows FROM marked GROUP BY 1")
def load_report(t: Tables) -> DataFrame:
    rows = s.defects(t.part)
    return measure.load_report(records.marked(rows, F.coalesce(records.repo_reason(), records.table_reason(rows))))


@check(
    """
    SELECT user_id - 3 AS repo_id, CAST(floor(value) AS INTEGER) - 20 AS stars,
           CASE WHEN user_id - 3 <= 0 THEN 'repo_id_not_positive' WHEN floor(value) < 20 THEN 'stars_negative' END AS reason
    FROM events
    """
)
def stats_validity(t: Tables) -> DataFrame:
    rows = t.events.select((F.col("user_id") - 3).alias("repo_id"), (F.floor("value").cast("int") - 20).alias("stars"))
    return records.marked(rows, records.stats_reason())


@check("SELECT p_partkey, p_size % 4 IN (2, 3) AS valid FROM part")
def query_validity(t: Tables) -> DataFrame:
    kind = F.col("p_size") % 4
    text = F.when(kind == 0, "").when(kind == 1, " \t\n ").when(kind == 2, F.col("p_name")).otherwise(F.lit("\n stars:>100"))
    both = records.check_query(t.part.select("p_partkey", text.alias("query_string")))
    good = both.ok.select("p_partkey", F.lit(True).alias("valid"))
    return good.unionByName(both.bad.select("p_partkey", F.lit(False).alias("valid")))


@check(f"WITH {s.REPO_SQL} SELECT id, stars FROM repo WHERE stars BETWEEN 10 AND 30 AND language = 'promo' AND owner = 'Brand#7'")
def qualify_stars_lang(t: Tables) -> DataFrame:
    columns = {"stars": "stars", "language": "language", "is": "owner"}
    spec = {"is": "Brand#7", "language": "promo", "stars": (10, 30)}
    return ranking.ranked(qualify(s.repo(t.part), spec, columns).select("id", "stars"))


@check("SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1997-12-31' AND o_totalprice > 100000 AND o_orderstatus = 'F'")
def qualify_created(t: Tables) -> DataFrame:
    columns = {"created": "o_orderdate", "size": "o_totalprice", "license": "o_orderstatus"}
    spec = {"created": (None, dt.datetime(1997, 12, 31)), "size": {">": 100000}, "license": "F"}
    return ranking.ranked(qualify(t.orders, spec, columns), "o_orderdate", "o_orderkey").select("o_orderkey")


@check("SELECT vec_id FROM embeddings WHERE label % 3 = 1 AND label >= 4 AND label < 9")
def qualify_members(t: Tables) -> DataFrame:
    """Topics and `has` as array members, flags as equality."""
    label = F.col("label")
    rows = t.embeddings.select(
        "vec_id",
        label,
        F.array(F.concat(F.lit("topic-"), (label % 3).cast("string")), F.lit("all")).alias("topics"),
        F.when(label >= 4, F.array(F.lit("readme"), F.lit("wiki"))).otherwise(F.array(F.lit("wiki"))).alias("parts"),
        F.lit(False).alias("is_fork"),
    )
    columns = {"topic": "topics", "has": "parts", "fork": "is_fork", "good-first-issues": "label"}
    spec = {"topic": "topic-1", "has": ["readme", "wiki"], "fork": False, "good-first-issues": {"<": 9}}
    return qualify(rows, spec, columns).select("vec_id")


@check("SELECT event_id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def qualify_created_on_timestamps(t: Tables) -> DataFrame:
    """Days as bounds of a column of times: the whole last day counts."""
    days = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    return qualify(t.events, {"created": days}, {"created": "ts"}).select("event_id")


@check(
    f"""
    WITH {s.STATS_SQL}
    SELECT repo_id, fetched_date, stars FROM stats_rows
    WHERE fetched_date = DATE '2024-01-05' AND stars BETWEEN 10 AND 100
    """
)
def lookup_by_date_and_stars(t: Tables) -> DataFrame:
    rows = s.stats_rows(t.events).filter((F.col("fetched_date") == F.lit("2024-01-05").cast("date")) & F.col("stars").between(10, 100))
    return rows.drop("seq")


@check(
    f"""
    WITH {s.CUSTOMER_REPO_SQL}
    SELECT id FROM target WHERE alphabet_partition = 'matrix_7' AND owner = 'HOUSEHOLD'
    UNION ALL SELECT id FROM target WHERE name_with_owner = 'MACHINERY/Customer#000000001'
    UNION ALL SELECT id FROM target WHERE id = 3
    """
)
def lookup_by_label_and_name(t: Tables) -> DataFrame:
    rows = s.customer_repo(t.customer)
    by_label = rows.filter((F.col("alphabet_partition") == "matrix_7") & (F.col("owner") == "HOUSEHOLD"))
    by_name = rows.filter(F.col("name_with_owner") == "MACHINERY/Customer#000000001")
    return by_label.unionByName(by_name).unionByName(rows.filter(F.col("id") == 3)).select("id")


@check(
    f"""
    WITH {s.CUSTOMER_REPO_SQL}
    SELECT id, name, owner, url, created_at, CAST(NULL AS VARCHAR) AS alphabet_partition, CAST(NULL AS VARCHAR) AS name_with_owner
    FROM target
    """
)
def older_table(t: Tables) -> DataFrame:
    """A table from before the two late columns were added, read with the present schema."""
    return conform(s.customer_repo(t.customer).drop("alphabet_partition", "name_with_owner"), REPO)


@check(f"WITH {s.REPO_SQL} SELECT id, stars FROM repo ORDER BY stars DESC, id LIMIT 4000")
def ranked_to_target(t: Tables) -> DataFrame:
    return ranking.cap(s.repo(t.part).select("id", "stars"), 4000, None, [F.col("stars").desc(), F.col("id")])


@check(f"WITH {s.CUSTOMER_REPO_SQL} SELECT id, owner, name, name_with_owner FROM target ORDER BY id LIMIT 5")
def preview(t: Tables) -> DataFrame:
    return ranking.preview(s.customer_repo(t.customer).select("id", "owner", "name", "name_with_owner"), 5, ["id"])
