"""Harvest tables derived from the generated tables, in Spark and, as common table expressions, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harvest.operators.ranking import default_salts
from harvest.sources.pages import parse_pages

FETCHED = "2024-03-01"

REPO_SQL = """
repo AS (
  SELECT p_partkey AS id, p_name AS name, p_brand AS owner, 'https://example.com/' || p_brand || '/' || p_name AS url,
         CAST(p_size AS BIGINT) AS stars, lower(p_type) AS language,
         CAST(TIMESTAMP '2016-06-01 10:00:00' + to_days(CAST(p_partkey % 3000 AS INTEGER)) AS TIMESTAMP) AS created_at
  FROM part
)"""


def repo(part: DataFrame) -> DataFrame:
    """Parts as harvested records."""
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("owner"),
        F.concat(F.lit("https://example.com/"), "p_brand", F.lit("/"), "p_name").alias("url"),
        F.col("p_size").cast("bigint").alias("stars"),
        F.lower("p_type").alias("language"),
        (F.lit("2016-06-01 10:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("p_partkey") % 3000).cast("int"))).alias(
            "created_at"
        ),
    )


DEFECTS_SQL = """
defects AS (
  SELECT p_partkey AS id, CASE WHEN p_size % 7 = 0 THEN '' ELSE p_name END AS name,
         CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_brand END AS owner,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 'https://example.com/' || p_name END AS url,
         CASE WHEN p_partkey % 19 = 0 THEN CAST(p_size AS BIGINT) * 1000000000 ELSE CAST(p_size AS BIGINT) - 3 END AS stars,
         CASE WHEN p_partkey % 17 = 0 THEN repeat('x', p_size * 4) ELSE 'matrix_' || p_size END AS alphabet_partition
  FROM part
),
marked AS (
  SELECT *, CASE
    WHEN id <= 0 THEN 'id_not_positive'
    WHEN name = '' OR owner IS NULL THEN 'name_or_owner_empty'
    WHEN stars < 0 THEN 'stars_negative'
    WHEN url IS NULL THEN 'url_null'
    WHEN length(alphabet_partition) > 100 THEN 'partition_too_long'
    WHEN stars > 2147483647 THEN 'stars_out_of_range' END AS reason
  FROM defects
)"""


def defects(part: DataFrame) -> DataFrame:
    """Parts as records of which some break a rule."""
    size, key = F.col("p_size"), F.col("p_partkey")
    stars = size.cast("bigint")
    return part.select(
        key.alias("id"),
        F.when(size % 7 == 0, "").otherwise(F.col("p_name")).alias("name"),
        F.when(size % 11 != 0, F.col("p_brand")).alias("owner"),
        F.when(key % 13 != 0, F.concat(F.lit("https://example.com/"), "p_name")).alias("url"),
        F.when(key % 19 == 0, stars * 1000000000).otherwise(stars - 3).alias("stars"),
        F.when(key % 17 == 0, F.repeat(F.lit("x"), size * 4))
        .otherwise(F.concat(F.lit("matrix_"), size.cast("string")))
        .alias("alphabet_partition"),
    )


STATS_SQL = """
stats_rows AS (
  SELECT user_id * 20 AS repo_id, CAST(ts AS DATE) AS fetched_date, CAST(floor(value) AS INTEGER) AS stars, event_id AS seq FROM events
),
stats AS (
  SELECT repo_id, fetched_date, stars FROM stats_rows
  QUALIFY row_number() OVER (PARTITION BY repo_id, fetched_date ORDER BY seq DESC) = 1
)"""


def stats_rows(events: DataFrame) -> DataFrame:
    """Events as star counts to store, in write order `seq`."""
    return events.select(
        (F.col("user_id") * 20).alias("repo_id"),
        F.to_date("ts").alias("fetched_date"),
        F.floor("value").cast("int").alias("stars"),
        F.col("event_id").alias("seq"),
    )


CUSTOMER_REPO_SQL = """
target AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS owner, 'https://example.com/' || c_name AS url,
         CAST(NULL AS TIMESTAMP) AS created_at, 'matrix_' || c_nationkey AS alphabet_partition,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '/' || c_name END AS name_with_owner
  FROM customer
)"""


def customer_repo(customer: DataFrame) -> DataFrame:
    """Customers as a stored repo table; name_with_owner is partly not filled."""
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("owner"),
        F.concat(F.lit("https://example.com/"), "c_name").alias("url"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.concat(F.lit("matrix_"), F.col("c_nationkey").cast("string")).alias("alphabet_partition"),
        F.when(F.col("c_acctbal") >= 0, F.concat("c_mktsegment", F.lit("/"), "c_name")).alias("name_with_owner"),
    )


ORDER_BATCH_SQL = """
batch AS (
  SELECT o_custkey * 2 AS id, o_orderpriority AS name, o_orderstatus AS owner, 'https://example.com/' || o_orderkey AS url,
         CAST(o_orderdate AS TIMESTAMP) AS created_at,
         CASE WHEN o_orderstatus <> 'P' THEN 'matrix_' || o_orderpriority END AS alphabet_partition, o_orderkey AS seq
  FROM orders
)"""


def order_batch(orders: DataFrame) -> DataFrame:
    """Orders as writes to the customer ids and to ids beyond them, many per id; some without a partition."""
    return orders.select(
        (F.col("o_custkey") * 2).alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("owner"),
        F.concat(F.lit("https://example.com/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("matrix_"), "o_orderpriority")).alias("alphabet_partition"),
        F.col("o_orderkey").alias("seq"),
    )


# Landed pages: every event is a page of 8 nodes, 13 pages are a chain, 3 chains a job. Ten jobs share
# 119 ids. Views were rate limited once and
# tried again; some errors fail in one of the ways a page can fail; some signups and purchases end their chain.
PAGES_SQL = """
landed AS (
  SELECT CAST(event_id // 39 AS INTEGER) AS job, CAST(event_id // 13 % 3 AS INTEGER) AS query_idx,
         CAST(event_id % 13 AS INTEGER) AS page_idx, attempt, event_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_type = 'view' AND attempt = 0 THEN 'rate_limited'
              WHEN event_type <> 'error' OR value >= 55 THEN 'ok'
              WHEN value < 10 THEN 'server_error' WHEN value < 20 THEN 'auth' WHEN value < 25 THEN 'rate_limited'
              WHEN value < 30 THEN 'failed' WHEN value < 40 THEN 'ok_with_errors' ELSE 'failed' END AS status,
         NOT (event_type = 'signup' AND value > 100) AND NOT (event_type = 'purchase' AND value > 150) AS has_next
  FROM events CROSS JOIN (VALUES (0), (1)) a(attempt)
  WHERE attempt = 0 OR event_type = 'view'
),
nodes AS (
  SELECT job, query_idx, page_idx, attempt, CAST(i AS INTEGER) AS pos,
         CASE WHEN (k + i * 7 + event_id) % 120 > 0 THEN (k + i * 7 + event_id) % 120 + event_id // 390 * 120 ELSE 0 END AS id,
         event_type AS owner, CAST(floor(value) AS BIGINT) + i AS stars, status, has_next
  FROM landed CROSS JOIN range(0, 8) r(i)
)"""

CHAIN_SQL = """
last_try AS (
  SELECT l.*, status IN ('ok', 'ok_with_errors'){clean} AS ok FROM landed l
  QUALIFY row_number() OVER (PARTITION BY job, query_idx, page_idx ORDER BY attempt DESC) = 1
),
chain AS (
  SELECT *, coalesce(bool_and(ok AND has_next) OVER before, true) AND ok
            AND row_number() OVER (PARTITION BY job, query_idx ORDER BY page_idx) - 1 = page_idx AS reached
  FROM last_try
  WINDOW before AS (PARTITION BY job, query_idx ORDER BY page_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
reached AS (SELECT * FROM chain WHERE reached AND page_idx < 10)"""

# True where all nodes of a page are valid: id 0 is the only defect.
CLEAN_SQL = " AND NOT (" + " OR ".join(f"(k + {i} * 7 + event_id) % 120 = 0" for i in range(8)) + ")"


def _shared() -> Column:
    """What the nodes of a page have in common, between the name and the number in the address; the owner's text is escaped as in any JSON."""
    owner = F.to_json(F.struct(F.struct(F.col("event_type").alias("login")).alias("owner")))
    return F.concat(F.lit('",'), F.substring(owner, 2, F.length(owner) - 2), F.lit(',"url":"https://example.com/n'))


def _nodes() -> Column:
    """The nodes of a page as JSON text, with `_shared` in the column `shared`. Each id is worked out and printed once."""

    def numbered(i: Column) -> Column:
        within = (F.col("k") + i * 7 + F.col("event_id")) % 120
        id = F.when(within > 0, within + F.expr("event_id div 390") * 120).otherwise(0)
        # A star count of NULL is left out, as in any JSON.
        stars = F.coalesce(F.concat(F.lit(',"stargazerCount":'), (F.floor("value") + i).cast("string")), F.lit(""))
        return F.struct(id.cast("string").alias("id"), stars.alias("stars"))

    def text(n: Column) -> Column:
        return F.concat(
            F.lit('{"databaseId":'), n["id"], F.lit(',"name":"n'), n["id"], "shared", n["id"],
            F.lit('","createdAt":"2024-01-01T00:00:00Z"'), n["stars"], F.lit("}"),
        )

    nodes = F.transform(F.transform(F.sequence(F.lit(0), F.lit(7)), numbered), text)
    return F.concat(F.lit("["), F.array_join(nodes, ","), F.lit("]"))


def page_texts(events: DataFrame) -> DataFrame:
    """Landing columns and the response text of every page attempt."""
    kind, value, id = F.col("event_type"), F.col("value"), F.col("event_id")
    # A row of a few bytes grows to a page of 1,200: spread the small rows first, so that all cores share the text work.
    spread = events.select(id, kind, value, "props").repartition(default_salts(events.sparkSession), id)
    rows = spread.select(
        id, kind, value, F.get_json_object("props", "$.k").cast("bigint").alias("k"), _shared().alias("shared"),
        F.explode(F.when(kind == "view", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("attempt"),
    )
    bad = (kind == "error") & (value < 55)
    nodes = _nodes()
    more = F.when((kind == "signup") & (value > 100), "false").otherwise("true")
    left = F.when((kind == "purchase") & (value > 150), "null").otherwise("4999")
    limit = F.when(bad & (value >= 50), F.lit("{}")).otherwise(F.concat(F.lit('{"remaining":'), left, F.lit("}")))
    data = F.concat(
        F.lit('{"search":{"repositoryCount":500,"pageInfo":{"endCursor":"c","hasNextPage":'), more, F.lit('},"nodes":'), nodes,
        F.lit('},"rateLimit":'), limit, F.lit("}"),
    )
    errors = (
        F.when(value < 20, '[{"type":"other"},{"type":"FORBIDDEN","note":"RATE_LIMITED"}]')
        .when(value < 25, '[{"type":"RATE_LIMITED"},{"type":"FORBIDDEN"}]')
        .otherwise('[{"type":"other"}]')
    )
    answer = (
        F.when(~bad | (value >= 50), F.concat(F.lit('{"data":'), data, F.lit("}")))
        .when(value < 30, F.concat(F.lit('{"data":null,"errors":'), errors, F.lit("}")))
        .otherwise(F.concat(F.lit('{"data":'), data, F.lit(',"errors":'), errors, F.lit("}")))
    )
    limited = (kind == "view") & (F.col("attempt") == 0)
    status = (
        F.when(limited, 403)
        .when(bad & (value < 10), 502)
        .when(bad & (value < 15), 401)
        .when(bad & (value >= 40) & (value < 50), 403)
        .otherwise(200)
    )
    text = F.when(limited, "You hit the API Rate Limit; wait.").when(status == 403, "blocked").otherwise(answer)
    return rows.select(
        status.alias("http_status"),
        F.expr("event_id div 39").cast("int").alias("job"),
        F.expr("event_id div 13 % 3").cast("int").alias("query_idx"),
        (id % 13).cast("int").alias("page_idx"),
        "attempt",
        text.alias("response"),
    )


def pages(events: DataFrame) -> DataFrame:
    """The landed pages, parsed from their response text."""
    return parse_pages(page_texts(events), "response")
