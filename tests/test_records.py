from __future__ import annotations

import datetime as dt
import json

import pytest

from harvest.functions.names import with_name
from harvest.functions.qualifiers import predicate, qualify
from harvest.functions.timestamps import parse_ts
from harvest.operators import records
from harvest.schemas import REPO
from harvest.sources.pages import explode_nodes, parse_pages, read_pages

FULL = {
    "databaseId": 90210,
    "name": "reedbed",
    "url": "https://example.com/heron/reedbed",
    "createdAt": "2023-01-01T00:00:00Z",
    "stargazerCount": 37,
    "forkCount": 10,
    "primaryLanguage": {"name": "Python"},
    "owner": {"login": "heron"},
    "licenseInfo": {"name": "MIT License"},
    "pushedAt": "2023-11-08T07:15:00Z",
    "updatedAt": "2023-11-09T18:45:00Z",
}
MINIMAL = {"databaseId": 7040, "name": "m", "owner": {"login": "o"}, "url": "u", "stargazerCount": 5}


def page(nodes):
    return {"data": {"search": {"nodes": nodes, "pageInfo": {"hasNextPage": True}, "repositoryCount": 1}}}


def nodes_of(spark, nodes):
    body = spark.createDataFrame([(json.dumps(page(nodes)),)], "body string")
    return explode_nodes(parse_pages(body, "body"))


def test_full_node(spark):
    (row,) = records.to_repo(nodes_of(spark, [FULL])).collect()
    assert row.asDict() == {
        "pos": 0,
        "id": 90210,
        "name": "reedbed",
        "owner": "heron",
        "url": "https://example.com/heron/reedbed",
        "stars": 37,
        "created_at": dt.datetime(2023, 1, 1),
        "pushed_at": dt.datetime(2023, 11, 8, 7, 15),
        "updated_at": dt.datetime(2023, 11, 9, 18, 45),
        "primary_language": "Python",
        "fork_count": 10,
        "license_name": "MIT License",
    }


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"createdAt": None}, None),
        ({"createdAt": ""}, None),
        ({"createdAt": "junk"}, "created_at_invalid"),
        ({"createdAt": "2023"}, "created_at_invalid"),
        ({"createdAt": "2023-02-30T00:00:00Z"}, "created_at_invalid"),
        ({"databaseId": 0}, "id_not_positive"),
        ({"databaseId": -1}, "id_not_positive"),
        ({"databaseId": "7"}, "id_wrong_type"),
        ({"databaseId": 1.5}, "id_wrong_type"),
        ({"databaseId": True}, "id_wrong_type"),
        ({"databaseId": None}, "id_wrong_type"),
        ({"name": ""}, "name_or_owner_empty"),
        ({"name": "  "}, None),
        ({"owner": {"login": ""}}, "name_or_owner_empty"),
        ({"owner": None}, "owner_missing"),
        ({"owner": "text"}, "owner_missing"),
        ({"stargazerCount": -1}, "stars_negative"),
        ({"stargazerCount": 0}, None),
        ({"stargazerCount": "many"}, "stars_wrong_type"),
        ({"url": None}, None),
    ],
)
def test_node_reasons(spark, change, reason):
    (row,) = records.marked(nodes_of(spark, [{**MINIMAL, **change}]), records.node_reason()).collect()
    assert row.reason == reason


@pytest.mark.parametrize("key, reason", [("databaseId", "id"), ("name", "name"), ("owner", "owner"), ("url", "url"), ("stargazerCount", "stars")])
def test_missing_key(spark, key, reason):
    node = {k: v for k, v in MINIMAL.items() if k != key}
    assert [r.reason for r in records.check_node(nodes_of(spark, [node])).bad.collect()] == [f"{reason}_missing"]


def test_empty_and_null_nodes_are_rejected(spark):
    checked = records.check_node(nodes_of(spark, [{}, None, 5, [1], MINIMAL]))
    assert [r.node.databaseId for r in checked.ok.collect()] == [7040]
    assert sorted((r.pos, r.reason) for r in checked.bad.collect()) == [
        (0, "id_missing"),
        (1, "not_an_object"),
        (2, "not_an_object"),
        (3, "not_an_object"),
    ]


def test_null_url_passes_the_record_and_fails_the_table(spark):
    rows = records.to_repo(records.check_node(nodes_of(spark, [{**MINIMAL, "url": None}])).ok, extras=False)
    assert records.check_repo(rows).bad.count() == 0
    assert [r.reason for r in records.check_table(rows).bad.collect()] == ["url_null"]


def test_stars_beyond_int_fail_the_table(spark):
    rows = spark.createDataFrame([(1, "n", "o", "u", 2147483648), (2, "n", "o", "u", 2147483647)], "id long, name string, owner string, url string, stars long")
    assert [(r.id, r.reason) for r in records.check_table(rows).bad.collect()] == [(1, "stars_out_of_range")]


def test_partition_width_counts_characters(spark):
    rows = spark.createDataFrame([(1, "n", "o", "u", "é" * 100), (2, "n", "o", "u", "é" * 101)], "id long, name string, owner string, url string, alphabet_partition string")
    assert [r.id for r in records.check_table(rows).bad.collect()] == [2]
    assert records.check_table(rows, width=10).bad.count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_modes(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2023-01-01T00:00:00Z", "2023-01-01T00:00:00+05:30", "2023-01-01T00:00:00-0800", "2023-01-01 10:20", "2023-01-01"]
        texts += ["2023-01-01T00:00:00.123456Z", "2023-1-1T00:00:00Z", "20230101T000000Z", "2023-01-01T00:00:00 UTC", "", None]
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string")
        got = rows.select("i", parse_ts("s").alias("wall"), parse_ts("s", "utc").alias("utc")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    day = dt.datetime(2023, 1, 1)
    assert [r.wall for r in got] == [day, day, day, dt.datetime(2023, 1, 1, 10, 20), day, day.replace(microsecond=123456)] + [None] * 5
    assert [r.utc for r in got[:5]] == [day, dt.datetime(2022, 12, 31, 18, 30), dt.datetime(2023, 1, 1, 8), dt.datetime(2023, 1, 1, 10, 20), day]


def test_bad_time_mode():
    with pytest.raises(ValueError):
        parse_ts("s", "local")


def test_queries_of_blanks_are_rejected(spark):
    rows = spark.createDataFrame([("language:python stars:>100",), ("",), (" \t\n",), (None,)], "query_string string")
    checked = records.check_query(rows)
    assert [r.query_string for r in checked.ok.collect()] == ["language:python stars:>100"]
    assert checked.bad.count() == 3


def test_name_is_null_if_a_part_is(spark):
    rows = spark.createDataFrame([("o", "n"), (None, "n")], "owner string, name string")
    assert [r.name_with_owner for r in with_name(rows).collect()] == ["o/n", None]


def test_stats_alias(spark):
    rows = spark.createDataFrame([(123, "2023-01-01", 100)], "repoId long, fetched_date string, stars long")
    assert records.stats_from_records(rows).collect()[0].asDict() == {"repo_id": 123, "fetched_date": dt.date(2023, 1, 1), "stars": 100}


def test_qualifiers(spark):
    rows = spark.createDataFrame(
        [(1, 5, ["api", "cli"], False), (2, 6, ["api"], True), (3, None, ["cli"], False)], "id int, stars int, topics array<string>, fork boolean"
    )
    columns = {"stars": "stars", "topic": "topics", "fork": "fork"}

    def ids(spec):
        return sorted(r.id for r in qualify(rows, spec, columns).collect())

    assert ids({"stars": (5, 6)}) == [1, 2]
    assert ids({"stars": {">": 5}}) == [2]
    assert ids({"stars": (None, 5)}) == [1]
    assert ids({"topic": ["api", "cli"]}) == [1]
    assert ids({"topic": "cli", "fork": False}) == [1, 3]
    for spec in ({"license": "mit"}, {"colour": "red"}, {}, {"stars": (None, None)}, {"stars": {"=": 1}}):
        with pytest.raises(ValueError):
            predicate(spec, columns)


def test_qualifiers_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id AS stars", "'x' AS language").write.parquet(str(tmp_path / "t"))
    rows = qualify(spark.read.parquet(str(tmp_path / "t")), {"stars": (2, 4), "language": "x"}, {"stars": "stars", "language": "language"})
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = rows.select("id")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", before)
    assert "GreaterThanOrEqual(stars,2)" in plan and "EqualTo(language,x)" in plan


def test_malformed_line_is_a_failed_page(spark, tmp_path):
    from harvest.operators.pages import page_status

    good = {"http_status": 200, "job": 0, "query_idx": 0, "page_idx": 0, "attempt": 0, "body": page([MINIMAL])}
    good["body"]["data"]["rateLimit"] = {"remaining": 10}
    (tmp_path / "p.json").write_text(json.dumps(good) + "\n{broken\n")
    rows = page_status(read_pages(spark, str(tmp_path))).select("job", "status").collect()
    assert sorted((r.job, r.status) for r in rows if r.job is not None) == [(0, "ok")]
    assert [r.status for r in rows if r.job is None] == ["failed"]


def test_comments_are_metadata():
    assert all(field.metadata["comment"] for field in REPO.fields)
