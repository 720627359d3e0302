from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from checks.standins import page_texts
from harvest.operators.measure import page_yield
from harvest.operators.pages import last_attempt, page_flags, page_status, query_yield, valid_pages
from harvest.operators.ranking import cap, first_seen, result_window
from harvest.plans.load import Roots, harvest_pages
from harvest.plans.replay import node_outcomes, page_outcomes, replay
from harvest.schemas import NODE
from harvest.sources.pages import parse_pages, parsed_nodes, read_pages
from harvest.sources.tables import read_stats


def body(nodes=(), has_next=True, remaining=4999, errors=None, **drop):
    search = {"nodes": list(nodes), "pageInfo": {"endCursor": "c", "hasNextPage": has_next}, "repositoryCount": len(nodes)}
    document = {"data": {"search": search, "rateLimit": {"remaining": remaining, "resetAt": "2025-01-01T00:00:00Z"}}}
    for key in drop.get("without", ()):
        search.pop(key, None)
        document["data"]["rateLimit"].pop(key, None)
    if errors is not None:
        document["errors"] = errors
    return document


def frame(spark, rows):
    """rows: (http_status, job, query_idx, page_idx, attempt, document or text)"""
    texts = [(*row[:5], row[5] if isinstance(row[5], str) else json.dumps(row[5])) for row in rows]
    landed = spark.createDataFrame(texts, "http_status int, job int, query_idx int, page_idx int, attempt int, response string")
    return parse_pages(landed, "response")


@pytest.mark.parametrize(
    "code, document, status",
    [
        (200, body(), "ok"),
        (401, body(), "auth"),
        (403, "API Rate Limit exceeded for you", "rate_limited"),
        (403, "no access", "failed"),
        (502, "", "server_error"),
        (503, "", "server_error"),
        (504, "", "server_error"),
        (500, "", "failed"),
        (None, "", "failed"),
        (200, body(errors=[{"type": "FORBIDDEN"}]), "auth"),
        (200, body(errors=[{"message": "Unauthorized"}]), "auth"),
        (200, body(errors=[{"type": "RATE_LIMITED"}, {"type": "FORBIDDEN"}]), "rate_limited"),
        (200, body(errors=[{"type": "x"}, {"type": "FORBIDDEN", "message": "RATE_LIMITED"}]), "auth"),
        (200, body(errors=[{"type": "x"}]), "ok_with_errors"),
        (200, {"data": None, "errors": [{"type": "x"}]}, "failed"),
        (200, {"data": {}}, "failed"),
        (200, "not json", "failed"),
        (200, body(without=["nodes"]), "failed"),
        (200, body(without=["pageInfo"]), "failed"),
        (200, body(without=["repositoryCount"]), "failed"),
        (200, body(without=["remaining"]), "failed"),
        (200, body(remaining=None), "ok"),
    ],
)
def test_status(spark, code, document, status):
    assert page_status(frame(spark, [(code, 0, 0, 0, 0, document)])).first().status == status


def chain(spark, rows):
    """rows: (page_idx, attempt, ok, has_next) of one chain; the page numbers that are reached"""
    table = spark.createDataFrame([(0, 0, *row) for row in rows], "job int, query_idx int, page_idx int, attempt int, ok boolean, has_next boolean")
    return sorted(row.page_idx for row in valid_pages(last_attempt(table)).collect())


def test_chain_rules(spark):
    assert chain(spark, [(i, 0, True, True) for i in range(13)]) == list(range(10))
    assert chain(spark, [(0, 0, True, True), (1, 0, True, False), (2, 0, True, True)]) == [0, 1]
    assert chain(spark, [(0, 0, True, True), (1, 0, False, True), (2, 0, True, True)]) == [0]
    assert chain(spark, [(0, 0, True, True), (2, 0, True, True)]) == [0]
    assert chain(spark, [(1, 0, True, True)]) == []
    assert chain(spark, [(0, 0, False, False), (0, 1, True, True), (1, 0, True, True)]) == [0, 1]
    assert chain(spark, [(0, 0, True, True), (0, 1, False, True), (1, 0, True, True)]) == []


def test_null_counter_and_missing_next_end_the_chain(spark):
    rows = [(200, 0, 0, 0, 0, body(remaining=None)), (200, 0, 1, 0, 0, body(has_next=None)), (200, 0, 2, 0, 0, body())]
    flags = {r.query_idx: (r.ok, r.has_next) for r in page_flags(frame(spark, rows)).collect()}
    assert flags == {0: (True, False), 1: (True, False), 2: (True, True)}


def node(id):
    return {"databaseId": id, "name": f"n{id}", "owner": {"login": f"o{id % 7}"}, "url": f"u{id}", "stargazerCount": id % 50, "createdAt": "2023-01-01T00:00:00Z"}


def landed_pages(seed):
    """Random jobs with retries, failures, early ends, bad nodes and repeated ids."""
    rng, rows = random.Random(seed), []
    for job in range(6):
        for query in range(3):
            for page in range(rng.randint(1, 13)):
                ids = [rng.randint(1, 120) for _ in range(rng.randint(0, 8))]
                nodes = [node(i) for i in ids]
                if nodes and rng.random() < 0.05:
                    nodes[rng.randrange(len(nodes))] = {"databaseId": -1}
                attempts = [rng.choice([(502, ""), (403, "rate limit")]) for _ in range(rng.choice([0, 0, 0, 1, 2]))]
                last = (500, "") if rng.random() < 0.06 else (200, body(nodes, has_next=rng.random() > 0.08))
                rows += [(code, job, query, page, i, text) for i, (code, text) in enumerate([*attempts, last])]
    rng.shuffle(rows)
    return rows


def loop(rows, target, on_bad):
    """The run page by page, in plain Python."""
    last = {}
    for code, job, query, page, attempt, document in rows:
        key = (job, query, page)
        if key not in last or attempt > last[key][0]:
            last[key] = (attempt, code, document)
    out = []
    for job in sorted({row[1] for row in rows}):
        seen = []
        for query in range(3):
            page = 0
            while len(seen) < target and page < 10 and (job, query, page) in last:
                _, code, document = last[job, query, page]
                if code != 200:
                    break
                nodes = document["data"]["search"]["nodes"]
                if on_bad == "page" and any(n["databaseId"] < 0 for n in nodes):
                    break
                for n in nodes:
                    if n["databaseId"] > 0 and n["databaseId"] not in seen and len(seen) < target:
                        seen.append(n["databaseId"])
                if not document["data"]["search"]["pageInfo"]["hasNextPage"]:
                    break
                page += 1
        out += [(job, place, id) for place, id in enumerate(seen)]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("on_bad", ["page", "row"])
def test_replay_equals_the_loop(spark, seed, on_bad):
    rows = landed_pages(seed)
    got = replay(frame(spark, rows), target=40, on_bad=on_bad).orderBy("job", "query_idx", "page_idx", "pos").collect()
    place, result = {}, []
    for r in got:
        place[r.job] = place.get(r.job, -1) + 1
        result.append((r.job, place[r.job], r.id))
    assert result == loop(rows, 40, on_bad)


def test_replay_repeats_of_one_page(spark):
    """A page that is served again under every page number adds nothing."""
    rows = [(200, 0, 0, page, 0, body([node(1), node(2)])) for page in range(12)]
    assert sorted(r.id for r in replay(frame(spark, rows)).collect()) == [1, 2]


def test_replay_rejects_unknown_mode(spark):
    with pytest.raises(ValueError):
        replay(frame(spark, [(200, 0, 0, 0, 0, body())]), on_bad="skip")


@pytest.mark.parametrize("salts", [None, 1, 3])
@pytest.mark.parametrize("n", [1, 7, 1500])
def test_cap_with_a_hot_job(spark, salts, n):
    rows = spark.range(6000).repartition(5).selectExpr("IF(id % 3 = 0, 0, id % 40) AS job", "(id * 7919) % 6000 AS pos", "id")
    got = sorted((r.job, r.pos) for r in cap(rows, n, "job", ["pos"], salts).collect())
    by_job = {}
    for r in rows.collect():
        by_job.setdefault(r.job, []).append(r.pos)
    assert got == sorted((job, pos) for job, all in by_job.items() for pos in sorted(all)[:n])


def test_cap_edges(spark):
    rows = spark.range(5).selectExpr("0 AS job", "id AS pos")
    assert cap(rows, 0, "job", ["pos"]).count() == 0
    assert [r.pos for r in cap(rows, 2, None, ["pos"]).collect()] == [0, 1]


def test_group_limit_runs_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 3 AS q", "id")
    plan = result_window(rows, ["q"], ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    assert first_seen(rows, "q", "id")._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_page_and_query_yield(spark):
    hits = spark.createDataFrame(
        [(0, 0, 0, 0, 1), (0, 0, 0, 1, 2), (0, 0, 1, 0, 2), (0, 1, 0, 0, 1), (0, 1, 0, 1, 3), (1, 0, 0, 0, 1)],
        "job int, query_idx int, page_idx int, pos int, id long",
    )
    got = sorted((r.job, r.query_idx, r.page_idx, r.hits, r.new_ids) for r in page_yield(hits).collect())
    assert got == [(0, 0, 0, 2, 2), (0, 0, 1, 1, 0), (0, 1, 0, 2, 1), (1, 0, 0, 1, 1)]
    pages = frame(spark, [(200, 0, 0, 0, 0, body([node(1), node(2)])), (200, 0, 0, 1, 0, body([node(3)])), (502, 0, 1, 0, 0, "")])
    got = sorted((r.query_idx, r.pages, r.rows, r.reported) for r in query_yield(pages).collect())
    assert [g[:3] for g in got] == [(0, 2, 3), (1, 1, 0)]


@pytest.mark.parametrize("on_bad", ["page", "row"])
def test_every_landed_node_and_page_has_an_outcome(spark, tmp_path, on_bad):
    rows = landed_pages(5)
    document = {"http_status": 200, "job": 0, "query_idx": 0, "page_idx": 0, "attempt": 0}
    lines = [json.dumps(dict(zip(document, row[:5])) | {"text" if isinstance(row[5], str) else "body": row[5]}) for row in rows]
    (tmp_path / "pages.json").write_text("\n".join([*lines, "{broken", '{"job": 1}']))
    pages = read_pages(spark, str(tmp_path))
    told = page_outcomes(pages, on_bad).cache()
    assert told.count() == len(lines) + 2
    assert sorted(r.raw or "" for r in told.where("outcome = 'malformed'").collect()) == ["", "{broken"]
    nodes = node_outcomes(told, 40, None).cache()
    assert nodes.count() == sum(len(row[5]["data"]["search"]["nodes"]) for row in rows if isinstance(row[5], dict))
    stored = sorted((r.job, r.query_idx, r.page_idx, r.pos, r.id) for r in nodes.where("outcome = 'stored'").collect())
    assert stored == sorted((r.job, r.query_idx, r.page_idx, r.pos, r.id) for r in replay(pages, 40, on_bad).collect())
    rejected = nodes.where("outcome = reason")
    assert rejected.count() > 0 and rejected.where("id > 0").count() == 0


def test_runs_with_the_same_pages_stay_apart(spark, tmp_path):
    days = ["2024-03-01", "2024-03-02"]
    lines = []
    for at, day in enumerate(days):
        page = {"run": f"r{at}", "fetched_date": day, "http_status": 200, "job": 0, "query_idx": 0, "page_idx": 0, "attempt": 0}
        lines.append(json.dumps(page | {"body": body([node(7) | {"stargazerCount": at}, node(8 + at)], has_next=False)}))
    lines.append(json.dumps(page | {"query_idx": 1, "http_status": 502, "text": "bad gateway"}))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "pages.json").write_text("\n".join(lines))
    roots = Roots(*(str(tmp_path / name) for name in ("repo", "stats", "bad")))
    loaded = harvest_pages(read_pages(spark, str(tmp_path / "landing")), roots, dt.date(2020, 1, 1), label="both")
    assert {r.outcome: r.rows for r in loaded.report.collect()} == {"stored": 4, "page_server_error": 1}
    stats = sorted((r.repo_id, str(r.fetched_date), r.stars) for r in read_stats(spark, roots.stats).collect())
    assert stats == [(7, days[0], 0), (7, days[1], 1), (8, days[0], 8), (9, days[1], 9)]
    (lost,) = spark.read.parquet(roots.bad).collect()
    assert (lost.run, lost.reason, lost.raw) == ("r1", "page_server_error", "bad gateway")


def test_replay_shuffles_three_times(spark):
    plan = replay(frame(spark, landed_pages(1)), 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


ODD_NODES = [
    node(3) | {"databaseId": "x"}, node(4) | {"name": None}, node(5) | {"createdAt": "then"}, node(6) | {"createdAt": None},
    node(7) | {"forkCount": "many"}, node(8) | {"owner": 5}, node(9) | {"url": 1.5}, {"name": "n"}, None, 5, [1], "", "text", node(10) | {"stargazerCount": -1},
    # Texts that would be two nodes, or swallow the next one, if the texts of a page were simply strung together.
    json.dumps(node(11)) + "," + json.dumps(node(12)), json.dumps(node(13))[:-1] + ', "y": [{}', "{}]}", json.dumps(node(14)) + " rest",
    json.dumps(node(15)) + ', "harvest#node#2": ' + json.dumps(node(16)), json.dumps(node(17))[:-1] + ', "y": {"a": 1', '"b": 2}}', '{"databaseId": 1',
]


@pytest.mark.parametrize("odd", [[], *([n] for n in ODD_NODES), ODD_NODES[15:17], ODD_NODES[19:21], ODD_NODES])
def test_nodes_parsed_together_equal_nodes_parsed_alone(spark, odd):
    raws = [n if n is None or isinstance(n, str) else json.dumps(n) for n in (node(1), *odd, node(2) | {"name": 'q"\\,é'})]
    rows = spark.createDataFrame([(0, raws), (1, []), (2, None)], "i int, nodes array<string>")
    alone = F.transform("nodes", lambda raw: F.struct(raw.alias("raw"), F.from_json(raw, NODE).alias("node")))
    got = rows.select("i", parsed_nodes(F.col("nodes")).alias("n"), alone.alias("want")).collect()
    assert [r.n for r in got] == [r.want for r in got]


def test_good_nodes_of_a_page_are_parsed_by_one_parser(spark):
    """A page of good nodes is taken from the page's own parse: the parser of single nodes is not needed for it."""
    rows = spark.createDataFrame([([json.dumps(node(i)) for i in range(1, 9)],)], "nodes array<string>")
    plan = rows.select(parsed_nodes(F.col("nodes")).alias("n"))._jdf.queryExecution().analyzed().toString()
    assert "MapType" in plan and plan.count("from_json") == 2


def test_page_texts_equal_plain_json(spark):
    """The texts of the landed pages hold their nodes as any JSON writer would print them, nulls and odd names included."""
    events = spark.createDataFrame(
        [(1, 'a"b\\\n/é', 3.5, '{"k":1}'), (2, None, None, '{"k":2}'), (391, "click", 45.0, "x"), (-50, "", float("nan"), "{}")],
        "event_id long, event_type string, value double, props string",
    )
    texts = {r.page_idx: json.loads(r.response)["data"]["search"]["nodes"] for r in page_texts(events).collect()}
    first = texts[1][0]
    assert (first["databaseId"], first["name"], first["owner"], first["stargazerCount"]) == (2, "n2", {"login": 'a"b\\\n/é'}, 3)
    assert first["url"] == "https://example.com/n2" and list(first) == ["databaseId", "name", "owner", "url", "createdAt", "stargazerCount"]
    assert texts[2][1]["owner"] == {} and "stargazerCount" not in texts[2][1] and texts[2][1]["databaseId"] == 11
