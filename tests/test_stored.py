"""Tables in buckets, stored lookups, free matrices, special queries, and runs that go on."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from harvest.operators import bands, upsert
from harvest.plans.continued import collected, forget_waiting, loads, replay_more
from harvest.plans.replay import replay
from harvest.schemas import REPO
from harvest.sources import buckets, matrix_values as v
from test_pages import frame as page_frame, landed_pages
from test_tables import WRITES, batch_frame, content, repo_frame, written_one_by_one


def files_of(root):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in root.rglob("*.parquet")}


@pytest.mark.parametrize("policy", upsert.POLICIES)
def test_only_touched_buckets_are_rewritten(spark, tmp_path, policy):
    root = tmp_path / "repo"
    start = [(i, f"n{i}", "o", "matrix_0") for i in range(200)]
    buckets.publish_buckets(repo_frame(spark, start), str(root), buckets=16)
    before = files_of(root)
    writes = [(3, "new", "p", "matrix_1"), (3, "newer", "p", None), (250, "b", "q", "matrix_2")]
    touched = buckets.store_buckets(batch_frame(spark, writes), str(root), policy)
    assert 1 <= len(touched) <= 2
    assert content(buckets.read_bucketed_repo(spark, str(root))) == written_one_by_one(start, writes, policy)
    after = files_of(root)
    of = {p for p in before if any(f"bucket={n}/" in p for n in touched)}
    assert of and {p: before[p] for p in before if p not in of} == {p: after[p] for p in after if not any(f"bucket={n}/" in p for n in touched)}
    assert not of & set(after)
    # The same batch again, and an empty one, change nothing.
    buckets.store_buckets(batch_frame(spark, writes), str(root), policy)
    assert buckets.store_buckets(batch_frame(spark, []), str(root), policy) == []
    assert content(buckets.read_bucketed_repo(spark, str(root))) == written_one_by_one(start, writes, policy)


def test_new_and_empty_tables(spark, tmp_path):
    root = str(tmp_path / "repo")
    assert buckets.read_bucketed_repo(spark, root).count() == 0 and buckets.bucket_count(spark, root) is None
    assert buckets.store_buckets(batch_frame(spark, []), root, buckets=4) == []
    assert buckets.read_bucketed_repo(spark, root).count() == 0 and buckets.bucket_count(spark, root) == 4
    buckets.store_buckets(batch_frame(spark, WRITES), root)
    table = buckets.read_bucketed_repo(spark, root)
    assert content(table) == written_one_by_one([], WRITES, "keep_first")
    assert [f.name for f in table.schema.fields] == [f.name for f in REPO.fields] and table.schema["id"].metadata["comment"]
    with pytest.raises(ValueError, match="4 buckets"):
        buckets.store_buckets(batch_frame(spark, WRITES), root, buckets=8)
    assert buckets.delete_buckets(spark.createDataFrame([(99,)], "id long"), root) == []
    assert len(buckets.delete_buckets(spark.createDataFrame([(1,), (2,), (2,)], "id long"), root)) in (1, 2)
    assert buckets.read_bucketed_repo(spark, root).count() == 0


def scanned(df, metric="numOutputRows"):
    """Rows that the scan of a query gave to its filter, or another of its metrics."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    leaves = node.collectLeaves()
    return sum(leaves.apply(i).metrics().apply(metric).value() for i in range(leaves.size()))


def test_lookups_read_little(spark, tmp_path):
    root = str(tmp_path / "repo")
    rows = spark.range(20_000).select(
        "id", F.concat(F.lit("n"), "id").alias("name"), F.lit("o").alias("owner"), F.lit("u").alias("url"), F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("string").alias("alphabet_partition"), F.concat(F.lit("o/n"), F.col("id") * 2).alias("name_with_owner"),
    )
    buckets.publish_buckets(rows, root, buckets=32, values=2000)
    few = buckets.by_ids(spark, root, [17, 400, 10**9])
    assert sorted(r["id"] for r in few.collect()) == [17, 400]
    assert scanned(few, "numPartitions") <= 3 and scanned(few, "numFiles") <= 6
    assert scanned(few) < 3 * 20_000 / 32 * 1.5
    # The name lies between the least and the greatest name of every row group, but only a few bloom filters know it.
    assert [r["id"] for r in buckets.by_name(spark, root, ["o/n1234"]).collect()] == [617]
    assert scanned(buckets.by_name(spark, root, ["o/n1234"])) < 20_000 / 4
    assert scanned(buckets.by_name(spark, root, ["o/n1235"])) < 20_000 / 4
    assert buckets.by_ids(spark, root, []).count() == 0


def test_blocks_make_up_their_range(spark):
    rng = random.Random(1)
    ranges = [(0, 0), (0, 7), (1, 6), (5, 4), (3, 3), (0, bands.LAST_STAR)] + [tuple(sorted((rng.randrange(300), rng.randrange(300)))) for _ in range(60)]
    frame = spark.createDataFrame(ranges, "lo long, hi long")
    for r in frame.select("lo", "hi", bands.blocks_of(F.col("lo"), F.col("hi")).alias("blocks")).collect():
        held = sorted((b["block"] << b["level"], (b["block"] + 1 << b["level"]) - 1) for b in r["blocks"])
        at = r["lo"]
        for a, b in held:
            assert a == at
            at = b + 1
        assert at == max(r["hi"], r["lo"] - 1) + 1


def test_free_bounds_equal_a_plain_walk(spark):
    rng = random.Random(2)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    repos = [(i, rng.choice([None, rng.randrange(400)]), rng.choice(["Go", "rust", None]), rng.choice([["a", "b", "a"], [], None]), day(rng.randrange(50)), rng.randrange(9)) for i in range(150)]
    some = lambda x: rng.choice([None, x])
    asked = []
    for k in range(60):
        lo, first = rng.randrange(400), rng.randrange(50)
        asked.append((f"q{k % 55}", some(rng.choice(["go", "rust"])), some("a"), some(lo), some(lo + rng.randrange(-3, 80)), some(day(first)), some(day(first + rng.randrange(20))), some(rng.randrange(9))))
    frame = spark.createDataFrame(repos, "id long, stars long, lang string, topics array<string>, born date, size int")
    matrix = spark.createDataFrame(asked, "query_string string, language string, topic string, star_lo long, star_hi long, created_lo date, created_hi date, size_hi long")
    columns = {"stars": "stars", "language": "lang", "topic": "topics", "created": "born", "size": "size"}
    expected = set()
    for i, stars, lang, topics, born, size in repos:
        for q, language, topic, a, b, c, d, e in asked:
            if stars is None or (language and language != (lang or "").lower()) or (topic and topic not in (topics or [])):
                continue
            if (a is None or stars >= a) and (b is None or stars <= b) and (c is None or born >= c) and (d is None or born <= d) and (e is None or size <= e):
                expected.add((i, q))
    found = bands.free_coverage(frame, matrix, columns)
    got = [tuple(r) for r in found.collect()]
    assert set(got) == expected and len(got) == len(expected) > 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert bands.free_coverage(frame, matrix.limit(0), columns).count() == 0
    with pytest.raises(ValueError, match="size_hi"):
        bands.free_coverage(frame, matrix, {k: c for k, c in columns.items() if k != "size"})
    with pytest.raises(ValueError, match="stars"):
        bands.free_coverage(frame, matrix, {})


def test_totals_of_free_bounds_need_no_pairs(spark):
    rng = random.Random(3)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    some = lambda x: rng.choice([None, x])
    repos = [(rng.choice([i, i, 7, None]), some(rng.randrange(-5, 400)), rng.choice(["Go", "rust", None]), rng.choice([["a", "b", "a"], [], None]), some(day(rng.randrange(50))), some(rng.randrange(-4, 9))) for i in range(80)]
    asked = []
    for k in range(50):
        lo, first = rng.randrange(-9, 430), rng.randrange(-9, 60)
        asked.append((f"q{k % 40}", some(rng.choice(["go", "rust"])), some("a"), some(lo), some(lo + rng.randrange(-3, 80)), some(day(first)), some(day(first + rng.randrange(-2, 20))), some(rng.randrange(-6, 12))))
    repos, asked = repos + repos[:40], asked + asked[:20]
    frame = spark.createDataFrame(repos, "id long, stars long, lang string, topics array<string>, born date, size int")
    matrix = spark.createDataFrame(asked, "query_string string, language string, topic string, star_lo long, star_hi long, created_lo date, created_hi date, size_hi long")
    columns = {"stars": "stars", "language": "lang", "topic": "topics", "created": "born", "size": "size"}
    plain = lambda rows: sorted((r["query_string"], r["repos"], r["ids"]) for r in rows.collect())
    once, bare = frame.filter("id > 7").dropDuplicates(["id"]), frame.withColumn("born", F.lit(None).cast("date"))
    for rows, queries in ((frame, matrix), (once, matrix.dropDuplicates(["query_string"])), (frame.limit(0), matrix), (bare, matrix.limit(20))):
        pairs = bands.free_coverage(rows, queries, columns).groupBy("query_string").agg(F.count(F.lit(1)).alias("repos"), F.sum("id").alias("ids"))
        assert plain(bands.free_coverage_totals(rows, queries, columns)) == plain(pairs)
    # Nothing of a large matrix is broadcast: its blocks would pass through the driver.
    wide = spark.range(40_000).select(F.concat(F.lit("w"), "id").alias("query_string"), (F.col("id") % 300).alias("star_lo"), F.lit(None).cast("bigint").alias("star_hi"))
    for found in (bands.free_coverage(frame, wide, columns), bands.free_coverage_totals(frame.filter("id > 7"), wide, columns)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_special_queries_become_predicates(spark):
    for text, _ in [*v.SPECIALS, *v.COARSE_SPECIALS]:
        assert bands.spec_of(text)["stars"]
    assert bands.spec_of("is:public has:issues has:wiki pushed:>2024-06-01 size:<100 stars:..9 template:true license:mit sort:updated") == {
        "has": ["issues", "wiki"], "pushed": {">": dt.date(2024, 6, 1)}, "size": {"<": 100}, "stars": (None, 9), "template": True, "license": "mit",
    }
    rows = spark.createDataFrame([(1, 5, True), (2, 50, True), (3, 5, None)], "id long, stars int, template boolean")
    specs = {"a": {"stars": (0, 9)}, "b": {"template": True}, "none": {"stars": {">": 99}}}
    got = bands.predicate_coverage(rows, specs, {"stars": "stars", "template": "template"})
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (1, "b"), (2, "b"), (3, "a")]
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    with pytest.raises(ValueError, match="mapped"):
        bands.predicate_coverage(rows, specs, {"stars": "stars"})
    assert bands.predicate_coverage(rows, {}, {}).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_crawl_order_equal_one_replay(spark, tmp_path, seed):
    """Chains cut anywhere, pages that come late or fail once, ids that earlier loads saw, targets that earlier loads filled."""
    root, rng = str(tmp_path / "state"), random.Random(seed)
    pages = page_frame(spark, landed_pages(seed))
    whole = replay(pages, 25, "page")
    expected = {tuple(r) for r in whole.select("job", "query_idx", "page_idx", "pos", "id").collect()}
    cuts = sorted((rng.randrange(3), rng.randrange(10)) for _ in range(2))
    place = F.struct("query_idx", "page_idx")
    at = [F.struct(F.lit(q).alias("query_idx"), F.lit(p).alias("page_idx")) for q, p in cuts]
    parts = [pages.filter(place < at[0]), pages.filter((place >= at[0]) & (place < at[1])), pages.filter(place >= at[1])]
    records = [replay_more(part, root, 25) for part in parts]
    assert replay_more(parts[1], root, 25).count() == 0
    assert loads(spark, root) == [1, 2, 3, 4]
    got = [tuple(r) for r in collected(spark, root, records[0].schema).select("job", "query_idx", "page_idx", "pos", "id").collect()]
    assert len(got) == len(set(got)) and set(got) == expected and len(got) > 30
    forget_waiting(spark, root)
    assert replay_more(parts[2], root, 25).count() == 0
