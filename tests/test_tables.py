from __future__ import annotations

import csv
import datetime as dt
import json
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from harvest.functions.qualifiers import qualify
from harvest.operators import combine, history, measure, upsert
from harvest.operators.combine import export_view
from harvest.operators.records import stats_from_records
from harvest.plans.load import Roots, load_records
from harvest.schemas import REPO, STATS, conform
from harvest.sources.exports import export_csv, write_bad, write_jobs
from harvest.sources.scratch import scratch_dir
from harvest.sources.tables import (
    delete_stored,
    drop_versions,
    empty,
    publish_repo,
    read_repo,
    read_stats,
    store_repo,
    store_stats,
    version_path,
    versions,
)
from harvest.streaming.ingest import ingest_stream

DAY = dt.date(2023, 1, 1)
BATCH = "id long, name string, owner string, url string, created_at timestamp_ntz, alphabet_partition string, seq long"
ROW = {"url": "u", "created_at": None}


def repo_frame(spark, rows):
    """rows: (id, name, owner, partition)"""
    return spark.createDataFrame([(i, n, o, "u", None, p, f"{o}/{n}") for i, n, o, p in rows], REPO)


def batch_frame(spark, rows):
    """rows: (id, name, owner, partition), written in this order"""
    return spark.createDataFrame([(i, n, o, "u", None, p, seq) for seq, (i, n, o, p) in enumerate(rows)], BATCH)


def content(df):
    return {r.id: (r.name, r.owner, r.alphabet_partition, r.name_with_owner) for r in df.collect()}


TARGET = [(1, "old", "o", "matrix_0")]
WRITES = [(1, "new", "o", "matrix_1"), (1, "newer", "o", None), (2, "b", "p", "matrix_1")]


def test_policies(spark):
    target, batch = repo_frame(spark, TARGET), batch_frame(spark, WRITES)
    b = ("b", "p", "matrix_1")
    assert content(upsert.upsert_repo(target, batch, "keep_first")) == {1: ("old", "o", None, "o/old"), 2: (*b, "p/b")}
    plain = content(upsert.upsert_repo(target, batch, "keep_first", derive_name=False))
    assert plain == {1: ("old", "o", None, "o/newer"), 2: (*b, "p/b")}
    assert content(upsert.upsert_repo(target, batch, "overwrite")) == {1: ("newer", "o", "matrix_1", "o/newer"), 2: (*b, "p/b")}
    plain = content(upsert.upsert_repo(target, batch, "overwrite", derive_name=False))
    assert plain == {1: ("newer", "o", "matrix_1", "o/old"), 2: (*b, None)}
    with pytest.raises(ValueError):
        upsert.upsert_repo(target, batch, "merge")


def written_one_by_one(target, writes, policy):
    table = {i: (n, o, p, f"{o}/{n}") for i, n, o, p in target}
    for i, n, o, p in writes:
        if i not in table:
            table[i] = (n, o, p, f"{o}/{n}")
        elif policy == "keep_first":
            n, o = table[i][:2]
            table[i] = (n, o, p, f"{o}/{n}")
        else:
            table[i] = (n, o, p if p is not None else table[i][2], f"{o}/{n}")
    return table


labels = st.one_of(st.none(), st.sampled_from(["matrix_0", "matrix_1"]))
write = st.tuples(st.integers(1, 5), st.sampled_from("abc"), st.sampled_from("xy"), labels)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(write, max_size=4, unique_by=lambda w: w[0]), st.lists(write, max_size=12), st.sampled_from(upsert.POLICIES))
def test_upsert_equals_writing_one_by_one(spark, target, writes, policy):
    table, batch = repo_frame(spark, target), batch_frame(spark, writes)
    once = upsert.upsert_repo(table, batch, policy)
    expected = written_one_by_one(target, writes, policy)
    assert content(once) == expected
    assert content(upsert.upsert_repo(once, batch, policy)) == expected


def stats_frame(spark, rows):
    return spark.createDataFrame([(*row, seq) for seq, row in enumerate(rows)], "repo_id long, fetched_date date, stars int, seq long")


def test_stats_upsert(spark):
    first = stats_frame(spark, [(123, DAY, 100), (456, DAY, 0)])
    table = upsert.upsert_stats(empty(spark, STATS), first)
    again = upsert.upsert_stats(table, stats_frame(spark, [(123, DAY, 110), (123, DAY, 120), (7040, DAY, 1)]))
    assert {(r.repo_id, r.stars) for r in again.collect()} == {(123, 120), (456, 0), (7040, 1)}
    assert again.schema.simpleString() == STATS.simpleString()


def test_versions(spark, tmp_path):
    root = str(tmp_path / "repo")
    assert read_repo(spark, root).count() == 0
    assert store_repo(batch_frame(spark, WRITES[:2]), root) == 1
    assert store_repo(batch_frame(spark, WRITES[2:]), root) == 2
    assert content(read_repo(spark, root)) == {1: ("new", "o", None, "o/new"), 2: ("b", "p", "matrix_1", "p/b")}
    # A write that did not finish is not read, and the next one takes its place.
    repo_frame(spark, [(9, "half", "x", None)]).write.parquet(version_path(root, 3))
    (tmp_path / "repo" / "version-0000000003" / "_SUCCESS").unlink()
    assert versions(spark, root) == [1, 2] and 9 not in content(read_repo(spark, root))
    assert publish_repo(repo_frame(spark, TARGET), root) == 3
    assert content(read_repo(spark, root)) == {1: ("old", "o", "matrix_0", "o/old")}
    drop_versions(spark, root, keep=1)
    assert versions(spark, root) == [3]
    with pytest.raises(ValueError):
        drop_versions(spark, root, keep=0)


def test_older_version_gets_late_columns(spark, tmp_path):
    root = str(tmp_path / "repo")
    repo_frame(spark, TARGET).drop("alphabet_partition", "name_with_owner").write.parquet(version_path(root, 1))
    table = read_repo(spark, root)
    assert content(table) == {1: ("old", "o", None, None)}
    assert table.schema["name_with_owner"].metadata["comment"]
    assert content(upsert.backfill_name(table)) == {1: ("old", "o", None, "o/old")}
    assert upsert.backfill_name(table.drop("name_with_owner")).first().name_with_owner == "o/old"


def test_stats_days(spark, tmp_path):
    root, other = str(tmp_path / "stats"), dt.date(2023, 1, 2)
    store_stats(stats_frame(spark, [(1, DAY, 5), (1, other, 6), (2, DAY, 7)]), root)
    untouched = sorted((tmp_path / "stats" / "fetched_date=2023-01-02").iterdir())
    store_stats(stats_frame(spark, [(1, DAY, 50), (3, DAY, 8)]), root, dates=[DAY])
    store_stats(stats_frame(spark, []), root)
    got = {(r.repo_id, r.fetched_date.day): r.stars for r in read_stats(spark, root).collect()}
    assert got == {(1, 1): 50, (1, 2): 6, (2, 1): 7, (3, 1): 8}
    assert sorted((tmp_path / "stats" / "fetched_date=2023-01-02").iterdir()) == untouched
    plan = read_stats(spark, root).filter(F.col("fetched_date") == F.lit(DAY))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetched_date" in plan


def test_parents_and_cascade(spark):
    repo = repo_frame(spark, [(1, "a", "x", None), (2, "b", "x", None)])
    stats = stats_frame(spark, [(1, DAY, 1), (2, DAY, 2), (3, DAY, 3)]).drop("seq")
    assert [r.repo_id for r in upsert.orphans(stats, repo).collect()] == [3]
    assert sorted(r.repo_id for r in upsert.with_parent(stats, repo).collect()) == [1, 2]
    left, facts = upsert.delete_repos(repo, stats, spark.createDataFrame([(1,)], "id long"))
    assert [r.id for r in left.collect()] == [2]
    assert sorted(r.repo_id for r in facts.collect()) == [2, 3]
    assert [r.id for r in upsert.not_seen(repo, spark.createDataFrame([(2,)], "id long")).collect()] == [1]


def test_metrics(spark):
    rows = spark.createDataFrame([("heron", 100), ("egret", 50), ("heron", 200)], "owner string, stars long")
    got = measure.crawl_metrics(rows, target=5).first()
    assert (got.rows, got.unique_owners, got.total_stars, round(got.average_stars, 2), got.success_rate, got.shortfall) == (3, 2, 350, 116.67, 1.0, 2)
    assert measure.crawl_metrics(rows, total_found=6).first().success_rate == 0.5
    assert measure.crawl_metrics(rows, total_found=0).first().success_rate == 0.0
    none = measure.crawl_metrics(rows.limit(0)).first()
    assert (none.rows, none.unique_owners, none.total_stars, none.average_stars, none.success_rate) == (0, 0, 0, 0.0, 0.0)
    many = spark.range(1, 1001).selectExpr("concat('user-', id % 100) AS owner", "id % 1000 AS stars")
    got = measure.crawl_metrics(many).first()
    assert (got.unique_owners, got.total_stars, got.average_stars, got.shortfall) == (100, 499500, 499.5, 3000)


def test_consolidation(spark):
    a = spark.createDataFrame([(0, 1, "a"), (0, 2, "b")], "job int, id long, name string")
    b = spark.createDataFrame([(1, 2, "c"), (1, 3, "d"), (1, 3, "d")], "job int, id long, name string")
    assert sorted((r.id, r.name) for r in combine.consolidate([b, a]).collect()) == [(1, "a"), (2, "b"), (3, "d")]
    both = a.unionByName(b)
    assert [(r.id, r.jobs) for r in combine.overlap(both).collect()] == [(2, 2)]
    assert sorted((r.id, r.job) for r in combine.exclusive(both).collect()) == [(1, 0), (3, 1)]
    assert [r.id for r in combine.in_both(a, b).collect()] == [2]
    assert sorted(r.id for r in combine.only_left(b, a).collect()) == [3, 3]
    report = measure.dedup_report(both).first()
    assert (report.total_rows, report.unique_rows, report.duplicates_skipped, report.overlap_rate) == (5, 3, 2, 0.4)
    nothing = measure.dedup_report(both.limit(0)).first()
    assert (nothing.total_rows, nothing.overlap_rate) == (0, 0.0)


def test_history(spark):
    stats = stats_frame(spark, [(1, DAY, 5), (1, dt.date(2023, 1, 4), 9), (2, DAY, 1)]).drop("seq")
    assert sorted((r.repo_id, r.fetched_date.day, r.stars) for r in history.latest_stats(stats).collect()) == [(1, 4, 9), (2, 1, 1)]
    got = sorted((r.repo_id, r.fetched_date.day, r.star_change, r.days) for r in history.star_growth(stats).collect())
    assert got == [(1, 1, None, None), (1, 4, 4, 3), (2, 1, None, None)]


def test_export(spark, tmp_path):
    repo = spark.createDataFrame([(1, "re,act", "fb", "u", dt.datetime(2013, 5, 24, 16, 15, 54), None, None)], REPO)
    view = combine.export_view(repo, stats_frame(spark, [(1, DAY, 7)]))
    export_csv(view, str(tmp_path / "out"))
    export_csv(view, str(tmp_path / "out"), files=1)
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text().splitlines() == [
        "id,name,name_with_owner,url,created_at,stars,crawled_at",
        '1,"re,act","fb/re,act",u,2013-05-24 16:15:54,7,2023-01-01',
    ]


def test_job_and_bad_outputs(spark, tmp_path):
    write_jobs(repo_frame(spark, [(1, "a", "x", "matrix_0"), (2, "b", "x", "matrix_1")]), str(tmp_path / "jobs"))
    assert sorted(p.name for p in (tmp_path / "jobs").glob("alphabet*")) == ["alphabet_partition=matrix_0", "alphabet_partition=matrix_1"]
    bad = spark.createDataFrame([(1, "r")], "id long, reason string")
    for label in ("a", "a", "b"):
        write_bad(bad, str(tmp_path / "bad"), label)
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_conform_casts(spark):
    assert conform(spark.createDataFrame([(1, 5)], "repo_id int, stars long"), STATS).first().asDict() == {"repo_id": 1, "fetched_date": None, "stars": 5}


RECORDS = (
    "job int, query_idx int, page_idx int, pos int, id long, name string, owner string, url string, stars long, created_at timestamp_ntz"
)


def test_load(spark, tmp_path):
    roots = Roots(*(str(tmp_path / name) for name in ("repo", "stats", "bad")))
    rows = [(0, 0, 0, 0, 1, "a", "x", "u", 5, None), (1, 0, 0, 0, 1, "a", "x", "u", 6, None), (1, 0, 0, 1, 2, "", "x", "u", 6, None)]
    for _ in range(2):
        loaded = load_records(spark.createDataFrame(rows, RECORDS), roots, DAY, label="run")
        assert {r.outcome: r.rows for r in loaded.report.collect()} == {"stored": 2, "name_or_owner_empty": 1}
        assert sorted((r.job, r.rows, r.total_stars, r.shortfall) for r in loaded.metrics.collect()) == [(0, 1, 5, 3999), (1, 1, 6, 3999)]
        assert content(read_repo(spark, roots.repo)) == {1: ("a", "x", "matrix_1", "x/a")}
        assert [(r.repo_id, r.stars) for r in read_stats(spark, roots.stats).collect()] == [(1, 6)]
        assert spark.read.parquet(roots.bad).count() == 1


@pytest.mark.parametrize("kept", ["versions", "buckets"])
def test_loads_leave_nothing_in_the_shared_folder(spark, tmp_path, kept):
    roots = Roots(*(str(tmp_path / name) for name in ("repo", "stats", "bad")))
    shared = Path(scratch_dir(spark))

    def folders():
        return {f.name for f in shared.iterdir()} if shared.exists() else set()

    if kept == "versions":
        publish_repo(empty(spark, REPO), roots.repo)
    before = folders()
    for stars in range(4):
        loaded = load_records(spark.createDataFrame([(0, 0, 0, 0, 1, "a", "x", "u", stars, None)], RECORDS), roots, DAY, label="run")
        assert {name.split("-")[0] for name in folders() - before} == {"records"}
        assert loaded.report.first().rows == 1
        loaded.release()
        assert folders() == before
    delete_stored(spark.createDataFrame([(1,)], "id long"), roots.repo, roots.stats)
    assert folders() == before
    assert len(versions(spark, roots.repo)) == (3 if kept == "versions" else 0)
    assert read_repo(spark, roots.repo).count() == 0 and read_stats(spark, roots.stats).count() == 0


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    def land(name, ids, status=200):
        nodes = [{"databaseId": i, "name": f"n{i}", "owner": {"login": "o"}, "url": "u", "stargazerCount": i * 10} for i in ids]
        search = {"nodes": nodes, "pageInfo": {"hasNextPage": False}, "repositoryCount": 1}
        line = {"http_status": status, "job": int(name), "query_idx": 0, "page_idx": 0, "attempt": 0}
        line["body"] = {"data": {"search": search, "rateLimit": {"remaining": 1}}}
        (tmp_path / "landing" / f"{name}.json").write_text(json.dumps(line))

    (tmp_path / "landing").mkdir()
    roots = Roots(*(str(tmp_path / name) for name in ("repo", "stats", "bad")))

    def run():
        ingest_stream(spark, str(tmp_path / "landing"), roots, str(tmp_path / "cp"), DAY, max_files=1).awaitTermination()
        return sorted((r.id, r.alphabet_partition) for r in read_repo(spark, roots.repo).collect())

    land("0", [1, 2])
    land("2", [9], status=502)
    assert run() == [(1, "matrix_0"), (2, "matrix_0")]
    before = {p: p.stat().st_mtime_ns for p in Path(roots.repo).rglob("*")}
    assert run() == [(1, "matrix_0"), (2, "matrix_0")]
    assert {p: p.stat().st_mtime_ns for p in Path(roots.repo).rglob("*")} == before
    land("1", [2, 3])
    assert run() == [(1, "matrix_0"), (2, "matrix_1"), (3, "matrix_1")]
    assert sorted((r.repo_id, r.stars) for r in read_stats(spark, roots.stats).collect()) == [(1, 10), (2, 20), (3, 30)]


@pytest.mark.parametrize("max_files", [1, 2, 1000])
def test_stream_does_not_depend_on_its_batches(spark, tmp_path, max_files):
    (tmp_path / "landing").mkdir()
    for at, (job, label) in enumerate([(5, "late"), (1, "early"), (3, "middle")]):
        nodes = [{"databaseId": 71, "name": label, "owner": {"login": "o"}, "url": "u", "stargazerCount": job}, {"databaseId": 80 + job, "name": "", "owner": {"login": "o"}, "url": "u", "stargazerCount": 1}]
        search = {"nodes": nodes, "pageInfo": {"hasNextPage": False}, "repositoryCount": 1}
        line = {"http_status": 200, "job": job, "query_idx": 0, "page_idx": 0, "attempt": 0, "body": {"data": {"search": search, "rateLimit": {"remaining": 1}}}}
        (tmp_path / "landing" / f"{at}.json").write_text(json.dumps(line))
    roots = Roots(*(str(tmp_path / name) for name in ("repo", "stats", "bad")))
    ingest_stream(spark, str(tmp_path / "landing"), roots, str(tmp_path / "cp"), DAY, max_files=max_files).awaitTermination()
    assert [(r.id, r.name) for r in read_repo(spark, roots.repo).collect()] == [(71, "early")]
    assert [r.stars for r in read_stats(spark, roots.stats).collect()] == [5]
    rejected = spark.read.parquet(roots.bad)
    assert sorted(r.id for r in rejected.collect()) == [81, 83, 85] and rejected.where("reason is null").count() == 0


def test_days_of_qualifiers_are_whole(spark):
    times = ["2016-12-30 23:59:59", "2016-12-31 00:00:01", "2016-12-31 23:59:59.5", "2017-01-01 00:00:00"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"), F.col("t").cast("date").alias("d"))
    last = dt.date(2016, 12, 31)
    for spec, expected in (((None, last), 3), ((last, last), 2), ({">": last}, 1), ({"<": last}, 1), ((last, None), 3)):
        for column in ("t", "d"):
            assert qualify(rows, {"created": spec}, {"created": column}).count() == expected


def test_csv_reads_back_and_jobs_stay(spark, tmp_path):
    names = ['a "quoted", name', "line\nbreak", "back\\slash"]
    frame = repo_frame(spark, [(i, n, "o", f"matrix_{i}") for i, n in enumerate(names)])
    stats = spark.createDataFrame([(i, DAY, 1) for i in range(3)], "repo_id long, fetched_date date, stars int")
    export_csv(export_view(frame, stats), str(tmp_path / "csv"), files=1)
    (file,) = (tmp_path / "csv").glob("part-*.csv")
    with file.open(newline="") as lines:
        assert sorted(row["name"] for row in csv.DictReader(lines)) == sorted(names)
    for i in range(3):
        write_jobs(frame.where(F.col("id") == i), str(tmp_path / "jobs"))
    assert spark.read.parquet(str(tmp_path / "jobs")).count() == 3


def test_star_counts_out_of_range_are_rejected(spark):
    stats = stats_from_records(spark.createDataFrame([(1, "2024-01-01", 3_000_000_000), (2, "2024-01-01", 5)], "repoId long, fetched_date string, stars long"))
    assert {r.repo_id: r.stars for r in stats.collect()} == {1: None, 2: 5}


def test_left_over_copies(spark, monkeypatch):
    monkeypatch.setattr(combine, "COPIES", 3)
    left = spark.createDataFrame([(v,) for v in [1] * 8 + [2] * 3 + [None] * 4 + [5]], "id int")
    right = spark.createDataFrame([(v,) for v in [1, 2, 2, 2, 2, None, 7]], "id int")
    got = [r.id for r in combine.only_left(left, right).collect()]
    assert sorted(got, key=str) == [1] * 7 + [5] + [None] * 3
    assert combine.only_left(left.limit(0), right).count() == 0


def test_delete_from_the_stored_tables(spark, tmp_path):
    repo, stats = str(tmp_path / "repo"), str(tmp_path / "stats")
    publish_repo(repo_frame(spark, [(i, "n", "o", "matrix_0") for i in (1, 2, 3)]), repo)
    days = [DAY, DAY + dt.timedelta(1), DAY + dt.timedelta(2)]
    store_stats(spark.createDataFrame([(1, days[0], 5, 0), (2, days[0], 6, 0), (1, days[1], 7, 0), (3, days[2], 8, 0)], "repo_id long, fetched_date date, stars int, seq int"), stats)
    for _ in range(2):
        delete_stored(spark.createDataFrame([(1,), (1,), (9,)], "id long"), repo, stats)
        assert sorted(r.id for r in read_repo(spark, repo).collect()) == [2, 3]
        assert sorted((r.repo_id, r.fetched_date) for r in read_stats(spark, stats).collect()) == [(2, days[0]), (3, days[2])]
