"""Rejected rows taken again, and ids that a stream tells once."""

from __future__ import annotations

import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import table_checks
from checks.catalog import Tables
from harvest.plans import load
from harvest.plans.load import Roots, load_records
from harvest.plans.readmit import read_bad, readmit
from harvest.sources.pages import read_pages
from harvest.sources.scratch import CLEANUP, scratch_dir
from harvest.sources.tables import read_repo, read_stats
from harvest.streaming.ingest import ingest_stream, page_records
from harvest.streaming.sightings import late_rows, stream_sightings
from test_pages import body, node
from test_stored import files_of
from test_tables import DAY, RECORDS


def record(job, id, name="a", stars=5):
    return (job, 0, 0, id, id, name, "x", "u", stars, None)


@pytest.fixture
def roots(tmp_path):
    return Roots(*(str(tmp_path / name) for name in ("repo", "stats", "bad")))


def stored(spark, roots):
    return sorted((r.id, r.name, r.alphabet_partition) for r in read_repo(spark, roots.repo).collect())


def rejected(spark, roots):
    return sorted((r.load, r.id, r.reason) for r in read_bad(spark, roots.bad).collect())


@pytest.mark.parametrize(("policy", "name"), [("keep_first", "first"), ("overwrite", "second")])
def test_rows_that_were_too_wide_are_taken_again(spark, tmp_path, roots, policy, name):
    def load(label, *rows):
        load_records(spark.createDataFrame(list(rows), RECORDS), roots, DAY, label=label, width=10).release()

    load("5", record(1, 1), record(9999, 2, "second"), record(9998, 2, "first"), record(9999, 3, ""), record(9999, 4, stars=1 << 40))
    load("a/b: c", record(9999, 6))
    load("not touched", record(1, 7, ""))
    assert stored(spark, roots) == [(1, "a", "matrix_1")]
    quiet = {p: t for p, t in files_of(tmp_path / "bad").items() if "not touched" in p}
    assert readmit(spark, roots, DAY, policy) == ["5", "a/b: c"]
    assert stored(spark, roots) == [(1, "a", "matrix_1"), (2, name, "matrix_9999"), (6, "a", "matrix_9999")]
    assert sorted((r.repo_id, r.fetched_date, r.stars) for r in read_stats(spark, roots.stats).collect()) == [(i, DAY, 5) for i in (1, 2, 6)]
    left = [("5", 3, "name_or_owner_empty"), ("5", 4, "stars_out_of_range"), ("not touched", 7, "name_or_owner_empty")]
    assert rejected(spark, roots) == left
    files = files_of(tmp_path)
    assert quiet and {p: t for p, t in files.items() if "not touched" in p} == quiet
    assert readmit(spark, roots, DAY, policy) == [] and files_of(tmp_path) == files


def test_reasons_without_their_text_stay(spark, tmp_path, roots):
    assert readmit(spark, roots, DAY) == [] and read_bad(spark, roots.bad) is None
    rows = spark.createDataFrame([record(1, 1), record(1, 2)], RECORDS).withColumn("reason", F.lit("created_at_invalid"))
    load_records(rows, roots, DAY, label="one").release()
    load_records(rows.limit(0), roots, DAY, label="none").release()
    assert readmit(spark, roots, DAY) == []
    assert rejected(spark, roots) == [("one", 1, "created_at_invalid"), ("one", 2, "created_at_invalid")]


def land(folder, at, day, ids, job=0, status=200):
    """A file of one page; files are taken in the order of their time."""
    folder.mkdir(exist_ok=True)
    line = {"http_status": status, "fetched_date": day, "job": job, "query_idx": 0, "page_idx": at, "attempt": 0, "body": body([node(i) for i in ids])}
    (folder / f"{at}.json").write_text(json.dumps(line))
    os.utime(folder / f"{at}.json", (1_700_000_000 + at * 10,) * 2)


def told(spark, out):
    return sorted((r.job, r.id) for r in spark.read.parquet(out).collect())


def test_ids_are_told_once(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    land(landing, 0, "2024-01-01", [1, 2, 2, 0])
    land(landing, 1, "2023-01-01", [2, 3])
    land(landing, 2, "2024-01-01", [2], job=1)
    land(landing, 3, "2024-01-01", [8], status=502)

    def run():
        query = stream_sightings(spark, str(landing), out, checkpoint, max_files=1)
        query.awaitTermination()
        return late_rows(query)

    expected = [(0, 1), (0, 2), (0, 3), (1, 2)]
    for _ in range(2):
        assert run() == 0 and told(spark, out) == expected
    land(landing, 4, "2022-01-01", [1, 4])
    assert run() == 0 and told(spark, out) == sorted([*expected, (0, 4)])


def test_late_rows_and_ids_of_long_ago(spark, tmp_path):
    """Ids 1 and 2 on day 1; 1 again on day 10, still known; a page of day 2 is late two batches on; on day 11 id 1 is told again."""
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    for at, (day, ids) in enumerate([(1, [1, 2]), (10, [3, 1]), (10, [3]), (2, [4]), (11, [1, 3])]):
        land(landing, at, dt.date(2024, 1, day).isoformat(), ids)
    query = stream_sightings(spark, str(landing), out, str(tmp_path / "checkpoint"), ("id",), F.col("fetched_date"), "3 days", max_files=1)
    query.awaitTermination()
    assert sorted((r.id, r.arrived.day) for r in spark.read.parquet(out).collect()) == [(1, 1), (1, 11), (2, 1), (3, 10)]
    assert late_rows(query) == 1


def test_state_of_the_stream_commits_changes_only(spark, tmp_path):
    land(tmp_path / "landing", 0, "2024-01-01", [1, 9])
    land(tmp_path / "landing", 1, "2024-01-01", [2, 9])
    stream_sightings(spark, str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "cp"), max_files=1).awaitTermination()
    assert told(spark, str(tmp_path / "out")) == [(0, 1), (0, 2), (0, 9)]
    assert list(tmp_path.glob("cp/state/0/*/*.changelog"))
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", None) is None


def test_a_batch_is_read_once(spark, tmp_path):
    land(tmp_path / "landing", 0, "2024-01-01", [1, 0])
    land(tmp_path / "landing", 1, "2024-01-01", [8], status=502)
    land(tmp_path / "landing", 2, "2024-01-01", [])
    (tmp_path / "landing" / "3.json").write_text("no json")
    rows = page_records(read_pages(spark, str(tmp_path / "landing")))
    found = {(r.page_idx, r.pos, r.reason, r.id, r.raw) for r in rows.collect()}
    assert found == {(0, 0, None, 1, None), (0, 1, "id_not_positive", 0, None), (1, None, "page_server_error", None, None), (None, None, "page_malformed", None, "no json")}
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1


def test_landed_files_do_not_grow_with_the_partitions(spark):
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no generated tables here")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        landing = table_checks._landing(Tables(spark, folder))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(spark.read.text(landing).inputFiles()) <= 12


def test_landed_text_does_not_grow_with_the_pages(spark, tmp_path, monkeypatch):
    """30 files of pages land 10 at a time and go when they are taken; the tables are those of pages that land at once."""
    kinds = ["view", "error", "signup", "click", "purchase", None]
    rows = [(i % 55 if i != 7 else None, kinds[i % 6], float(i * 3 % 70) if i % 9 else None, json.dumps({"k": i % 120})) for i in range(60)]
    frame = spark.createDataFrame(rows, "event_id long, event_type string, value double, props string")
    frame.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    shared, seen = Path(scratch_dir(spark).removeprefix("file:")), []

    def watched(spark, landing, *args, **more):
        files = [f for f in Path(landing).glob("part-*")]
        seen.append((len(files), sum(len(f.read_text().splitlines()) for f in files)))
        return ingest_stream(spark, landing, *args, **more)

    def run():
        seen.clear()
        return sorted(map(str, table_checks.stream_ingest(Tables(spark, str(tmp_path))).collect())), list(seen)

    def left():
        return {p.name for label in ("landing", "events", "records") for p in shared.glob(f"{label}-*")}

    monkeypatch.setattr(table_checks, "ingest_stream", watched)
    before, (expected, whole) = left(), run()
    monkeypatch.setattr(table_checks, "EVENTS_IN_FILE", 2)
    found, parts = run()
    assert expected and found == expected
    assert len(whole) == 1 and len(parts) == 3 and max(files for files, _ in parts) <= 10
    assert sum(lines for _, lines in parts) == whole[0][1] and max(lines for _, lines in parts) < whole[0][1] / 2
    assert left() == before


def test_the_stream_keeps_its_rows_once(spark, tmp_path, roots, monkeypatch):
    land(tmp_path / "landing", 0, None, [1, 2, 0])
    land(tmp_path / "landing", 1, None, [8], status=502)
    shared, store, seen = Path(scratch_dir(spark).removeprefix("file:")), load.store_good, []

    def watched(good, *args):
        seen.append((set(shared.glob("records-*")), spark.conf.get(CLEANUP, None)))
        store(good, *args)

    monkeypatch.setattr(load, "store_good", watched)
    before = set(shared.glob("records-*"))
    ingest_stream(spark, str(tmp_path / "landing"), roots, str(tmp_path / "cp"), DAY, max_files=1).awaitTermination()
    assert seen == [(before, "true")]
    assert stored(spark, roots) == [(1, "n1", "matrix_0"), (2, "n2", "matrix_0")]
    assert sorted((-1 if r.id is None else r.id, r.reason) for r in read_bad(spark, roots.bad).collect()) == [(-1, "page_server_error"), (0, "id_not_positive")]
    assert [r.fetched_date for r in read_stats(spark, roots.stats).collect()] == [DAY, DAY]
