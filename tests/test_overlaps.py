"""Overlap of jobs from kept bitmaps, against plain sets."""

from __future__ import annotations

import shutil
from itertools import combinations

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from harvest.operators.overlaps import id_words, job_overlaps, read_words, sightings_report, store_words

ROWS = "job long, id long"
EDGES = [0, 1, 63, 64, 65, -1, -63, -64, -65, 1 << 40, (1 << 63) - 1, -(1 << 63)]


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def expected(rows):
    jobs = {}
    for job, id in rows:
        if job is not None and id is not None:
            jobs.setdefault(job, set()).add(id)
    pairs = {(a, b, len(jobs[a] & jobs[b]), len(jobs[a]), len(jobs[b])) for a, b in combinations(sorted(jobs), 2) if jobs[a] & jobs[b]}
    return pairs, sum(map(len, jobs.values())), len(set().union(*jobs.values())) if jobs else 0


def found(words):
    report = sightings_report(words).first()
    assert report.duplicates_skipped == report.total_rows - report.unique_rows
    return {tuple(r) for r in job_overlaps(words).collect()}, report.total_rows, report.unique_rows


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-1, 4)), st.one_of(st.none(), st.sampled_from(EDGES), st.integers(-200, 200))), max_size=60))
def test_overlaps_equal_sets(spark, rows):
    assert found(id_words(frame(spark, rows))) == expected(rows)


def test_loads_merge_without_their_old_rows(spark, tmp_path):
    root, first = str(tmp_path / "words"), tmp_path / "first"
    assert found(read_words(spark, root)) == (set(), 0, 0)
    early = [(j, i) for j in (1, 2) for i in range(j, 300, j)] + [(1, e) for e in EDGES]
    late = [(j, i) for j in (2, 3) for i in range(150, 450, j)] + [(3, 1 << 40), (None, 5), (4, None)]
    frame(spark, early).write.parquet(str(first))
    store_words(spark.read.parquet(str(first)), root, "one")
    shutil.rmtree(first)
    for _ in range(2):  # loading again changes nothing
        store_words(frame(spark, late), root, "two")
        assert found(read_words(spark, root)) == expected(early + late)
    store_words(frame(spark, late[:50]), root, "two")
    assert found(read_words(spark, root)) == expected(early + late[:50])


def test_repeats_fold_and_jobs_meet_by_an_equi_join(spark):
    # One id is two thirds of all rows; every job finds it.
    hot = spark.range(60_000).select((F.col("id") % 20).alias("job"), F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("id"))
    words = id_words(hot)
    assert words.filter("word = 0").count() == 20
    pairs = job_overlaps(words)
    assert pairs.count() == 190 and pairs.filter("shared < 1").count() == 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
