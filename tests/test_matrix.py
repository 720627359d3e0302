from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harvest.operators.coverage import coverage, coverage_counts, license_key, uncovered
from harvest.operators.measure import matrix_report, query_terms
from harvest.operators.records import check_query
from harvest.sources import matrix_values as v
from harvest.sources.matrix import bounds, queries_for, query_matrix


def test_list_sizes():
    assert [len(x) for x in (v.LANGUAGES, v.STAR_BANDS, v.DATE_BANDS, v.SIZE_BANDS, v.LICENSES, v.TOPICS, v.SPECIALS)] == [56, 80, 32, 8, 8, 30, 15]
    assert [len(x) for x in (v.COARSE_LANGUAGES, v.COARSE_STAR_BANDS, v.COARSE_DATE_BANDS, v.COARSE_TOPICS, v.COARSE_SPECIALS)] == [41, 25, 10, 20, 8]


@pytest.mark.parametrize(
    "bands, kind, step",
    [
        (v.STAR_BANDS, int, 1),
        (v.COARSE_STAR_BANDS, int, 1),
        (v.SIZE_BANDS, int, 1),
        (v.DATE_BANDS, dt.date.fromisoformat, dt.timedelta(1)),
        (v.COARSE_DATE_BANDS, dt.date.fromisoformat, dt.timedelta(1)),
    ],
)
def test_bands_have_no_gap_and_no_overlap(bands, kind, step):
    ends = sorted((bounds(b, kind) for b in bands), key=lambda e: (e[0] is not None, e[0] or 0))
    assert all(high + step == low for (_, high), (low, _) in zip(ends, ends[1:]))


def texts(df):
    return [r.query_string for r in df.orderBy("job", "query_idx").collect()]


def test_single_job(spark):
    fine, coarse = query_matrix(spark, 1), query_matrix(spark, 1, "coarse")
    assert texts(fine)[0] == "is:public stars:0..2 sort:updated" and fine.count() == 5
    assert texts(coarse)[-1] == "is:public stars:>200 sort:stars" and coarse.count() == 4
    assert all("is:public" in t and "sort:" in t for t in texts(fine) + texts(coarse))


def test_first_jobs(spark):
    rows = query_matrix(spark, 200).filter("job < 6").orderBy("job", "query_idx").collect()
    assert [(r.job, r.query_idx, r.query_string, r.description, r.expected_results) for r in rows] == [
        (0, 0, "is:public language:javascript stars:0..0 fork:false archived:false sort:updated", "Lang+Stars: javascript, 0..0 stars", 900),
        (0, 1, "is:public language:javascript stars:0..0 sort:stars", "Fallback: javascript, 0..0 stars", 800),
        (1, 0, "is:public created:2024-11-01..2024-11-30 stars:0..0 fork:false sort:updated", "Time+Stars: 2024-11-01..2024-11-30, 0..0 stars", 900),
        (1, 1, "is:public created:2024-11-01..2024-11-30 stars:0..0 sort:stars", "Time fallback: 2024-11-01..2024-11-30", 800),
        (2, 0, "is:public size:16..50 language:javascript stars:0..0 sort:updated", "Size+Lang+Stars: 16..50KB, javascript, 0..0 stars", 900),
        (2, 1, "is:public size:16..50 stars:0..0 sort:updated", "Size fallback: 16..50KB", 800),
        (3, 0, "is:public topic:library stars:0..0 fork:false sort:updated", "Topic+Stars: library, 0..0 stars", 900),
        (3, 1, "is:public topic:library sort:stars", "Topic fallback: library", 800),
        (4, 0, "is:public license:bsd-3-clause language:javascript stars:0..0 sort:updated", "License+Lang: bsd-3-clause, javascript, 0..0 stars", 900),
        (4, 1, "is:public license:bsd-3-clause stars:0..0 sort:stars", "License fallback: bsd-3-clause", 800),
        (5, 0, "is:public pushed:>2024-06-01 stars:0..2 sort:updated", "Special 5: Recently pushed, 0-2 stars", 900),
    ]
    first = rows[0]
    assert (first.strategy, first.language, first.star_lo, first.star_hi, first.created_lo) == ("language", "javascript", 0, 0, None)
    assert (rows[5].language, rows[5].size_lo, rows[5].size_hi) == (None, 16, 50)


def test_coarse_jobs(spark):
    rows = query_matrix(spark, 10, "coarse").filter("job IN (1, 3)").orderBy("job", "query_idx").collect()
    assert [(r.query_string, r.description, r.expected_results) for r in rows] == [
        ("is:public created:2024-01-01..2024-05-31 stars:0..2 sort:updated", "Job 1 - Time+Stars: 2024-01-01..2024-05-31, 0..2 stars", 400),
        ("is:public created:2024-01-01..2024-05-31 stars:0..2 sort:stars", "Fallback 1 for job 1", 300),
        ("is:public stars:0..2 created:2024-01-01..2024-05-31 fork:false sort:updated", "Fallback 2 for job 1", 300),
        ("is:public pushed:>2024-01-01 stars:1..15 sort:updated", "Job 3 - Special: Recently active", 400),
        ("is:public stars:1..25 sort:updated", "Fallback 1 for job 3", 300),
        ("is:public sort:updated", "Fallback 2 for job 3", 300),
    ]


def test_reach_of_200_jobs(spark):
    fine, coarse = query_matrix(spark, 200), query_matrix(spark, 200, "coarse")
    assert (fine.count(), coarse.count()) == (367, 600)
    assert (matrix_report(fine).count(), matrix_report(coarse).count()) == (172, 152)
    special = matrix_report(fine.filter("strategy = 'special'"))
    assert (special.count(), special.agg(F.sum("jobs")).first()[0]) == (5, 33)
    reached = {(r.strategy, r.star_lo) for r in fine.filter("query_idx = 0 AND strategy != 'special'").collect()}
    for strategy, last in (("language", 3), ("created", 6), ("topic", 6), ("size", 0), ("license", 0)):
        assert {low for name, low in reached if name == strategy} == set(range(last + 1))


def test_edges(spark):
    jobs = spark.createDataFrame([(99,), (9999999999,)], "job long")
    assert check_query(queries_for(jobs)).bad.count() == 0
    assert {r.job for r in queries_for(jobs).collect()} == {99, 9999999999}
    with pytest.raises(ValueError):
        query_matrix(spark, 10, "medium")


def test_terms(spark):
    terms = query_terms(query_matrix(spark, 10))
    counts = {r.term: r["count"] for r in terms.groupBy("term").count().collect()}
    assert counts["language"] > 1 and counts["stars"] >= 1
    queries = spark.createDataFrame([("is:public language:c++ stars:>45350",), ("language:c++",), ("is:public",)], "query_string string")
    assert {(r.term, r.value, r.queries) for r in query_terms(queries).collect()} == {("language", "c++", 2), ("stars", ">45350", 1)}


def test_coverage_of_every_strategy(spark):
    repos = spark.createDataFrame(
        [
            (1, "JavaScript", 0, dt.datetime(2024, 11, 5), 20, "BSD 3-Clause \"New\" or \"Revised\" License", ["library", "other", "library"]),
            (2, "Brainfuck", 99999, dt.datetime(2026, 2, 1), 9999999, "MIT License", []),
            (3, None, None, None, None, None, None),
        ],
        "id long, language string, stars long, created_at timestamp_ntz, size long, license string, topics array<string>",
    ).withColumn("key", license_key(F.col("license")))
    matrix = query_matrix(spark, 6)
    columns = {"language": "language", "stars": "stars", "created": "created_at", "size": "size", "license": "key", "topic": "topics"}
    primary = {r.query_string for r in matrix.filter("query_idx = 0 AND strategy != 'special'").collect()}
    assert {(r.id, r.query_string) for r in coverage(repos, matrix, columns).collect()} == {(1, q) for q in primary}
    assert coverage(repos, matrix, columns).count() == 5
    assert sorted(r.id for r in uncovered(repos, matrix, columns).collect()) == [2, 3]
    counts = {r.query_string: r.repos for r in coverage_counts(repos, matrix, columns).collect()}
    assert len(counts) == 6 and sum(counts.values()) == 5
    with pytest.raises(ValueError):
        coverage(repos, matrix, {"language": "language"})


@pytest.mark.parametrize("scheme, bands", [("fine", v.STAR_BANDS), ("coarse", v.COARSE_STAR_BANDS)])
def test_bands_equal_a_range_join(spark, scheme, bands):
    from harvest.operators.coverage import band_of

    edges = sorted({x + d for band in bands for x in bounds(band) if x is not None for d in (-1, 0, 1)})
    rows = spark.createDataFrame([(x,) for x in edges], "x long")
    got = {r.x: r.band for r in rows.select("x", band_of("x", bands).alias("band")).collect()}
    for x in edges:
        inside = [b for b in bands if (bounds(b)[0] is None or x >= bounds(b)[0]) and (bounds(b)[1] is None or x <= bounds(b)[1])]
        assert got[x] == (inside[0] if inside else None)


def test_bounds_of_fixed_texts(spark):
    fine = {r.query_string: r for r in query_matrix(spark, 200).collect()}
    small = fine["is:public size:<100 stars:1..8 sort:updated"]
    assert (small.star_lo, small.star_hi, small.size_lo, small.size_hi) == (1, 8, None, 99)
    recent = fine["is:public pushed:>2024-06-01 stars:0..2 sort:updated"]
    assert (str(recent.pushed_lo), recent.pushed_hi, recent.star_hi) == ("2024-06-02", None, 2)
    coarse = {r.query_string: r for r in query_matrix(spark, 200, "coarse").collect()}
    fallback, recent = coarse["is:public stars:1..25 sort:updated"], coarse["is:public pushed:>2024-01-01 stars:1..15 sort:updated"]
    assert (fallback.star_lo, fallback.star_hi, str(recent.pushed_lo), recent.star_hi) == (1, 25, "2024-01-02", 15)
    for scheme in ("fine", "coarse"):
        assert query_matrix(spark, 1, scheme).dtypes == query_matrix(spark, 2, scheme).dtypes
