"""Harvest tables: parse, validate, replay, de-duplicate, upsert, consolidate and measure search-API pages with Spark."""

from harvest.functions.names import owner_slash_name, with_fetched, with_name, with_partition
from harvest.functions.qualifiers import predicate, qualify
from harvest.functions.timestamps import parse_ts
from harvest.operators.bands import free_coverage, predicate_coverage, special_coverage
from harvest.operators.combine import consolidate, distinct_values, exclusive, export_view, in_both, only_left, overlap
from harvest.operators.coverage import coverage, coverage_counts, license_key, single_job_counts, uncovered
from harvest.operators.history import latest_stats, star_growth
from harvest.operators.measure import crawl_metrics, dedup_report, load_report, matrix_report, page_yield, query_terms
from harvest.operators.overlaps import id_words, job_overlaps, read_words, sightings_report, store_words
from harvest.operators.pages import last_attempt, page_flags, page_status, query_yield, valid_pages
from harvest.operators.ranking import cap, first_seen, preview, ranked, result_window, top_n
from harvest.operators.records import (
    check_node,
    check_query,
    check_repo,
    check_stats,
    check_table,
    marked,
    stats_from_records,
    to_repo,
    to_stats,
)
from harvest.operators.upsert import (
    backfill_name,
    delete_repos,
    fold_batch,
    fold_stats,
    not_seen,
    orphans,
    upsert_repo,
    upsert_stats,
    with_parent,
)
from harvest.plans.continued import collected, replay_more
from harvest.plans.load import Loaded, Roots, export_latest, harvest_pages, load_records
from harvest.plans.readmit import read_bad, readmit
from harvest.plans.replay import node_outcomes, page_outcomes, replay
from harvest.settings import SETTINGS, configure
from harvest.sources.buckets import by_ids, by_name, delete_buckets, publish_buckets, read_bucketed_repo, store_buckets
from harvest.sources.exports import export_csv, write_bad, write_jobs
from harvest.sources.matrix import queries_for, query_matrix, single_job_queries
from harvest.sources.pages import explode_nodes, parse_pages, read_pages
from harvest.sources.tables import delete_stored, drop_versions, publish_repo, read_repo, read_stats, store_repo, store_stats
from harvest.streaming.ingest import ingest_stream
from harvest.streaming.sightings import late_rows, stream_sightings

__all__ = [name for name in dir() if not name.startswith("_")]
