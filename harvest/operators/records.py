"""Search nodes to flat records, and the checks that split good rows from bad ones."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from harvest.functions import rules
from harvest.functions.names import with_fetched
from harvest.functions.timestamps import parse_ts
from harvest.schemas import PARTITION_WIDTH


class Checked(NamedTuple):
    """Good rows, and bad rows with the `reason` they were rejected for."""

    ok: DataFrame
    bad: DataFrame


def split(df: DataFrame, reason: Column) -> Checked:
    """Split on a reason column. Both sides read `df`; write `marked(df, reason)` first if `df` is costly."""
    rows = marked(df, reason)
    return Checked(rows.filter(F.col("reason").isNull()).drop("reason"), rows.filter(F.col("reason").isNotNull()))


def marked(df: DataFrame, reason: Column) -> DataFrame:
    """Every row with its `reason`, NULL for a good row: one pass for both outcomes."""
    return df.withColumn("reason", reason)


def node_reason() -> Column:
    """Reason column for the output of `explode_nodes`."""
    return rules.first_broken(rules.node_rules(F.col("raw"), F.col("node"), parse_ts("node.createdAt")))


def repo_reason() -> Column:
    return rules.first_broken(rules.repo_rules(F.col("id"), F.col("name"), F.col("owner"), F.col("stars")))


def stats_reason() -> Column:
    return rules.first_broken(rules.stats_rules(F.col("repo_id"), F.col("stars")))


def table_reason(df: DataFrame, width: int = PARTITION_WIDTH) -> Column:
    """Constraints of the repo table, and of the stats table where `df` carries `stars`, on the columns `df` has."""
    have = set(df.columns)
    checks: list[rules.Rule] = []
    if "id" in have:
        partition = F.col("alphabet_partition") if "alphabet_partition" in have else None
        checks += rules.repo_table_rules(F.col("id"), F.col("name"), F.col("owner"), F.col("url"), partition, width)
    if "stars" in have:
        repo_id = F.col("repo_id") if "repo_id" in have else F.col("id")
        date = F.col("fetched_date") if "fetched_date" in have else F.lit("2000-01-01").cast("date")
        checks += rules.stats_table_rules(repo_id, date, F.col("stars"))
    return rules.first_broken(checks)


def check_node(nodes: DataFrame) -> Checked:
    """Structure and record rules on the output of `explode_nodes`."""
    return split(nodes, node_reason())


def check_repo(df: DataFrame) -> Checked:
    return split(df, repo_reason())


def check_stats(df: DataFrame) -> Checked:
    return split(df, stats_reason())


def check_query(df: DataFrame) -> Checked:
    return split(df, rules.first_broken(rules.query_rules(F.col("query_string"))))


def check_table(df: DataFrame, width: int = PARTITION_WIDTH) -> Checked:
    return split(df, table_reason(df, width))


def record_fields(node: Column, extras: bool = False, created_at: Column | None = None) -> list[Column]:
    """The six stored fields of a node; `extras` adds the fetched fields that the tables do not store.

    `created_at` is the parsed creation time if the caller has it already.
    """
    fields = [
        node["databaseId"].alias("id"),
        node["name"].alias("name"),
        node["owner"]["login"].alias("owner"),
        node["url"].alias("url"),
        node["stargazerCount"].alias("stars"),
        (parse_ts(node["createdAt"]) if created_at is None else created_at).alias("created_at"),
    ]
    if extras:
        fields += [
            parse_ts(node["pushedAt"]).alias("pushed_at"),
            parse_ts(node["updatedAt"]).alias("updated_at"),
            node["primaryLanguage"]["name"].alias("primary_language"),
            node["forkCount"].alias("fork_count"),
            node["licenseInfo"]["name"].alias("license_name"),
        ]
    return fields


def to_repo(nodes: DataFrame, extras: bool = True) -> DataFrame:
    """Nodes to records; the other columns of `nodes` (job, query_idx, ...) are kept in front."""
    keep = [c for c in nodes.columns if c not in ("raw", "node")]
    return nodes.select(*keep, *record_fields(F.col("node"), extras))


def to_stats(repo: DataFrame, date) -> DataFrame:
    """Star counts of the records as stats rows of one fetch day. A count out of range is NULL, which the stats rules reject."""
    return with_fetched(repo, date).select(F.col("id").alias("repo_id"), "fetched_date", F.col("stars").try_cast("int").alias("stars"))


def stats_from_records(df: DataFrame) -> DataFrame:
    """Stats rows from records that may spell the key `repoId` instead of `repo_id`."""
    if "repo_id" not in df.columns:
        df = df.withColumnRenamed("repoId", "repo_id")
    return df.select(
        F.col("repo_id").try_cast("bigint").alias("repo_id"),
        F.col("fetched_date").try_cast("date").alias("fetched_date"),
        F.col("stars").try_cast("int").alias("stars"),
    )
