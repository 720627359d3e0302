"""Keyed upserts into the repo and stats tables, and their key relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harvest.functions.names import owner_slash_name
from harvest.operators.ranking import columns
from harvest.schemas import STATS

POLICIES = ("keep_first", "overwrite")
STATS_KEY = ["repo_id", "fetched_date"]
_BODY = ["name", "owner", "url", "created_at"]


def _check_policy(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")


def fold_batch(batch: DataFrame, seq: Sequence[Column | str] | str, policy: str) -> DataFrame:
    """One row per id, as if the rows of the batch were written one by one in `seq` order.

    `overwrite`: the last row wins, the partition is the last one that is not NULL. `keep_first`: name, owner, url
    and created_at come from the first row of the id, the partition from the last one, NULL or not.
    `last_name_with_owner` is what the last written row would have stored by itself.
    """
    _check_policy(policy)
    order = F.struct(*columns(seq))
    partition = F.col("alphabet_partition")
    body = F.struct(*_BODY)
    if policy == "keep_first":
        chosen, label = F.min_by(body, order), F.max_by(partition, order)
    else:
        chosen, label = F.max_by(body, order), F.max_by(partition, F.when(partition.isNotNull(), order))
    folded = batch.groupBy("id").agg(
        chosen.alias("b"),
        label.alias("alphabet_partition"),
        F.max_by(owner_slash_name(), order).alias("last_name_with_owner"),
    )
    return folded.select("id", "b.*", "alphabet_partition", "last_name_with_owner")


def upsert_repo(
    target: DataFrame,
    batch: DataFrame,
    policy: str = "keep_first",
    seq: Sequence[Column | str] | str = "seq",
    derive_name: bool = True,
) -> DataFrame:
    """The repo table after the batch. `target` has one row per id.

    `keep_first`: a known id keeps its name, owner, url and created_at and takes the partition of the batch.
    `overwrite`: a known id takes all of them, the partition only if it is not NULL.
    `derive_name` recomputes name_with_owner of every written row from the stored owner and name. Without it,
    `keep_first` stores the last written value and `overwrite` leaves the column alone.
    """
    folded = fold_batch(batch, seq, policy)
    t, b = target.withColumn("_t", F.lit(True)).alias("t"), folded.withColumn("_b", F.lit(True)).alias("b")
    joined = t.join(b, F.col("t.id") == F.col("b.id"), "full_outer")
    known, written = F.col("t._t").isNotNull(), F.col("b._b").isNotNull()

    def kept(name: str) -> Column:
        winner = known if policy == "keep_first" else ~written
        return F.when(winner, F.col(f"t.{name}")).otherwise(F.col(f"b.{name}"))

    if policy == "keep_first":
        partition = F.when(written, F.col("b.alphabet_partition")).otherwise(F.col("t.alphabet_partition"))
        plain_name = F.when(written, F.col("b.last_name_with_owner")).otherwise(F.col("t.name_with_owner"))
    else:
        partition = F.coalesce("b.alphabet_partition", "t.alphabet_partition")
        plain_name = F.col("t.name_with_owner")
    stored_name = F.when(written, owner_slash_name(kept("owner"), kept("name"))).otherwise(F.col("t.name_with_owner"))
    return joined.select(
        F.coalesce("t.id", "b.id").alias("id"),
        *[kept(name).alias(name) for name in _BODY],
        partition.alias("alphabet_partition"),
        (stored_name if derive_name else plain_name).alias("name_with_owner"),
    )


def fold_stats(batch: DataFrame, seq: Sequence[Column | str] | str = "seq") -> DataFrame:
    """One row per (repo_id, fetched_date): the last one written."""
    order = columns(seq)
    return batch.groupBy(*STATS_KEY).agg(F.max_by("stars", order[0] if len(order) == 1 else F.struct(*order)).alias("stars"))


def upsert_stats(target: DataFrame, batch: DataFrame, seq: Sequence[Column | str] | str = "seq") -> DataFrame:
    """The stats table after the batch: the last written value of every (repo_id, fetched_date).

    The batch outranks the table, so table and folded batch go through one hash aggregation and nothing is sorted.
    """
    old = target.select(*STATS_KEY, "stars", F.lit(0).alias("_new"))
    new = fold_stats(batch, seq).select(*STATS_KEY, "stars", F.lit(1).alias("_new"))
    merged = old.unionByName(new).groupBy(*STATS_KEY).agg(F.max_by("stars", "_new").alias("stars"))
    return merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATS.fields])


def orphans(stats: DataFrame, repo: DataFrame) -> DataFrame:
    """Stats rows without a repo row."""
    return stats.join(repo.select(F.col("id").alias("repo_id")), "repo_id", "left_anti")


def with_parent(stats: DataFrame, repo: DataFrame) -> DataFrame:
    """Stats rows that have a repo row."""
    return stats.join(repo.select(F.col("id").alias("repo_id")), "repo_id", "left_semi")


def delete_repos(repo: DataFrame, stats: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the given ids: deleting a repo deletes its stats."""
    gone = ids.select("id")
    return (
        repo.join(gone, "id", "left_anti"),
        stats.join(gone.select(F.col("id").alias("repo_id")), "repo_id", "left_anti"),
    )


def not_seen(batch: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the batch whose key was not collected before."""
    return batch.join(seen.select(key), key, "left_anti")


def backfill_name(repo: DataFrame) -> DataFrame:
    """Add name_with_owner if the table lacks it, and fill it where it is NULL."""
    if "name_with_owner" not in repo.columns:
        return repo.withColumn("name_with_owner", owner_slash_name())
    return repo.withColumn("name_with_owner", F.coalesce("name_with_owner", owner_slash_name()))

