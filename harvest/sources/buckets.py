"""The repo table in hash buckets: an upsert rewrites the buckets that its batch touches and no other file.

Each bucket is a folder `bucket=<n>`, the bucket of a row a hash of its id. The folded batch tells which buckets it touches; only those
are read, merged, written aside and put in place by a dynamic partition overwrite. A failure half-way loses nothing: the overwrite
reads the copy and not the folders it replaces, and storing the batch again repairs the table. Inside a bucket the rows are sorted by id,
and Parquet bloom filters on `id` and `name_with_owner` let lookups pass over row groups.

The number of buckets is written beside the table once and holds for its life. Choose it so that a bucket stays near a few hundred
megabytes. One writer at a time. A table without rows, and a batch without rows, are left as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from harvest.operators.upsert import upsert_repo
from harvest.schemas import REPO, conform
from harvest.sources.scratch import folder_of, staged

BUCKETS = 32
BUCKET = "bucket"
_COUNT = "_buckets"
#: Columns that lookups ask for a value of, and the different values that a bloom filter is sized for.
LOOKED_UP = ("id", "name_with_owner")
VALUES = 1_000_000
_STORED = T.StructType([*REPO.fields, T.StructField(BUCKET, T.IntegerType())])


def bucket_of(id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id.cast("long")), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, root: str) -> int | None:
    """The number of buckets of the table under `root`, None if there is no table."""
    fs, where = folder_of(spark, f"{root}/{_COUNT}")
    return spark.read.schema("buckets int").json(f"{root}/{_COUNT}").first()[0] if fs.exists(where) else None


def _held(spark: SparkSession, root: str, buckets: int | None) -> int:
    """The number of buckets, written beside the table if it is new."""
    known = bucket_count(spark, root)
    if known is None:
        known = buckets or BUCKETS
        spark.range(1).select(F.lit(known).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{root}/{_COUNT}")
    elif buckets not in (None, known):
        raise ValueError(f"the table has {known} buckets, not {buckets}")
    return known


def stored_buckets(spark: SparkSession, root: str) -> set[int]:
    """The buckets that have a folder."""
    fs, where = folder_of(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return {int(name.removeprefix(f"{BUCKET}=")) for name in names if name.startswith(f"{BUCKET}=")}


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The repo table under `root` with its `bucket`; a filter on that column prunes folders."""
    if not stored_buckets(spark, root):
        return spark.createDataFrame([], _STORED)
    rows = spark.read.schema(_STORED).option("basePath", root).parquet(f"{root}/{BUCKET}=*")
    return conform(rows, _STORED)


def read_bucketed_repo(spark: SparkSession, root: str) -> DataFrame:
    return read_buckets(spark, root).drop(BUCKET)


def _write(rows: DataFrame, root: str, values: int) -> None:
    """Replace the folders of the buckets in `rows`. A large bucket is split over tasks, each of which sorts what it writes."""
    spread = rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, "id")
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
    for name in LOOKED_UP:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", str(values))
    writer.parquet(root)


def publish_buckets(df: DataFrame, root: str, buckets: int | None = None, values: int = VALUES) -> None:
    """Write a repo table in buckets. Buckets that `df` has no row for are left alone, so the folder should be new."""
    count = _held(df.sparkSession, root, buckets)
    _write(conform(df, REPO).withColumn(BUCKET, bucket_of(F.col("id"), count)), root, values)


def touched_buckets(ids: DataFrame, buckets: int) -> list[int]:
    """The buckets of the ids: at most as many numbers as the table has buckets reach the driver."""
    return sorted(r[0] for r in ids.select(bucket_of(F.col("id"), buckets)).distinct().collect())


def store_buckets(
    batch: DataFrame,
    root: str,
    policy: str = "keep_first",
    seq: Sequence[Column | str] | str = "seq",
    derive_name: bool = True,
    buckets: int | None = None,
    values: int = VALUES,
) -> list[int]:
    """Upsert a batch into the table under `root` and return the buckets that were rewritten.

    The rows are those of `upsert_repo` on the whole table. What is read, moved and written grows with the touched buckets.
    """
    spark = batch.sparkSession
    count = _held(spark, root, buckets)
    touched = touched_buckets(batch, count)
    if touched:
        target = read_buckets(spark, root).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = conform(upsert_repo(target, batch, policy, seq, derive_name), REPO).withColumn(BUCKET, bucket_of(F.col("id"), count))
        if stored_buckets(spark, root).isdisjoint(touched):  # nothing that it reads is replaced
            _write(merged, root, values)
        else:
            with staged(merged, "buckets") as rows:
                _write(rows, root, values)
    return touched


def delete_buckets(ids: DataFrame, root: str, values: int = VALUES) -> list[int]:
    """Delete rows by `id` and return the buckets that were rewritten: those that hold one of the ids."""
    spark, gone = ids.sparkSession, ids.select("id").distinct()
    count = bucket_count(spark, root)
    if count is None:
        return []
    table = read_buckets(spark, root).filter(F.col(BUCKET).isin(touched_buckets(gone, count)))
    held = sorted(r[0] for r in table.join(gone, "id", "left_semi").select(BUCKET).distinct().collect())
    if held:
        left = table.filter(F.col(BUCKET).isin(held)).join(gone, "id", "left_anti")
        with staged(left.select(*_STORED.names), "buckets") as rows:
            _write(rows, root, values)
            full = {r[0] for r in rows.select(BUCKET).distinct().collect()}
            # The overwrite leaves a bucket alone that has no rows any more.
            for number in set(held) - full:
                fs, where = folder_of(spark, f"{root}/{BUCKET}={number}")
                fs.delete(where, True)
    return held


def by_ids(spark: SparkSession, root: str, ids: Sequence[int]) -> DataFrame:
    """The rows of a few ids: only their buckets are listed, and inside them bloom filters pass over row groups."""
    count = bucket_count(spark, root)
    if count is None or not ids:
        return read_bucketed_repo(spark, root).limit(0)
    wanted = spark.createDataFrame([(i,) for i in ids], "id long")
    return read_buckets(spark, root).filter(F.col(BUCKET).isin(touched_buckets(wanted, count)) & F.col("id").isin(list(ids))).drop(BUCKET)


def by_name(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """The rows of a few `owner/name` texts. The buckets say nothing of names; the bloom filters pass over row groups without them."""
    return read_bucketed_repo(spark, root).filter(F.col("name_with_owner").isin(list(names)))


