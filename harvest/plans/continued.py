"""Runs that go on: a load takes up the chains and targets that earlier loads left, without replaying their pages.

Beside its tables a run keeps a state folder. Each load writes there, under its number, the chains it moved (next page, whether
they go on), the pages that no chain has reached yet, and the ids it collected. A load counts from the moment its `done` table is
written, so one that failed half-way is as if it had not been, and its number is taken again.

Loads must hold the pages of a job in crawl order: what a later load brings comes after what earlier ones collected. Then the
records of all loads together are those of one replay over all pages. Pages may come late within that order, also a page before
others of its chain that are waiting, and a failed page may be tried again; a page that was reached is not read a second time. A chain
ends at a page without a next one. Chains that end otherwise wait for their next page.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from harvest.operators.pages import MAX_PAGES, last_attempt
from harvest.operators.ranking import first_seen
from harvest.plans.replay import CRAWL_ORDER, parsed_pages
from harvest.schemas import page_key, run_key
from harvest.sources.scratch import drop_folder, folder_of, staged

_LOAD = "load="


def _path(root: str, number: int, part: str) -> str:
    return f"{root}/{_LOAD}{number:010d}/{part}"


def loads(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the loads that ended, ascending."""
    fs, where = folder_of(spark, root)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.getPath().getName().startswith(_LOAD)]
    numbers = [int(n.removeprefix(_LOAD)) for n in names]
    return sorted(n for n in numbers if fs.exists(folder_of(spark, f"{_path(root, n, 'done')}/_SUCCESS")[1]))


def _state(spark: SparkSession, root: str, part: str, schema: T.StructType, numbers: list[int]) -> DataFrame:
    paths = [_path(root, n, part) for n in numbers]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def collected(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The records that all loads collected."""
    return _state(spark, root, "records", schema, loads(spark, root))


def _matching(left: DataFrame, right: DataFrame, names: list[str]):
    return reduce(and_, (left[n].eqNullSafe(right[f"_{n}"]) for n in names))


def replay_more(pages: DataFrame, root: str, target: int = 4000, on_bad: str = "page", max_pages: int = MAX_PAGES) -> DataFrame:
    """The records that this load of pages adds, stored under `root` with the state that the next load takes up.

    The pages are parsed once, into a staged copy. One shuffle by chain finds how far each chain gets. Ids are looked up among those
    of the same jobs, and a job's target is what it has left. Loading the pages of a load again adds nothing.
    """
    spark = pages.sparkSession
    done = loads(spark, root)
    number = done[-1] + 1 if done else 1
    parsed = parsed_pages(pages.filter(F.col("page_idx").between(0, max_pages - 1)), on_bad)
    key, job = page_key(parsed), [*run_key(parsed), "job"]
    chain = key[:-1]
    kept = parsed.select(*key, *(c for c in parsed.columns if c not in key))
    chains_schema = T.StructType([*(kept.schema[c] for c in chain), T.StructField("next", T.IntegerType()), T.StructField("open", T.BooleanType())])
    # The newest entry of a chain counts; only the last load's waiting pages do.
    heads = _state(spark, root, "chains", chains_schema, done[-1:])
    waiting = _state(spark, root, "waiting", kept.schema, done[-1:])
    with staged(kept.unionByName(waiting), "continued") as landed:
        heads = heads.select(*(F.col(c).alias(f"_{c}") for c in chain), "next", "open")
        known = landed.join(heads, _matching(landed, heads, chain), "left").drop(*(f"_{c}" for c in chain))
        known = known.withColumns({"next": F.coalesce("next", F.lit(0)), "open": F.coalesce("open", F.lit(True))})
        # A page is judged by its last attempt; reached pages and closed chains are behind.
        ahead = last_attempt(known.filter(F.col("open") & (F.col("page_idx") >= F.col("next"))))
        before = W.partitionBy(*chain).orderBy("page_idx").rowsBetween(W.unboundedPreceding, -1)
        leading = F.count(F.when(F.col("ok") & F.col("has_next"), 1)).over(before)
        judged = ahead.withColumn("reached", F.col("ok") & (F.col("next") + leading == F.col("page_idx")))
        with staged(judged, "judged") as pages_now:
            reached = pages_now.filter("reached")
            _store(pages_now.filter(~F.col("reached")).select(*kept.columns), root, number, "waiting")
            moved = reached.groupBy(*chain).agg((F.max("page_idx") + 1).cast("int").alias("next"), F.max_by("has_next", "page_idx").alias("open"))
            moved_key = moved.select(*(F.col(c).alias(f"_{c}") for c in chain))
            still = _state(spark, root, "chains", chains_schema, done[-1:])
            _store(still.join(moved_key, _matching(still, moved_key, chain), "left_anti").unionByName(moved), root, number, "chains")
            hits = reached.select(*key, *(c for c in ("fetched_date",) if c in reached.columns), F.posexplode("records").alias("pos", "r"))
            hits = hits.select(*(c for c in hits.columns if c != "r"), "r.*").filter(F.col("reason").isNull()).drop("reason")
            firsts = first_seen(hits, [*job, "id"], CRAWL_ORDER)
            old = _state(spark, root, "records", hits.schema, done).select(*(F.col(c).alias(f"_{c}") for c in [*job, "id"]))
            new = firsts.join(old, _matching(firsts, old, [*job, "id"]), "left_anti")
            have = old.groupBy(*(f"_{c}" for c in job)).agg(F.count(F.lit(1)).alias("_have"))
            place = F.row_number().over(W.partitionBy(*job).orderBy(*CRAWL_ORDER))
            # Map tasks keep `target` rows of a job; what the job has left is subtracted then.
            first = new.withColumn("_place", place).filter(F.col("_place") <= target)
            taken = first.join(have, _matching(first, have, job), "left").filter(F.col("_place") <= target - F.coalesce("_have", F.lit(0)))
            _store(taken.select(*hits.columns), root, number, "records")
    spark.range(1).write.mode("overwrite").parquet(_path(root, number, "done"))
    return _state(spark, root, "records", hits.schema, [number])


def _store(df: DataFrame, root: str, number: int, part: str) -> None:
    df.write.mode("overwrite").parquet(_path(root, number, part))


def forget_waiting(spark: SparkSession, root: str) -> None:
    """Delete chains and waiting pages of all loads but the newest; only the newest ones are read."""
    for number in loads(spark, root)[:-1]:
        for part in ("chains", "waiting"):
            drop_folder(spark, _path(root, number, part))
