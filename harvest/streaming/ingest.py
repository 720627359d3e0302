"""Landed pages to tables as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from harvest.operators.pages import USABLE, page_status
from harvest.operators.records import marked, node_reason, record_fields
from harvest.plans.load import Roots, checked_records, store_checked
from harvest.schemas import LANDED, MALFORMED, page_key
from harvest.sources.pages import explode_nodes, nodes_of, parsed_nodes
from harvest.sources.scratch import drop_folder


def usable_nodes(pages: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Records of all usable pages, one row per node with the `reason` it is rejected for; `more` names columns of the pages to keep."""
    keys = [*page_key(pages), "fetched_date", "attempt", *more]
    usable = page_status(pages).filter(F.col("status").isin(USABLE))
    nodes = marked(explode_nodes(usable.select(*keys, "body")), node_reason())
    return nodes.select(*keys, "pos", "reason", *record_fields(F.col("node")))


def page_records(pages: DataFrame) -> DataFrame:
    """Records of all usable pages, one row per node with the `reason` it is rejected for, without chain or target cuts.

    A page that is not usable is one row with its status as the reason and its raw answer, a malformed line likewise.
    """
    keys, usable = [*page_key(pages), "fetched_date", "attempt"], F.col("status").isin(USABLE)
    why = F.when(F.col(MALFORMED).isNotNull(), "malformed").otherwise(F.col("status"))
    answer = F.when(~usable, F.struct(F.concat(F.lit("page_"), why).alias("reason"), F.coalesce(MALFORMED, "text").alias("raw")))
    # A lost page is unpacked as one empty node, so that the lines are read and parsed once.
    nodes = parsed_nodes(F.when(usable, nodes_of()).otherwise(F.array(F.lit(None).cast("string"))))
    rows = page_status(pages).select(*keys, answer.alias("lost"), F.posexplode(nodes).alias("pos", "n"))
    rows = rows.select(*keys, "lost", "pos", "n.raw", "n.node")
    read = F.col("lost").isNull()
    return rows.select(
        *keys, F.when(read, F.col("pos")).alias("pos"), F.when(read, node_reason()).otherwise(F.col("lost.reason")).alias("reason"),
        *record_fields(F.col("node")), F.col("lost.raw").alias("raw"),
    )


class Ingest:
    """A started stream, and the one upsert that follows it."""

    def __init__(self, query: StreamingQuery, finish: Callable[[], None]):
        self.query, self._finish = query, finish

    def awaitTermination(self) -> None:  # noqa: N802, named like that of a stream
        """Wait until all files are staged, then store what is staged and not yet stored."""
        self.query.awaitTermination()
        self._finish()


def ingest_stream(
    spark: SparkSession,
    pages_dir: str,
    roots: Roots,
    checkpoint: str,
    date: dt.date,
    policy: str = "keep_first",
    max_files: int = 1000,
) -> Ingest:
    """Start a stream that takes new page files; `awaitTermination` upserts them into the tables.

    Micro-batches only stage their checked rows, good and bad, each in a folder that a repetition overwrites. One upsert
    in write order stores all staged batches, so neither the tables nor the cost depend on how the files were cut into
    batches. After a restart only files not yet taken are read; batches that were staged but not stored are stored then.
    The upsert reads the staged batches themselves, so their rows lie on disk once, and they are deleted when they are
    stored. Old versions of the repo table are dropped, the newest two stay.
    """
    stream = PurePosixPath(checkpoint).name
    staged, stored = f"{checkpoint}-staged", f"{checkpoint}-stored"

    def stage(batch: DataFrame, batch_id: int) -> None:
        page_records(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{staged}/batch={batch_id}")

    def finish() -> None:
        done, waiting = spark.read.parquet(stored), spark.read.option("basePath", staged).parquet(staged)
        batches = [r["batch"] for r in waiting.select("batch").distinct().join(done, "batch", "left_anti").collect()]
        if batches:
            rows = waiting.where(F.col("batch").isin(batches))
            store_checked(checked_records(rows.drop("batch"), date), roots, policy, f"{stream}-{min(batches)}", None)
            rows.select(F.col("batch").cast("int").alias("batch")).distinct().write.mode("append").parquet(stored)
            for batch in batches:
                drop_folder(spark, f"{staged}/batch={batch}")

    # Both folders exist from the start, with a batch that holds nothing.
    stage(spark.createDataFrame([], LANDED), -1)
    spark.range(-1, 0).select(F.col("id").cast("int").alias("batch")).write.mode("append").parquet(stored)
    reader = spark.readStream.schema(LANDED).option("columnNameOfCorruptRecord", MALFORMED)
    pages = reader.option("maxFilesPerTrigger", max_files).json(pages_dir)
    writer = pages.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return Ingest(writer.start(), finish)
