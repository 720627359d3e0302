"""New ids as pages arrive: a stream that tells every id once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from harvest.schemas import LANDED, MALFORMED
from harvest.streaming.ingest import usable_nodes

ARRIVED = "arrived"
#: State on disk, of which a batch commits its changes only. Spark's default keeps it on the heap and copies it for every batch.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sightings(pages: DataFrame, key: Sequence[str] = ("job", "id"), arrived: Column | None = None, delay: str = "7 days") -> DataFrame:
    """The `key` of every good node of usable pages, once, and when it arrived. `pages` is a stream.

    State is one entry for each key that arrived within `delay`, spread by a hash of the key; an entry goes when the watermark passes
    it. A key that comes again after longer than `delay` may be told again; within it, it is not. `arrived` is the time of the batch
    that takes a page if it is left out: no row is late then, however old its file. With a time of the landing itself, rows that are
    older than what had arrived two batches before, less `delay`, are late and not told; `late_rows` counts them. NULLs in the key are
    equal.
    """
    time = F.current_timestamp() if arrived is None else arrived.cast("timestamp")
    nodes = usable_nodes(pages.withColumn(ARRIVED, time), [ARRIVED]).filter(F.col("reason").isNull())
    return nodes.select(*key, ARRIVED).withWatermark(ARRIVED, delay).dropDuplicatesWithinWatermark(list(key))


def stream_sightings(
    spark: SparkSession,
    pages_dir: str,
    out: str,
    checkpoint: str,
    key: Sequence[str] = ("job", "id"),
    arrived: Column | None = None,
    delay: str = "7 days",
    max_files: int = 1000,
) -> StreamingQuery:
    """Start a stream that takes the page files not yet taken and appends the keys that are new to the Parquet table `out`.

    The sink commits each batch once, so a restart adds nothing that was added before. `arrived` may name columns of the landed pages
    and of their files, such as `_metadata.file_modification_time`.
    """
    reader = spark.readStream.schema(LANDED).option("columnNameOfCorruptRecord", MALFORMED)
    pages = reader.option("maxFilesPerTrigger", max_files).json(pages_dir)
    writer = sightings(pages, key, arrived, delay).writeStream.format("parquet").outputMode("append").option("path", out)
    # A stream copies the settings of its session when it starts; what the session states itself holds.
    own = {name: value for name, value in STATE.items() if spark.conf.get(name, None) is None}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name in own:
            spark.conf.unset(name)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the batches in the progress of a query dropped as late."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
