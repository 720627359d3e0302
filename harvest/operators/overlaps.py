"""Which jobs found the same ids, from exact bitmaps that are kept and merged across loads.

A bitmap row holds the 64 ids of one word: `word` is the id without its low six bits, `mask` has a bit for each id. Dense ids take a row
for 64 of them, sparse ones a row each, so bitmaps are never longer than the distinct ids. Bitmaps of several loads merge by OR, which
repeats do not change; counts need no look at the outputs that earlier jobs wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harvest.operators.measure import skipped_and_rate
from harvest.sources.exports import LOAD, write_bad
from harvest.sources.scratch import folder_of

WORDS = "job bigint, word bigint, mask bigint"


def id_words(df: DataFrame, job: str = "job", id: str = "id") -> DataFrame:
    """(job, word, mask) of the ids that each job found. Rows without a job or an id are left out.

    Copies of an id and ids of one word fold in the map tasks.
    """
    ids = df.select(F.col(job).cast("bigint").alias("job"), F.col(id).cast("bigint").alias("id")).dropna()
    return _merged(ids.select("job", F.shiftright("id", 6).alias("word"), F.expr("shiftleft(1L, CAST(id & 63 AS INT))").alias("mask")))


def _merged(words: DataFrame) -> DataFrame:
    return words.groupBy("job", "word").agg(F.bit_or("mask").alias("mask"))


def store_words(df: DataFrame, path: str, label: str | None = None, job: str = "job", id: str = "id") -> None:
    """Keep the bitmaps of a load in a folder of their own; a `label` used before replaces that load."""
    write_bad(id_words(df, job, id), path, label)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """The bitmaps of all loads, merged; no rows if nothing was ever stored."""
    fs, where = folder_of(spark, path)
    if not fs.exists(where):
        return spark.createDataFrame([], WORDS)
    return _merged(spark.read.schema(f"{WORDS}, {LOAD} string").parquet(path).drop(LOAD))


def job_overlaps(words: DataFrame) -> DataFrame:
    """(job, other, shared, job_ids, other_ids) of every two jobs that share an id, the lower job first.

    Jobs meet on the words that both hold, 64 ids at a time, and are counted in the map tasks: a word has one row for each job at most,
    however many rows found its ids.
    """
    a = words.select("job", "word", F.col("mask").alias("own"))
    b = words.select(F.col("job").alias("other"), F.col("word").alias("_word"), "mask")
    met = a.join(b, (F.col("word") == F.col("_word")) & (F.col("job") < F.col("other")))
    both = F.bit_count(F.col("own").bitwiseAND(F.col("mask")))
    shared = met.select("job", "other", both.alias("both")).filter("both > 0").groupBy("job", "other").agg(F.sum("both").alias("shared"))
    sizes = words.groupBy("job").agg(F.sum(F.bit_count("mask")).alias("ids"))
    own = sizes.select("job", F.col("ids").alias("job_ids"))
    others = sizes.select(F.col("job").alias("other"), F.col("ids").alias("other_ids"))
    return shared.join(own, "job").join(others, "other").select("job", "other", "shared", "job_ids", "other_ids")


def sightings_report(words: DataFrame) -> DataFrame:
    """The report of `dedup_report` over the distinct ids of each job: sightings, unique ids, the rest and its share."""
    per_word = words.groupBy("word").agg(F.sum(F.bit_count("mask")).alias("seen"), F.bit_count(F.bit_or("mask")).alias("ids"))
    total = per_word.agg(
        F.coalesce(F.sum("seen"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum("ids"), F.lit(0)).cast("bigint").alias("unique_rows"),
    )
    return skipped_and_rate(total)
