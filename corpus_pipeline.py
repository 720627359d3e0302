"""A corpus from raw documents to packed sequences, in five stages: toxic documents go, poor documents go, one document of each group
of linked fingerprints stays, the sources are mixed to their target weights, and the result is packed. Each stage is written and
read again.

A null or empty text is scored like a text without words by both classifiers; those that stay link with each other, and one of them
remains. Rows without a doc_id take part in all stages. Of linked documents the one with the smallest doc_id stays, rows without one
last; of equal doc_ids the row with the smallest hash, so reruns keep the same rows. Repeated rows are equal texts and one of
them stays; the mixing stage may copy it again. Empty tables pass all stages and give no pieces. Columns of any name beside doc_id, text
and source pass through all stages but the last, which ignores them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.llm import mixing, neardup, packing, quality, toxicity
from harvest.llm.common import free_names, quoted
from harvest.sources.scratch import written

#: None: learned scores, XXH64 and merges of a vocabulary are beyond SQL.
ORACLE_SQL = None
#: Bytes that a task hands to Python at once. Spark's default bounds are 10,000 rows and 64 MB, held several times over on both sides.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """Bound the batches of a session that sets no bound of its own. It stays: a stage is planned when its rows are asked for."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(MOST_BYTES))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def _kept(scored: DataFrame, docs: DataFrame, keep) -> DataFrame:
    return scored.where(keep).select(*(quoted(c) for c in docs.columns))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    (score,) = free_names(docs, 1)
    scored = toxicity.fit(docs, _labels(spark, sf_dir)).scored(docs, score)
    return _kept(scored, docs, ~toxicity.is_toxic(F.col(score)))


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    (score,) = free_names(docs, 1)
    scored = quality.fit(docs, _labels(spark, sf_dir)).scored(docs, score)
    return _kept(scored, docs, quality.is_good(F.col(score)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return neardup.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality classifier", good_only),
    ("near-duplicates", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
