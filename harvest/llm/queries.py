"""One query for each operator, over the whole of its table, and the SQL of its result where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.llm import chat, cleaning, merkle, mixing, neardup, negatives, packing, periods, quality, sharding, suffixes, tokens, toxicity
from harvest.llm.common import held_out

QUERIES: dict = {}
EXPECTED: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            EXPECTED[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.fit(docs, table(spark, folder, "labels")).scored(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", quality.is_good(F.col("score")).cast("int").alias("predicted"))


@query()
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.sharded(table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


@query()
def op3_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    grouped = neardup.groups(table(spark, folder, "documents"))
    return grouped.select("doc_id", neardup.hex_digits(F.col("bits")).alias("fingerprint"), "component_id")


@query()
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.length_histogram(table(spark, folder, "documents"))


@query(chat.SQL)
def op5_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(chat.windows(chat.with_sample(table(spark, folder, "conversations"))))


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.fit(docs, table(spark, folder, "labels")).scored(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", toxicity.is_toxic(F.col("score")).cast("int").alias("predicted"))


@query()
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"))
    length = F.octet_length("ids") / 4
    return pieces.select("doc_id", "start", length.cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


@query()
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).cast("long")
    return mixing.copies(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies", "rate", "source")


@query(merkle.SQL)
def op9_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = merkle.compared(table(spark, folder, "documents"))
    own, edited, following = (F.col(f"tree.{name}") for name in ("own", "edited", "next"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        own["root"].alias("fingerprint"),
        edited["root"].alias("edited_fingerprint"),
        merkle.likeness(own, edited).alias("near_edited"),
        merkle.likeness(own, following).alias("near_next"),
        F.size(merkle.differing_paragraphs(own, edited)).alias("n_differing"),
    )


@query(cleaning.SQL)
def op10_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = cleaning.judged(table(spark, folder, "documents").select("doc_id", "text"))
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left"]
    return judged.select("doc_id", *figures, "base_failed", "kept")


@query()
def op11_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffixes.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periods.digests(periods.with_runs(periods.planted(table(spark, folder, "documents"))))


@query(negatives.SQL)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(negatives.prepared(table(spark, folder, "embeddings")), F.col("id") % 50 == 0)
