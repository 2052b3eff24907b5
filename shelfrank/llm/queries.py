"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import (
    decontamination,
    exact_dedup,
    language_id,
    mixing,
    near_dedup,
    oracles,
    periodic_runs,
    prefix_forest,
    quality,
    secret_scan,
    token_alignment,
    token_records,
    toxicity,
    warc,
)
from shelfrank.session import scratch_path

# Whole texts are long: few of them go to Python at a time.
BATCH_ROWS = 1000
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def op1_hash_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return prefix_forest.nearest(vectors, F.col("vec_id") % 100 == 0)


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixture = mixing.mix(table(spark, folder, "documents"))
    return mixture.select("doc_id", "size", "source_size", "target", "taken", "source", "times")


def token_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the documents as token records and digest what is read back."""
    folder = scratch_path(spark, "token_records")
    token_records.write_token_records(docs, folder, public_tokenizers.path(TOKENIZER))
    records = token_records.read_token_records(spark, folder)
    return records.select(
        "doc_id", F.col("first_token").alias("start"), "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_token_records(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(spark, table(spark, folder, "documents"))


def op4_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.toxic_passages(table(spark, folder, "documents"), labels)
    return found.select(
        "doc_id", "held_out", "score", "predicted", "evidence", F.size("segments").alias("n_segments")
    )


def op5_minhash_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op6_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.quality_scores(table(spark, folder, "documents"), labels)


def op7_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.leaks(table(spark, folder, "documents"), benchmark)


def op8_language_evidence(spark: SparkSession, folder: str) -> DataFrame:
    model = language_id.fit_text_model(table(spark, folder, "documents"))
    return language_id.identify(spark.read.parquet(f"{folder}/pages.parquet"), model)


def op9_markov_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.summary(secret_scan.secret_spans(table(spark, folder, "documents")))


def op10_revisit_archives(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), archives)
    resolved = warc.resolve_revisits(warc.read_archives(spark, archives, payloads=False))
    return resolved.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_fuse_filter_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """The documents, the tail of every tenth made periodic: doc_id and text."""
    h, place = F.crc32(F.col("doc_id").cast("string")), F.floor(F.col("h") / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.size("words")
    cut = chosen.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, place % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + place % 8))
    tail = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tiled = F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(tail, times)))
    made = F.array_join(F.slice(tiled, F.lit(1), F.col("n")), " ")
    with_period = cut.withColumn("p", period.cast("int"))
    return with_period.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op12_minimizer_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(repeated_tails(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * best.length / best.period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spill_alignment(spark: SparkSession, folder: str) -> DataFrame:
    first, second = map(public_tokenizers.path, (TOKENIZER, PIECES))
    return token_alignment.align(table(spark, folder, "documents"), first, second).documents


QUERIES = {
    "op1_hash_prefix_forest": op1_hash_prefix_forest,
    "op2_source_mix": op2_source_mix,
    "op3_token_records": op3_token_records,
    "op4_toxic_segments": op4_toxic_segments,
    "op5_minhash_lsh_forest": op5_minhash_lsh_forest,
    "op6_rule_ensemble": op6_rule_ensemble,
    "op7_spaced_seeds": op7_spaced_seeds,
    "op8_language_evidence": op8_language_evidence,
    "op9_markov_secrets": op9_markov_secrets,
    "op10_revisit_archives": op10_revisit_archives,
    "op11_fuse_filter_dedup": op11_fuse_filter_dedup,
    "op12_minimizer_runs": op12_minimizer_runs,
    "op13_spill_alignment": op13_spill_alignment,
}

ORACLES = oracles.ORACLES
