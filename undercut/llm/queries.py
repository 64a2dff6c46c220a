"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from undercut.llm import (
    conversations,
    decontamination,
    fill_middle,
    language_model,
    merkle,
    near_duplicates,
    nearest,
    packing,
    personal_data,
    quality,
    sharding,
    substrings,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_personal_data(spark, sf_dir):
    found = personal_data.find(table(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = {f"n_{kind}": F.size(personal_data.of_kind("base", kind)).cast("long") for kind in personal_data.KINDS}
    spans = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id",
        *(n.alias(name) for name, n in counts.items()),
        F.sha2(personal_data.span_list(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        personal_data.span_list(spans).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query
def op2_benchmark_passages(spark, sf_dir):
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op3_shard_by_bytes(spark, sf_dir):
    laid = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)
    return laid.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op4_chat_text(spark, sf_dir):
    return conversations.render(table(spark, sf_dir, "conversations"))


@query
def op5_near_duplicates(spark, sf_dir):
    found = near_duplicates.labelled(table(spark, sf_dir, "documents"), width=2, percent=80)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


@query
def op6_context_tree_scores(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return judged.select(*names, F.round("quality", 6).alias("quality"))


@query
def op8_best_fit_packing(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer, capacity=1024)
    return packed.withColumn("length", F.col("length").cast("long"))


@query
def op9_repeated_passages(spark, sf_dir):
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer)
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op11_posting_lists(spark, sf_dir):
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op12_merkle_manifest(spark, sf_dir):
    fields = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    shown = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    carry = {"doc_id": F.col("doc_id"), "shown": merkle.leaf(*(F.col(name) for name in fields), shown)}
    found = merkle.manifest(table(spark, sf_dir, "documents"), [*fields, "text"], by="source", key="doc_id", carry=carry)
    found = found.withColumn("folded_root", merkle.folded(F.col("shown"), F.col("path")))
    proof = F.sha2(merkle.siblings(F.col("path")), 256)
    verified = F.col("folded_root") == F.col("root")
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", verified.alias("verified"))


@query
def op13_fill_in_middle(spark, sf_dir):
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    hashed = {"output_sha256": F.col("output"), "restored_sha256": fill_middle.restored(F.col("output"))}
    names = "doc_id n form prefix_chars middle_chars".split()
    return made.select(*names, *(F.sha2(text, 256).alias(name) for name, text in hashed.items()))
