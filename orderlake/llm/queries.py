"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (
    chat,
    conversation_trie,
    decontaminate,
    inner_products,
    language_model,
    licences,
    line_dedup,
    packing,
    pivot_codes,
    prefix_hash,
    simhash,
    sql,
    token_records,
    toxicity,
)
from orderlake.llm.registry import query
from orderlake.llm.tables import held_out, table

TOKENIZER = "word_bpe_49k.json"


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = simhash.with_fingerprints(docs, "text", shingle=4).select("doc_id", "fingerprint")
    found = simhash.labelled(marked, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_document_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.edited_by_successor(table(spark, sf_dir, "documents"))


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), 7, 2).alias("held_out"))
    return language_model.scored(docs, public_tokenizers.path(TOKENIZER))


@query("op7_token_records")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = token_records.new_location(spark)
    manifest = token_records.write_records(
        table(spark, sf_dir, "documents"), location, public_tokenizers.path(TOKENIZER), end_id=2
    )
    records = token_records.records_with_starts(token_records.read_records(spark, location), manifest)
    return records.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "position")


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)


@query("op2_preference_pairs", sql.PREFERENCE_PAIRS)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.preference_rows(*chat.with_foreign_answer(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["first"], s["last"])), ",")
    return pairs.withColumn("chosen_mask", spans("chosen_mask")).withColumn("rejected_mask", spans("rejected_mask"))


@query("op4_line_dedup", sql.LINE_DEDUP)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        "page_id", line_dedup.url_host(F.col("url")).alias("host"), line_dedup.html_lines(F.col("html")).alias("text")
    )
    return line_dedup.drop_boilerplate(pages, F.col("host"), counts=True)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = held_out(F.col("doc_id"), 4, 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~own).select("doc_id", "toxic")
    found = toxicity.scored(docs, labels)
    return found.select("doc_id", own.alias("held_out"), "score", "predicted")


@query("op8_licence_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.transform("base_places", lambda p: p["first"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_conversation_trie", sql.CONVERSATION_TRIE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.turns_in_order(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(*conversation_trie.rebuilt(turns, group=100, heads=6))


@query("op12_exact_top_k", sql.EXACT_TOP_K)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query("op13_vector_codes", sql.VECTOR_CODES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = pivot_codes.codes(table(spark, sf_dir, "embeddings"), scale=1024)
    found = pivot_codes.with_label_errors(coded).withColumn("codebooks_sha256", F.lit(pivot_codes.digest(books)))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
