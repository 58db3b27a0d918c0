"""From raw documents to packed training windows, in five stages.

Each stage works on all that its predecessor kept, written as Parquet and read again: toxic
documents go, lines that a source repeats go, one document of each group of near copies stays,
documents with benchmark passages go, and what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import decontaminate, line_dedup, packing, simhash, toxicity
from orderlake.llm.registry import query, visible
from orderlake.llm.tables import held_out, staged, table

#: Contract of the SimHash stage.
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Id that ends a document in a window.
END_ID = 1
TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted label is 0, learnt from the labels of three ids in four."""
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 4, 2))
    scored = toxicity.scored(docs, labels.select("doc_id", "toxic"))
    return scored.filter("predicted = 0").select(*docs.columns)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that their source repeats; n_chars anew.

    These are lines on over a tenth of the source's documents and, as a source may be a third of the
    corpus, passages (lines of PASSAGE_WORDS words and more) on three of its documents of unequal text.
    A document of such lines only is kept with an empty text.
    """
    kept = line_dedup.drop_boilerplate(docs, F.col("source"), long_words=line_dedup.PASSAGE_WORDS)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.one_of_each(docs, SHINGLE_WORDS, MAX_BITS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is covered."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in windows."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_windows),
]

#: Models, fingerprints and a tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table; each result but the last is written and reread."""
    visible(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
