"""Clean a corpus in five stages: toxic texts, repeated lines, near copies and leaked benchmark texts go, the rest is encoded.

Each stage reads what the one before it wrote and works on all of it. All but the last return the columns of
``documents``; rows that a stage does not reject stay as they are. Nulls: null or empty texts are not toxic, repeat nothing, leak
nothing and have no ids; rows without an id stay. Of rows that repeat an id within a group of near copies one stays. Empty tables give empty tables.

A stage with Python workers leaves the session with Arrow batches of ``BATCH_BYTES`` at most, as its result is written after it returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from regionlake.llm import line_dedup, pieces, templates, toxicity
from regionlake.llm.base import stored
from regionlake.llm.ngram_join import ngram_jaccard


BATCH_BYTES = 4 << 20  # that go to a Python worker at a time; both sides hold a batch several times


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes of text: by default ten thousand texts, up to 64 MB, are one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose noisy-or score, learnt from the labels, is 0.5 or more."""
    bounded_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of runs of three lines or more; a document that was nothing else goes."""
    kept = line_dedup.dedup_lines(docs)
    changed = F.col("_ld_runs").isNotNull()
    kept = kept.where(~changed | (F.col("text") != ""))
    return kept.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    bounded_batches(spark)
    groups = ngram_jaccard(docs, k=5, percent=80)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    # Always by a shuffle: the ids kept grow with the corpus.
    kept = docs.join(first.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage, re-parameterised ones included."""
    found = templates.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = found.select(F.col("doc_id").alias("_leaked")).distinct().hint("merge")
    return docs.join(leaked, F.col("doc_id").eqNullSafe(F.col("_leaked")), "left_anti")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids of each text and the text that they decode to."""
    bounded_batches(spark)
    model = pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    both = pieces.round_trip(docs, model)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("n-gram jaccard join", near_copy_stage),
    ("benchmark decontamination", leak_stage),
    ("sentencepiece", encode_stage),
]

# The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
