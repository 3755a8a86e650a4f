"""A corpus pipeline: toxicity, exact dedup, near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
Stages that drop documents keep every other column of them as it is. What is decided of a
row holds for that row alone: null and repeated ids are rows of their own. Null texts count
as empty ones; an empty table goes through all stages; columns that are not of documents
are left behind.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.llm import bpe
from resultlake.llm.exact_dedup import exact_dedup
from resultlake.llm.mixing import mix
from resultlake.llm.near_dedup import near_dedup
from resultlake.llm.scratch import stored
from resultlake.llm.toxicity import toxicity as score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The key of a row inside a stage.
ROW = "__row"
#: Percent of common shingles from which on the stage takes documents for near copies.
NEAR_PERCENT = 80
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of each row that every reading of it gives the row again.

    A row of a Parquet file is known by its file and its place there; anything else is
    written down with a key.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" and plan.relation().fileFormat().getClass().getSimpleName() == "ParquetFileFormat":
        return docs.select(*COLUMNS, F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias(ROW))
    return stored(docs.select(*COLUMNS).withColumn(ROW, F.monotonically_increasing_id()), "rows")


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but the rows whose keys are in ``rejected``; ids may be null or repeat."""
    return docs.join(rejected.select(ROW), ROW, "left_anti").select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted label is 1 go; without labels of both classes none does, and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = keyed(docs)
    return without(docs, score_toxicity(docs, labels, row_col=ROW).filter("predicted = 1"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, also of rows equal in all; null and empty texts are equal."""
    docs = keyed(docs)
    return without(docs, exact_dedup(docs, row_col=ROW).filter("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays; empty texts are copies of nothing."""
    docs = keyed(docs)
    return without(docs, near_dedup(docs, percent=NEAR_PERCENT, row_col=ROW).filter("NOT kept"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: a row for each repetition; texts without words count nothing."""
    docs = keyed(docs)
    taken = stored(mix(docs, row_col=ROW).filter("repeats > 0").select(ROW, "repeats"), "repeats")
    both = docs.join(taken, ROW)
    return both.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each row and of the bytes that they decode to; an empty text has no ids."""
    coded = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixing),
    ("bpe", encoding),
]

#: A learned score and a tokenizer are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
