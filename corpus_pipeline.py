"""The corpus pipeline: toxicity, language, near copies, mixture, token ids.

STAGES are applied in turn, each written as Parquet and read again as the next one's documents.  All but the last return
the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, language, mixing, simhash, toxicity
from tidemark.llm.common import new_path, remainder, staged, table

#: A document told with less confidence than this (0: all languages alike, 1: sure) is no text of a language.
LANGUAGE_FLOOR = 0.06


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents predicted toxic by a lexicon learned from these documents' labels.

    A null text scores as an empty one and stays; rows of null id are scored but teach nothing; rows that repeat fare
    alike; without labels of both classes the general lexicon decides.  Rows come back as they are, with all columns.
    """
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 4) != 2)
    return toxicity.accepted(docs, toxicity.fit(docs, labels), threshold=0.3)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (null and empty ones too) and those told with less than LANGUAGE_FLOOR confidence.

    Languages are learned from these documents; where none is, all documents with letters stay.  Rows that repeat fare
    alike; rows of null id teach nothing.  Rows come back as they are, with all columns.
    """
    model = language.fit(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return language.accepted(docs, model, floor=LANGUAGE_FLOOR)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints: that of the smallest doc_id.

    Rows are told apart by doc_id and a hash of the text, so of rows that repeat a doc_id those of unlike texts are documents
    of their own, and of rows that are wholly alike in both one stays.  Null and empty texts are copies of each other.
    Rows of null doc_id all stay.  Decisions are made on keys; whole rows move once.
    """
    told = staged(simhash.near_duplicates(docs.select("doc_id", "text")).where("doc_id is not null").select("doc_id", F.col("tie").alias("__tie"), "kept"), "near-copies")
    twice = staged(told.where("kept").groupBy("doc_id", "__tie").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "__tie"), "near-copies-twice")
    gone = told.where("not kept").select("doc_id", "__tie").distinct().unionByName(twice)
    rows = docs.withColumn("__tie", simhash.tie())
    kept = rows.join(gone, ["doc_id", "__tie"], "left_anti")
    if not twice.isEmpty():
        kept = kept.unionByName(rows.join(twice, ["doc_id", "__tie"], "left_semi").dropDuplicates(["doc_id", "__tie"]))
    return kept.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, written in the order of the mixture: of files by name, and of rows in them.

    Null sources are a source of their own; rows of null id or repeated rows each have a place.  Where sources run out,
    others go on.  Rows come back as they are, with all columns.
    """
    return mixing.mix(docs, carry=True, rows_per_bucket=5_000).orderBy(F.col("slot").asc_nulls_last(), "source", "block", "place").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as digests, and the document's place in the mixture: doc_id, n_tokens, ids_sha256, decoded_sha256, position.

    `position` counts from 0 in the order in which the stage before wrote the documents; it is null where `docs` isn't a
    table of files.  A null text has no ids; rows of null id and rows that repeat each come back.
    """
    coded = lambda rows, key: bpe.digests(rows, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, id_col=key)
    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return coded(docs, "doc_id").withColumn("position", F.lit(None).cast("long"))
    # One row per file: how many rows are in the files before it.
    sizes = docs.select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    found = coded(placed.select(F.struct("doc_id", "file", "row").alias("key"), "text"), "key")
    found = found.select("doc_id.*", "n_tokens", "ids_sha256", "decoded_sha256").join(F.broadcast(before), "file")
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", (F.col("before") + F.col("row")).alias("position"))


STAGES = [("toxicity", toxic), ("language", languages), ("near_copies", near_copies), ("mixture", mixture), ("token_ids", tokens)]

#: Learned classifiers and fingerprints are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table `documents` in `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
