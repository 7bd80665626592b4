"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrocell.llm import jaccard_join, packing, quality, secret_scan
from pyrocell.llm.common import read, shared_path

SHINGLE_WORDS, SIMILAR_PERCENT, CAPACITY, END_ID = 5, 80, 2048, 1


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at its threshold or above; it learns from the labels of those given.

    Rows are kept or go as they are, whatever other columns they have; null and empty texts are judged by their
    statistics, repeated rows alike, rows without an id too (they have no label to learn from). Where the labels teach
    nothing (none, or all of one kind) every row stays. An empty table gives an empty result.
    """
    ensemble = quality.learn(docs, read(spark, sf_dir, "labels"))
    if not ensemble.rules and not ensemble.linear:
        return docs
    return quality.scored(docs, ensemble).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group linked by five-word shingles at 80 percent; no other change.

    Rows are told apart by id and text: where texts of one group share its least id, that of the least hash stays, and
    a text under an id whose other texts go is judged by itself. Rows that repeat an id and its text count once; rows
    without an id stay. Null texts and texts without words are like no other. An empty table gives an empty result;
    other columns are kept as they are.
    """
    rows = docs.withColumn("__row", F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.xxhash64("text").alias("hash")))
    groups = jaccard_join.join(rows, SHINGLE_WORDS, SIMILAR_PERCENT, id_col="__row")
    others = groups.where("component_id <> __row").select("__row").distinct()
    named = rows.where("doc_id IS NOT NULL").join(others, "__row", "left_anti").dropDuplicates(["doc_id", "text"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in the text replaced by a mark; ``n_chars`` follows.

    Null texts stay null (and ``n_chars`` with them), empty ones empty; repeated rows and null ids are kept row by row;
    other columns stay as they are. An empty table gives an empty result.
    """
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences: one row for each piece.

    A null or empty text is a piece of the end id alone; repeated rows are packed one by one, null ids kept; other
    columns aren't read. An empty table gives an empty result.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, END_ID)


STAGES = [("quality classifier", keep_quality), ("n-gram jaccard join", keep_one_of_near_copies), ("secret scans", mask_secrets), ("packing", pack_sequences)]

#: Learning, tokenising and packing can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with what each returns written to the shared folder and read again.

    The folder is the run's own; the result reads from it, so it is left to whoever clears the shared folder.
    """
    docs, folder = read(spark, sf_dir, "documents"), f"{shared_path(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
