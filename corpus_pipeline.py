"""From raw documents to token ids: five stages, each one operator of `lavra.llm` on all rows.

A stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one token ids.
Rows without an id cannot be told apart and stay where a stage decides by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import jaccard, mixing, perplexity, pieces, secrets
from lavra.llm.common import table
from lavra.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return perplexity.classify(docs, trusted).where("_kept").select("_row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, once."""
    found = jaccard.join_components(docs.where("doc_id is not null"))
    heads = found.where("doc_id = component_id").select(F.col("doc_id").alias("_head")).distinct()
    first = docs.join(heads, F.col("doc_id") == F.col("_head"), "left_semi").dropDuplicates(["doc_id"])
    return first.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and their length counted anew."""
    scanner = secrets.scanner_for(docs)
    masked = docs.withColumn("text", secrets.mask(scanner, F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more often, so that sources reach their weights."""
    return mixing.mix(docs).select("_row.*")


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, by the pieces' shares in all of them."""
    encoded = docs.withColumn("ids", pieces.encode(spark, F.col("text"), scores=pieces.piece_scores(docs)))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", without_secrets),
    ("temperature mixing", mixed),
    ("pieces", as_pieces),
]

# The classifier, the join and the pieces are beyond SQL; tests hold each against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
