"""From raw documents to token ids: the stages of a training-data pipeline, each of one operator.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Filtered
rows go, merged groups keep their least document, personal data is replaced, documents are
drawn by their rates, and the last stage returns ids. All but the last return docs' columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.llm.bpe import encode_documents
from tuneframe.llm.jaccard import jaccard_components
from tuneframe.llm.mixing import mixed
from tuneframe.llm.pii import personal_data
from tuneframe.llm.quality import quality_rules
from tuneframe.llm.queries import vocabulary_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


ROW = "__row"


def with_row(docs: DataFrame) -> DataFrame:
    """docs with a key that is never null: doc_id, in numeric order, and a hash of the text."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    padded = F.concat(F.expr("repeat('0', greatest(0, 20 - length(coalesce(cast(doc_id AS string), ''))))"), number)
    return docs.withColumn(ROW, F.concat_ws(":", padded, F.hex(F.xxhash64("text"))))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rows without doc_id are judged like others."""
    rows = with_row(docs)
    return rows.join(quality_rules(rows, key=ROW).filter("kept").select(ROW).distinct(), ROW, "left_semi").drop(ROW)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each component of near-duplicates; rows without one come first.

    Near duplicates share four fifths of the shingles of five words that either has.
    """
    rows = with_row(docs)
    own = jaccard_components(rows, key=ROW, size=5, percent=80).filter(F.col("component_id") == F.col(ROW)).select(ROW).distinct()
    return rows.join(own, ROW, "left_semi").dropDuplicates([ROW]).drop(ROW)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the kinds of identifiers in brackets in their place."""
    hidden = personal_data(docs, redact=True)
    return hidden.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else hidden


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate asks for."""
    return mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids."""
    return encode_documents(docs, vocabulary_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("jaccard_join", keep_one_of_each_group),
    ("personal_data", hide_personal_data),
    ("source_mixing", mix),
    ("bpe_codes", encode),
]

#: Trained models and exact joins are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
