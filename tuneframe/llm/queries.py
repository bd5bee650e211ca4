"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.llm.bpe import encode_documents
from tuneframe.llm.counts import count_tokens
from tuneframe.llm.jaccard import jaccard_components
from tuneframe.llm.lz import edit_likeness
from tuneframe.llm.mixing import TARGETS, mixture
from tuneframe.llm.oracles import JACCARD, TRIE, repeated_windows
from tuneframe.llm.pii import personal_data
from tuneframe.llm.quality import quality_rules
from tuneframe.llm.sharding import sharded
from tuneframe.llm.substrings import remove_repeated
from tuneframe.llm.suffixes import repeated_passages
from tuneframe.llm.toxicity import toxicity
from tuneframe.llm.trie import prefix_trie
from tuneframe.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = sql
        return make

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_file(name: str) -> str:
    """The place of a public vocabulary, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_dedup", repeated_windows(50, "n_repeated", "repeated"))
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir)).select("doc_id", "n_words", "n_repeated", F.sha2("kept_text", 256).alias("kept_sha256"), "repeated")


@query("op2_bpe_codes")
def bpe_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), vocabulary_file("word_bpe_49k.json"), digests=True)


@query("op3_substring_dedup", repeated_windows(35, "n_removed", "removed"))
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "removed")


@query("op4_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixture(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=["doc_id"])
    posteriors = [F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(TARGETS)]
    return made.select("row.doc_id", "n_tokens", *posteriors, "rate", "copies")


@query("op5_personal_data")
def private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


@query("op6_jaccard_join", JACCARD)
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "n_links")


@query("op7_quality_rules")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


@query("op8_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), vocabulary_file("byte_bpe_50k.json"))


@query("op9_lz_fingerprint")
def lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(documents(spark, sf_dir))


@query("op10_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op11_prefix_trie", TRIE)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op12_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(documents(spark, sf_dir))
