"""Shuffled order, optimizer steps and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.operators import packing as P
from tuneframe.operators.lengths import add_lengths, conversation_lengths, filter_length
from tuneframe.plans.prepare import canonical_turns
from tuneframe.queries.preparation import TEXTS, M, measured
from tuneframe.queries.registry import query, table

SEED = 3407
SHUFFLED = f"SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED}|' || doc_id), doc_id) - 1 AS position FROM documents"


@query(SHUFFLED)
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return P.seeded_shuffle(ids, "doc_id", SEED).select("doc_id", "position")


@query(
    f"""SELECT doc_id, position, position // 8 AS step, position % 8 // 2 AS micro_batch FROM ({SHUFFLED})"""
)
def assign_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return P.assign_steps(P.seeded_shuffle(ids, "doc_id", SEED), 2, 4).select(
        "doc_id", "position", "step", "micro_batch"
    )


PACKED_SQL = f"""{measured('documents', M)},
laid AS (SELECT doc_id, len, sum(len) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - len AS start FROM measured),
packed AS (SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(len AS BIGINT) AS len, CAST(start // {M.max_seq_length} AS BIGINT) AS first_block,
  CAST((start + greatest(len, 1) - 1) // {M.max_seq_length} AS BIGINT) AS last_block FROM laid)"""


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = add_lengths(table(spark, sf_dir, "documents").select("doc_id", "text"), M).select("doc_id", "length")
    return P.pack_sequences(lengths, M.max_seq_length, "doc_id")


@query(f"WITH {PACKED_SQL} SELECT doc_id, CAST(len AS INTEGER) AS length, start, first_block, last_block FROM packed")
def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, sf_dir)


@query(
    f"""WITH {PACKED_SQL}, spans AS (SELECT start, len, unnest(range(first_block, last_block + 1)) AS block
  FROM packed WHERE len > 0)
SELECT block, CAST(sum(least(start + len, (block + 1) * {M.max_seq_length}) - greatest(start, block * {M.max_seq_length}))
  AS BIGINT) AS tokens, count(*) AS samples FROM spans GROUP BY block"""
)
def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pack_blocks(packed(spark, sf_dir), M.max_seq_length)


@query(
    f"""WITH {TEXTS}, {measured('rendered', M)}, kept AS (SELECT conv_id, len, md5('{SEED}|' || conv_id) AS h FROM measured
  WHERE len <= {M.max_seq_length}),
laid AS (SELECT conv_id, len, sum(len) OVER (ORDER BY h, conv_id ROWS UNBOUNDED PRECEDING) - len AS start FROM kept)
SELECT conv_id, CAST(start AS BIGINT) AS start, CAST(start // {M.max_seq_length} AS BIGINT) AS first_block,
  CAST((start + greatest(len, 1) - 1) // {M.max_seq_length} AS BIGINT) AS last_block FROM laid"""
)
def pack_shuffled_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations within the limit, packed in the shuffled order; no text is moved for it."""
    lengths = conversation_lengths(canonical_turns(table(spark, sf_dir, "conversations")), M).filter("chars > 0")
    keyed = filter_length(lengths, M).select("conv_id", "length")
    keyed = keyed.withColumn("shuffle_key", P.shuffle_key(SEED, F.col("conv_id")))
    laid = P.pack_sequences(keyed, M.max_seq_length, "shuffle_key", "conv_id")
    return laid.select("conv_id", "start", "first_block", "last_block")
