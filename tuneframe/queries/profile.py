"""Reasoning detection and recommended settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.functions.names import model_size_class as size_class
from tuneframe.functions.text import has_reasoning
from tuneframe.functions.text import template_is_reasoning as is_reasoning_template
from tuneframe.operators import profiling as P
from tuneframe.operators import recommend as C
from tuneframe.operators.standardize import nest_turns
from tuneframe.queries.preparation import MODELS_SQL, model_names
from tuneframe.queries.registry import query, table

# The default markers are rare in invented prose, so common syllables stand in for them.
MARKERS = ("the sch", "tion que", "ß")
MARKED = "(contains(lower({0}), 'the sch') OR contains(lower({0}), 'tion que') OR contains(lower({0}), 'ß'))"
DEFAULT_MARKED = (
    "regexp_matches(lower(text), '<think>|</think>|let me think|let''s think|thinking step by step|step [123]:"
    "|reasoning:|analysis:|let''s break this down|first,|second,|finally,')"
)


@query(f"SELECT doc_id, {DEFAULT_MARKED} AS by_default, {MARKED.format('text')} AS has_reasoning FROM documents")
def flag_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", has_reasoning(F.col("text")).alias("by_default"))
    return P.flag_reasoning(docs, markers=MARKERS).drop("text")


@query(f"SELECT conv_id, bool_or({MARKED.format('text')}) AS has_reasoning FROM conversations GROUP BY conv_id")
def flag_reasoning_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flag_reasoning_turns(table(spark, sf_dir, "conversations"), markers=MARKERS)


@query(f"SELECT conv_id, bool_or({MARKED.format('text')}) AS has_reasoning FROM conversations GROUP BY conv_id")
def flag_reasoning_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nest_turns(table(spark, sf_dir, "conversations"))
    flagged = P.flag_reasoning_messages(nested, markers=MARKERS)
    return flagged.groupBy("conv_id").agg(F.bool_or("has_reasoning").alias("has_reasoning"))


SHARE = """count(*) AS sampled, count(*) FILTER (f) AS reasoning_samples, avg(CAST(f AS INTEGER)) AS reasoning_share,
  coalesce(avg(CAST(f AS INTEGER)) > 0.2, FALSE) AS is_reasoning"""


@query(f"SELECT {SHARE} FROM (SELECT {MARKED.format('text')} AS f FROM documents ORDER BY doc_id LIMIT 50)")
def reasoning_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.reasoning_share(table(spark, sf_dir, "documents"), "doc_id", markers=MARKERS)


@query(f"SELECT source, {SHARE} FROM (SELECT source, {MARKED.format('text')} AS f FROM documents) GROUP BY source")
def reasoning_share_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.reasoning_share_by(table(spark, sf_dir, "documents"), ["source"], markers=MARKERS)


@query("SELECT page_id, regexp_matches(lower(html), '<think>|reasoning|chain-of-thought|cot') AS is_reasoning FROM pages")
def template_is_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", is_reasoning_template(F.col("html")).alias("is_reasoning"))


@query(
    f"""SELECT doc_id, CASE
  WHEN lang IN ('en', 'de') AND NOT {MARKED.format('text')} THEN
    CASE WHEN source < 'src3' THEN 'disable_thinking' ELSE 'use_chatml' END
  WHEN lang NOT IN ('en', 'de') AND {MARKED.format('text')} THEN 'use_reasoning_model'
  WHEN lang IN ('en', 'de') THEN 'ok_reasoning_template' ELSE 'ok_standard_template' END AS action FROM documents"""
)
def compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = P.compatibility(
        F.col("lang").isin("en", "de"), has_reasoning(F.col("text"), MARKERS), F.col("source") < "src3"
    )
    return table(spark, sf_dir, "documents").select("doc_id", action.alias("action"))


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a dataset with its present settings."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.when(F.col("o_orderstatus") == "P", "GAIR/lima").otherwise("org/data"), F.lit("-"), key).alias("name"),
        (key * 2).alias("n"),
        (F.col("o_totalprice") / 300).alias("avg_length"),
        F.when(F.col("o_orderstatus") != "O", (cust % 32) / 2).alias("vram_gb"),
        (cust % 5 * 1000).alias("max_steps"),
        (cust % 4 + 1).alias("batch"),
        (key % 4 + 1).alias("accumulation"),
        (cust % 3 + 1).alias("epochs"),
        F.when(key % 7 == 0, cust).otherwise(F.lit(0)).alias("max_samples"),
    )


DATASETS_SQL = """datasets AS (SELECT o_orderkey,
  CASE o_orderstatus WHEN 'P' THEN 'GAIR/lima' ELSE 'org/data' END || '-' || o_orderkey AS name, o_orderkey * 2 AS n,
  o_totalprice / 300 AS avg_length, CASE WHEN o_orderstatus <> 'O' THEN (o_custkey % 32) / 2 END AS vram_gb,
  o_custkey % 5 * 1000 AS max_steps, o_custkey % 4 + 1 AS batch, o_orderkey % 4 + 1 AS accumulation,
  o_custkey % 3 + 1 AS epochs, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey ELSE 0 END AS max_samples FROM orders)"""
HIGH_SQL = "(contains(name, 'GAIR/lima') OR avg_length > 800)"
TARGET_SQL = f"CASE WHEN {HIGH_SQL} THEN 3 ELSE 1 END"


def advised_epochs() -> Column:
    return C.target_epochs(C.quality_tier(F.col("name"), F.col("avg_length")))


RANK_SQL = "CASE WHEN n < 5000 THEN 64 WHEN n < 20000 THEN 32 ELSE 16 END"


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey, CASE WHEN {HIGH_SQL} THEN 'high' ELSE 'standard' END AS quality,
  CASE WHEN {HIGH_SQL} THEN 3 ELSE 1 END AS target_epochs FROM datasets"""
)
def quality_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = C.quality_tier(F.col("name"), F.col("avg_length"))
    return datasets(spark, sf_dir).select(
        "o_orderkey", tier.alias("quality"), C.target_epochs(tier).alias("target_epochs")
    )


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey, {RANK_SQL} AS rank, 2 * {RANK_SQL} AS alpha,
  CASE WHEN n < 5000 THEN 3e-4 ELSE 2e-4 END AS learning_rate FROM datasets"""
)
def lora_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets(spark, sf_dir).select("o_orderkey", C.lora_tier(F.col("n")).alias("t")).select("o_orderkey", "t.*")


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey, CASE WHEN vram_gb < 8 THEN 2 ELSE 4 END AS size,
  CASE WHEN vram_gb < 8 THEN 4 ELSE 2 END AS accumulation FROM datasets"""
)
def batch_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = C.batch_tier(F.col("vram_gb"))
    return datasets(spark, sf_dir).select("o_orderkey", tier.alias("t")).select("o_orderkey", "t.*")


@query(
    f"""WITH {DATASETS_SQL}, s AS (SELECT o_orderkey, CAST(ceil(n / 8.0) AS BIGINT) AS p,
  CAST(ceil(n / 8.0) AS BIGINT) * {TARGET_SQL} AS t FROM datasets)
SELECT o_orderkey, p AS steps_per_epoch, t AS total_steps, t * 8 AS samples_seen, t * 2 / 60 AS minutes_low,
  t * 4 / 60 AS minutes_high FROM s"""
)
def training_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = C.training_plan(F.col("n"), advised_epochs())
    return datasets(spark, sf_dir).select("o_orderkey", plan.alias("p")).select("o_orderkey", "p.*")


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey,
  CAST(CASE WHEN max_steps > 0 THEN max_steps ELSE ceil(n / (batch * accumulation)) * epochs END AS BIGINT) AS total_steps,
  CASE WHEN max_steps > 0 THEN max_steps * batch * accumulation END AS samples_seen,
  CASE WHEN max_steps > 0 THEN max_steps * batch * accumulation / nullif(n, 0) ELSE CAST(epochs AS DOUBLE) END AS epochs
FROM datasets"""
)
def current_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = C.current_plan(*[F.col(c) for c in ("n", "max_steps", "batch", "accumulation", "epochs")])
    return datasets(spark, sf_dir).select("o_orderkey", plan.alias("p")).select("o_orderkey", "p.*")


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey, CAST(CASE WHEN max_steps > 0
  AND max_steps * batch * accumulation / nullif(n, 0) > 3 THEN ceil(n / 8.0) * {TARGET_SQL} END AS BIGINT) AS advised_steps
FROM datasets"""
)
def overfit_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = C.overfit_steps(F.col("n"), F.col("max_steps"), F.col("batch") * F.col("accumulation"), advised_epochs())
    return datasets(spark, sf_dir).select("o_orderkey", steps.cast("bigint").alias("advised_steps"))


@query(
    f"""WITH {DATASETS_SQL}, e AS (SELECT *, {RANK_SQL} AS r, 6 + {RANK_SQL} / 16 * 2 AS needed FROM datasets),
o AS (SELECT * FROM (VALUES ('smaller batch', 2, 4, 0, 0), ('lower rank', NULL, NULL, 1, 1),
  ('lower alpha', NULL, NULL, 0, 2), ('both', 2, NULL, 1, 0)) v(option, batch_size, accumulation, ur, ua))
SELECT o_orderkey, CAST(needed AS DOUBLE) AS vram_needed, option, batch_size, o.accumulation,
  CASE ur WHEN 1 THEN r // 2 END AS rank, CASE ua WHEN 1 THEN r WHEN 2 THEN r END AS alpha
FROM e CROSS JOIN o WHERE vram_gb < needed"""
)
def vram_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lora = C.lora_tier(F.col("n"))
    options = C.vram_fallbacks(lora["rank"], lora["alpha"], F.col("vram_gb"))
    return (
        datasets(spark, sf_dir)
        .select("o_orderkey", C.vram_estimate(lora["rank"]).alias("vram_needed"), options.alias("options"))
        .select("o_orderkey", "vram_needed", F.explode("options").alias("o"))
        .select("o_orderkey", "vram_needed", "o.*")
    )


@query(
    rf"""WITH {MODELS_SQL}, s AS (SELECT p_partkey, model_name,
  TRY_CAST(regexp_extract(model_name, '(^|[-_])([0-9]+(\.[0-9]+)?)B', 2) AS DOUBLE) AS b FROM models)
SELECT p_partkey, model_name, CASE WHEN b IN (1.5, 1.7) THEN '1.5-2GB' WHEN b = 2 THEN '2-3GB' WHEN b IN (3, 4)
  THEN '4-5GB' WHEN b = 7 THEN '7-9GB' WHEN b = 13 THEN '13-16GB' END AS size_class FROM s"""
)
def model_size_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_names(spark, sf_dir).select(
        "p_partkey", "model_name", size_class(F.col("model_name")).alias("size_class")
    )


@query(
    f"""WITH {DATASETS_SQL}, u AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE n END AS samples FROM datasets),
v AS (SELECT *, CASE WHEN max_steps > 0 THEN max_steps * batch * accumulation WHEN max_samples > 0
  THEN max_samples * epochs ELSE samples END AS used FROM u)
SELECT o_orderkey, CASE WHEN samples IS NULL OR used IS NULL THEN epochs || ' epoch(s)'
  WHEN used < samples THEN format('{{:,}}', used) || '/' || format('{{:,}}', samples) || ' samples (' || epochs || ' epoch(s))'
  ELSE format('{{:,}}', samples) || ' samples (' || epochs || ' epoch(s), full dataset)' END AS scope FROM v"""
)
def training_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = F.when(F.col("o_orderkey") % 11 != 0, F.col("n"))
    rest = [F.col(c) for c in ("max_steps", "batch", "accumulation", "max_samples", "epochs")]
    return datasets(spark, sf_dir).select("o_orderkey", C.training_scope(samples, *rest).alias("scope"))


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey, CASE WHEN max_steps <= 0 AND max_samples <= 0 THEN epochs || ' epoch(s), full dataset'
  ELSE '~' || format('{{:,}}', CASE WHEN max_steps > 0 THEN max_steps * batch * accumulation ELSE max_samples * epochs END)
    || ' samples (' || epochs || ' epoch(s), ' || CASE WHEN max_samples > 0 THEN 'limited to ' || format('{{:,}}', max_samples)
    || ' samples' ELSE max_steps || ' steps' END || ')' END AS scope FROM datasets"""
)
def estimated_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = [F.col(c) for c in ("max_steps", "batch", "accumulation", "max_samples", "epochs")]
    return datasets(spark, sf_dir).select("o_orderkey", C.estimated_scope(*settings).alias("scope"))


@query(
    f"""WITH {DATASETS_SQL} SELECT o_orderkey, CASE WHEN vram_gb IS NULL THEN 'no gpu'
  WHEN vram_gb < 4 THEN 'batch of one, gradient checkpointing on'
  WHEN vram_gb < 8 THEN 'balanced, gradient checkpointing optional'
  ELSE 'larger batch, gradient checkpointing off' END AS advice FROM datasets"""
)
def gpu_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets(spark, sf_dir).select("o_orderkey", C.gpu_advice(F.col("vram_gb")).alias("advice"))


@query(
    """WITH d AS (SELECT source AS name, count(*) AS n, avg(length(text) // 4) AS avg_length, avg(n_chars) / 250 AS vram_gb
  FROM documents GROUP BY source)
SELECT name, n, CASE WHEN avg_length > 800 THEN 'high' ELSE 'standard' END AS quality,
  CASE WHEN avg_length > 800 THEN 3 ELSE 1 END AS epochs, CASE WHEN n < 5000 THEN 64 WHEN n < 20000 THEN 32 ELSE 16 END
  AS rank, CASE WHEN vram_gb < 8 THEN 2 ELSE 4 END AS batch_size,
  CAST(ceil(n / 8.0) AS BIGINT) * CASE WHEN avg_length > 800 THEN 3 ELSE 1 END AS total_steps FROM d"""
)
def recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_source = (
        table(spark, sf_dir, "documents")
        .groupBy(F.col("source").alias("name"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.shiftright(F.length("text"), 2)).alias("avg_length"),
            (F.avg("n_chars") / 250).alias("vram_gb"),
        )
    )
    return C.recommend(per_source).select(
        "name", "n", "quality", "epochs", "lora.rank", F.col("batch.size").alias("batch_size"), "plan.total_steps"
    )
