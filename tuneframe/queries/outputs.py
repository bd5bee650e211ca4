"""Artifacts, settings and single values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.functions import scalars
from tuneframe.operators import artifacts as A
from tuneframe.operators import rules as V
from tuneframe.queries.registry import query, scratch, table
from tuneframe.sources import listings

NAMES = (
    "adapter_config.json", "adapter_model.safetensors", "optimizer.pt", "config.json", "model-00001.safetensors",
    "m-Q4_K_M.gguf", "m-F16.gguf", "notes.md", "tokenizer.json", "model.Q4_K_M.gguf", "adapterXconfig.json",
    "m-Q8_0.gguf", "model.safetensors", "README.mdx", "model.gguf",
)
NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
LANG_AREA = {"en": "lora", "de": "merged_16bit", "fr": "gguf"}
FILES_SQL = f"""files AS (SELECT doc_id, source AS model, CASE lang WHEN 'en' THEN 'lora' WHEN 'de' THEN 'merged_16bit'
  WHEN 'fr' THEN 'gguf' ELSE 'merged_4bit' END AS area, {NAMES_SQL}[n_chars % {len(NAMES)} + 1] AS name,
  n_chars * 1000 AS length, doc_id % 3 // 2 AS depth FROM documents)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file: its source is the model, its language the area."""
    area = F
    for lang, name in LANG_AREA.items():
        area = area.when(F.col("lang") == lang, name)
    pick = (F.col("n_chars") % len(NAMES) + 1).cast("int")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("model"),
        area.otherwise("merged_4bit").alias("area"),
        F.element_at(F.array(*[F.lit(n) for n in NAMES]), pick).alias("name"),
        (F.col("n_chars") * 1000).alias("length"),
        F.floor(F.col("doc_id") % 3 / 2).alias("depth"),
    )


@query(
    f"""WITH {FILES_SQL} SELECT model, area, CAST(sum(length) AS BIGINT) AS bytes,
  count(*) FILTER (depth = 0 AND name LIKE '%.gguf') AS files FROM files GROUP BY model, area"""
)
def area_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.area_sizes(files(spark, sf_dir), "*.gguf")


@query(
    """SELECT 'source=' || source AS model, 'lang=' || lang AS area, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY ALL"""
)
def read_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written below folders of their source and language, listed and summed up."""
    path = scratch(spark, "artifacts")
    table(spark, sf_dir, "documents").select("source", "lang", "text").write.partitionBy("source", "lang").text(path)
    found = listings.split_artifact_path(listings.read_artifacts(spark, path), path)
    return A.area_sizes(found).select("model", "area", "bytes")


@query(
    f"""WITH {FILES_SQL}, flags AS (SELECT model, bool_or(depth = 0 AND area = 'lora' AND name = 'adapter_config.json') AS lora,
  bool_or(depth = 0 AND area = 'merged_16bit' AND name = 'config.json') AS merged_16bit,
  bool_or(depth = 0 AND area = 'merged_4bit' AND name = 'config.json') AS merged_4bit,
  bool_or(depth = 0 AND area = 'gguf' AND suffix(name, '.gguf')) AS gguf FROM files GROUP BY model)
SELECT * FROM flags WHERE lora OR merged_16bit OR merged_4bit OR gguf"""
)
def formats_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.formats_available(files(spark, sf_dir))


@query(
    f"""WITH {FILES_SQL}, flags AS (SELECT model, bool_or(depth = 0 AND area = 'lora' AND name = 'adapter_config.json') AS lora,
  bool_or(depth = 0 AND area = 'merged_16bit' AND name = 'model.safetensors') AS merged_16bit,
  bool_or(depth = 0 AND area = 'gguf' AND suffix(name, '.gguf')) AS gguf FROM files GROUP BY model)
SELECT * FROM flags WHERE lora OR merged_16bit OR gguf"""
)
def formats_to_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.formats_available(files(spark, sf_dir), A.UPLOAD_MARKERS)


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names if "*" not in n) + ")"


PLAN_SQL = f"""{FILES_SQL}, plan AS (SELECT * FROM files WHERE depth = 0 AND NOT suffix(name, '.md') AND (
  (area = 'lora' AND name NOT IN {_in(A.KEEP['lora'])})
  OR (area = 'merged_16bit' AND name NOT IN {_in(A.KEEP['merged_16bit'])}
    AND NOT regexp_full_match(name, 'model-.*\\.safetensors'))
  OR (area = 'gguf' AND NOT suffix(name, '.gguf') AND name <> 'Modelfile')))"""


@query(f"WITH {PLAN_SQL} SELECT doc_id, model, area, name, length, depth, length AS freed_bytes FROM plan")
def cleanup_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cleanup_plan(files(spark, sf_dir))


@query(
    f"""WITH {PLAN_SQL} SELECT model, area, count(*) AS removed, sum(length) / 1048576.0::DOUBLE AS size_mb
FROM plan GROUP BY model, area"""
)
def cleanup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cleanup_summary(A.cleanup_plan(files(spark, sf_dir)))


SIZE_UNITS = ("B", "KB", "MB", "GB")


@query(
    "SELECT o_orderkey, size, CASE "
    + " ".join(
        f"WHEN size < 1024.0::DOUBLE ** {i + 1} THEN printf('%.2f {u}', size / 1024.0::DOUBLE ** {i})"
        for i, u in enumerate(SIZE_UNITS)
    )
    + " ELSE printf('%.2f TB', size / 1024.0::DOUBLE ** 4) END AS label FROM (SELECT o_orderkey,"
    " CAST(2 ** (o_orderkey % 50) AS BIGINT) + o_custkey AS size FROM orders)"
)
def human_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.pow(F.lit(2), F.col("o_orderkey") % 50).cast("bigint") + F.col("o_custkey")
    sized = table(spark, sf_dir, "orders").select("o_orderkey", size.alias("size"))
    return sized.select("o_orderkey", "size", scalars.human_size(F.col("size")).alias("label"))


QUANT_SQL = f"""{FILES_SQL}, quants AS (SELECT model, name, doc_id, length / 1073741824.0::DOUBLE AS size_gb,
  string_split(replace(name, '.gguf', ''), '-')[-1] AS quant FROM files WHERE depth = 0 AND area = 'gguf' AND suffix(name, '.gguf')),
labelled AS (SELECT model, name, quant, size_gb, CASE WHEN contains(quant, 'Q4') THEN 'Good balance (recommended)'
  WHEN contains(quant, 'Q8') THEN 'Very high quality, near original' WHEN contains(quant, 'F16') THEN
  'Full precision (largest)' ELSE 'Unknown' END AS quality FROM quants)"""


@query(f"WITH {QUANT_SQL} SELECT model, name, quant, size_gb, quality FROM labelled")
def quant_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.quant_table(files(spark, sf_dir))


@query(f"WITH {QUANT_SQL} SELECT model, min(size_gb) AS min_gb, max(size_gb) AS max_gb FROM labelled GROUP BY model")
def quant_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.quant_range(A.quant_table(files(spark, sf_dir)))


@query(
    f"""WITH {QUANT_SQL} SELECT model, quant, name AS file FROM labelled
QUALIFY row_number() OVER (PARTITION BY model ORDER BY quant <> 'Q4_K_M', name, quant) = 1"""
)
def preferred_quant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.preferred_quant(A.quant_table(files(spark, sf_dir)))


FORMATS = ("gguf_q4_k_m", "gguf_f16", "merged_16bit", "merged_4bit", "gguf_q9")
FORMATS_SQL = "[" + ", ".join(f"'{f}'" for f in FORMATS) + "]"
WANTED_SQL = f"""wanted AS (SELECT DISTINCT 'm' || l_partkey AS model, {FORMATS_SQL}[l_linenumber % 5 + 1] AS format FROM lineitem),
there AS (SELECT DISTINCT 'm' || l_partkey AS model, {FORMATS_SQL}[l_suppkey % 5 + 1] AS format FROM lineitem
  WHERE l_returnflag = 'R')"""
KIND_SQL = """CASE WHEN format = 'gguf_q9' THEN 'unknown' WHEN starts_with(format, 'gguf_') THEN 'gguf'
  ELSE 'other' END AS kind"""


def formats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order lines as requests for a format, returned ones as formats that exist."""
    lines = table(spark, sf_dir, "lineitem")
    known = F.array(*[F.lit(f) for f in FORMATS])
    model = F.concat(F.lit("m"), F.col("l_partkey")).alias("model")
    pick = lambda c: F.element_at(known, (F.col(c) % 5 + 1).cast("int")).alias("format")
    return (
        lines.select(model, pick("l_linenumber")),
        lines.filter(F.col("l_returnflag") == "R").select(model, pick("l_suppkey")),
    )


@query(f"WITH {WANTED_SQL} SELECT model, format, {KIND_SQL} FROM (SELECT * FROM wanted EXCEPT SELECT * FROM there)")
def missing_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.missing_outputs(*formats(spark, sf_dir))


@query(f"WITH {WANTED_SQL} SELECT model, format, {KIND_SQL} FROM wanted")
def missing_outputs_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.missing_outputs(*formats(spark, sf_dir), force=True)


@query(f"WITH {FILES_SQL} SELECT doc_id, name FROM files WHERE starts_with(name, 'model.') AND suffix(name, '.gguf')")
def legacy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.legacy_files(files(spark, sf_dir)).select("doc_id", "name")


# ---- settings


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as run settings, many of them out of range."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity").cast("int") - 2).alias("lora_rank"),
        (F.col("l_discount") * 11).alias("lora_dropout"),
        (F.col("l_linenumber") - 2).alias("warmup_steps"),
        F.when(flag == "A", "adamw_8bit").when(flag == "N", "sgd").otherwise("lion").alias("optimizer"),
        F.when(F.col("l_linestatus") == "O", F.array(F.lit("gguf_q8_0"), F.lit("gguf_q9")))
        .otherwise(F.array(F.lit("merged_16bit")))
        .alias("formats"),
        F.when(flag == "N", "vllm").otherwise("ollama").alias("backend"),
        (F.col("l_suppkey") % 4).cast("int").alias("num_train_epochs"),
        F.when(flag == "A", "5 min").when(flag == "R", "5 hours").alias("timeout"),
    )


@query(
    """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_quantity) AS INTEGER) - 2 AS r, l_discount * 11 AS d,
  l_linenumber - 2 AS w, l_returnflag AS f, l_linestatus AS s, CAST(l_suppkey % 4 AS INTEGER) AS e FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, 'lora_rank' AS field, 'positive' AS rule, CAST(r AS VARCHAR) AS value FROM c WHERE r <= 0
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'lora_dropout', 'fraction', CAST(d AS VARCHAR) FROM c WHERE d < 0 OR d > 1
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'warmup_steps', 'not negative', CAST(w AS VARCHAR) FROM c WHERE w < 0
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'optimizer', 'choice', 'lion' FROM c WHERE f = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'formats', 'choice', 'gguf_q8_0,gguf_q9' FROM c WHERE s = 'O'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'num_train_epochs', 'positive', CAST(e AS VARCHAR) FROM c WHERE e <= 0
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'timeout', 'duration', '5 hours' FROM c WHERE f = 'R'"""
)
def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.config_violations(configs(spark, sf_dir), "l_orderkey", "l_linenumber", "l_partkey")


@query(
    """SELECT event_id, unnest(CASE event_type WHEN 'view' THEN [] ELSE [event_type, 'lora_rnk'] END) AS field, 'unknown' AS rule
FROM events"""
)
def unknown_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit('{"lora_rank": 8, "'), F.col("event_type"), F.lit('": '), F.col("props"), F.lit(', "lora_rnk": 4}'))
    document = F.when(F.col("event_type") == "view", "no object").otherwise(body)
    documents = table(spark, sf_dir, "events").select("event_id", document.alias("document"))
    return V.unknown_settings(documents, "event_id")


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k') ELSE 'none' END AS deep FROM events"""
)
def get_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = F.concat(F.lit('{"a": {"b": '), F.col("props"), F.lit("}}"))
    doc = F.when(F.col("event_type") == "click", nested).when(F.col("event_type") == "view", "not json").otherwise("{}")
    return table(spark, sf_dir, "events").select(
        "event_id",
        V.get_path(F.col("props"), "k", 0, "bigint").alias("k"),
        V.get_path(doc, "a.b.k", "none").alias("deep"),
    )


BOOLS = ("true", "1", "YES", "on", "off", "", "False", "True ")
BOOLS_SQL = "[" + ", ".join(f"'{b}'" for b in BOOLS) + "]"


@query(
    f"""WITH t AS (SELECT event_id, {BOOLS_SQL}[event_id % {len(BOOLS)} + 1] AS text FROM events)
SELECT event_id, text, lower(text) IN ('true', '1', 'yes', 'on') AS flag FROM t"""
)
def parse_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.element_at(F.array(*[F.lit(b) for b in BOOLS]), (F.col("event_id") % len(BOOLS) + 1).cast("int"))
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return texts.select("event_id", "text", scalars.parse_bool(F.col("text")).alias("flag"))


UNITS = ("min", "m", "s", "sec", "", " M ", "h", " S", ".5")
UNITS_SQL = "[" + ", ".join(f"'{u}'" for u in UNITS) + "]"


@query(
    rf"""WITH t AS (SELECT event_id, ' ' || CAST(floor(value) AS BIGINT) || {UNITS_SQL}[event_id % {len(UNITS)} + 1] AS text FROM events),
m AS (SELECT event_id, text, regexp_extract(lower(trim(text)), '^([0-9]+)\s*(min|m|sec|s)?$', ['n', 'u']) AS r FROM t)
SELECT event_id, text, TRY_CAST(r.n AS BIGINT) * CASE WHEN r.u IN ('min', 'm') THEN 60 ELSE 1 END AS seconds FROM m"""
)
def parse_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*[F.lit(u) for u in UNITS]), (F.col("event_id") % len(UNITS) + 1).cast("int"))
    text = F.concat(F.lit(" "), F.floor("value"), unit)
    texts = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return texts.select("event_id", "text", scalars.parse_duration(F.col("text")).alias("seconds"))
