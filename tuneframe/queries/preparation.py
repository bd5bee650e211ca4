"""Loading, standardising, rendering and length checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.functions.names import author, dataset_slug, model_base, output_name
from tuneframe.functions.templates import TEMPLATES
from tuneframe.functions.text import LengthLimits, count_tokens, estimate_tokens
from tuneframe.operators import lengths as L
from tuneframe.operators import rendering as R
from tuneframe.operators import standardize as S
from tuneframe.operators.profiling import compatibility, flag_reasoning_turns
from tuneframe.plans.prepare import canonical_turns, conversation_stats, prepare_samples, prepare_turns
from tuneframe.queries.registry import query, scratch, table
from tuneframe.sources import prepared as P
from tuneframe.sources.splits import limit_samples as first_samples
from tuneframe.sources.splits import load_jsonl
from tuneframe.sources.splits import load_splits as read_splits

M = LengthLimits(1024)
SHORT = LengthLimits(256)
DATE = "2025-01-01 00:00:00"

# ---- SQL shared by several checks

TOKENS = r"len(regexp_extract_all({}, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]'))"
PIECE = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
TEXTS = f"""rendered AS (
  SELECT conv_id, string_agg({PIECE}, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)"""


def measured(source: str, limits: LengthLimits) -> str:
    """Estimate, zone and length of ``source``, in the words of SQL."""
    return f"""estimated AS (SELECT *, coalesce(length(text), 0) // 4 AS est FROM {source}),
zoned AS (
  SELECT *, CASE WHEN est < {limits.lower} THEN 'safe' WHEN est > {limits.upper} THEN 'too_long'
            ELSE 'borderline' END AS zone FROM estimated),
measured AS (
  SELECT *, CASE WHEN zone = 'borderline' THEN {TOKENS.format('text')} ELSE est END AS len FROM zoned)"""


def stats_sql(limits: LengthLimits, by: str = "", where: str = "TRUE", kind: str = "INTEGER") -> str:
    m = limits.max_seq_length
    return f"""SELECT {by + ',' if by else ''} count(*) AS total, CAST(max(len) AS {kind}) AS max_length,
  avg(len) AS avg_length,
  CAST(list_sort(list(len))[count(*) // 2 + 1] AS {kind}) AS median_length,
  count(*) FILTER (len > {m}) AS too_long, count(*) FILTER (len > {m}) * 100.0 / count(*) AS too_long_pct,
  count(*) FILTER (zone = 'borderline') AS borderline,
  count(*) FILTER (zone = 'borderline') * 100.0 / count(*) AS borderline_pct,
  CASE WHEN count(*) FILTER (len > {m}) > count(*) * 0.2 THEN CAST(max(len) AS {kind}) END AS suggested_max_length
FROM measured WHERE {where} {'GROUP BY ' + by if by else ''}"""


PAIRS_SQL = """pairs AS (
  SELECT a.conv_id, a.turn AS first_turn, a.text AS question, b.text AS answer
  FROM conversations a LEFT JOIN conversations b
    ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant'
  WHERE a.role = 'user')"""

ALIASES_SQL = """aliased AS (
  SELECT conv_id, turn, text, CASE role
    WHEN 'user' THEN CASE turn % 3 WHEN 0 THEN 'User' WHEN 1 THEN 'human' ELSE 'INPUT' END
    WHEN 'assistant' THEN CASE turn % 3 WHEN 0 THEN 'gpt' WHEN 1 THEN 'Assistant' ELSE 'output' END
    ELSE CASE conv_id % 2 WHEN 0 THEN 'system' ELSE 'moderator' END END AS alias,
    CASE WHEN role = 'system' AND conv_id % 2 = 1 THEN NULL ELSE role END AS known
  FROM conversations)"""


# ---- inputs derived from the tables


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the answer that follows it, joined on the unique (conversation, turn)."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("first_turn"), F.col("text").alias("question")
    )
    answers = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("first_turn"), F.col("text").alias("answer")
    )
    return asked.join(answers, ["conv_id", "first_turn"], "left")


def aliased_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns with role names as other datasets spell them, some unknown."""
    turns = table(spark, sf_dir, "conversations")
    third = F.col("turn") % 3
    pick = lambda a, b, c: F.when(third == 0, a).when(third == 1, b).otherwise(c)
    role = (
        F.when(F.col("role") == "user", pick("User", "human", "INPUT"))
        .when(F.col("role") == "assistant", pick("gpt", "Assistant", "output"))
        .otherwise(F.when(F.col("conv_id") % 2 == 0, "system").otherwise("moderator"))
    )
    return turns.withColumn("role", role)


def conversation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.render_chat(S.nest_turns(table(spark, sf_dir, "conversations")))


# ---- sources


@query(
    """SELECT 'train' AS split, count(*) AS samples, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents
UNION ALL SELECT 'validation', count(*), CAST(sum(length(text)) AS BIGINT) FROM benchmark"""
)
def load_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {"train": f"{sf_dir}/documents.parquet", "validation": f"{sf_dir}/benchmark.parquet"}
    return read_splits(spark, paths).groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"), F.sum(F.length("text").cast("bigint")).alias("chars")
    )


@query(
    """SELECT split, samples, checked FROM (VALUES ('train', (SELECT count(*) FROM documents), 'found'),
  ('validation', (SELECT count(*) FROM benchmark), 'found'), ('test', 0, 'no split ''test''; available: train, validation')) v(split, samples, checked)"""
)
def split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits asked for by name: the rows of those there are, and what is said of one there is not."""
    paths = {"train": f"{sf_dir}/documents.parquet", "validation": f"{sf_dir}/benchmark.parquet"}
    parts = []
    for name in ("train", "validation", "test"):
        try:
            rows, checked = read_splits(spark, paths, name).select("split"), "found"
        except ValueError as error:
            rows, checked = spark.read.parquet(paths["train"]).select(F.lit(name).alias("split")).filter(F.lit(False)), str(error)
        parts.append(rows.agg(F.count(F.lit(1)).alias("samples")).select(F.lit(name).alias("split"), "samples", F.lit(checked).alias("checked")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def limit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_samples(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 500, "o_orderkey")


@query("SELECT conv_id, turn, role, text FROM conversations")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    turns = table(spark, sf_dir, "conversations")
    turns.write.json(path)
    return load_jsonl(spark, path, turns.schema)


@query(
    f"WITH {TEXTS}, {measured('rendered', M)} SELECT conv_id, text FROM measured WHERE len <= {M.max_seq_length}"
)
def prepared_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: conversation_texts(spark, sf_dir)
    return P.prepare_once(spark, scratch(spark, "prepared"), build, M, "conversations", DATE)


METADATA_SQL = f"""SELECT (SELECT count(*) FROM rendered) AS original_samples,
  count(*) FILTER (len <= {M.max_seq_length}) AS valid_samples, CAST(max(len) AS INTEGER) AS max_length,
  avg(len) AS avg_length, CAST(list_sort(list(len))[count(*) // 2 + 1] AS INTEGER) AS median_length,
  count(*) FILTER (len > {M.max_seq_length}) AS filtered_count, {M.max_seq_length} AS max_seq_length,
  'conversations' AS dataset_name, '{DATE}' AS preprocessing_date FROM measured WHERE length(text) > 0"""


@query(f"WITH {TEXTS}, {measured('rendered', M)} {METADATA_SQL}")
def prepared_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "prepared")
    P.write_prepared(conversation_texts(spark, sf_dir), path, M, "conversations", DATE)
    return P.read_metadata(spark, path)


# ---- standardising


@query(
    f"""WITH {PAIRS_SQL}
SELECT conv_id, first_turn, CAST(0 AS BIGINT) AS turn, 'user' AS role, coalesce(question, '') AS content FROM pairs
UNION ALL SELECT conv_id, first_turn, 1, 'assistant', coalesce(answer, '') FROM pairs"""
)
def qa_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unnest_messages(S.to_messages(pairs(spark, sf_dir)), "conv_id", "first_turn")


@query(
    """WITH numbered AS (
  SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i
  FROM conversations WHERE role <> 'system')
SELECT conv_id, i AS turn, CASE i % 2 WHEN 0 THEN 'user' ELSE 'assistant' END AS role, text AS content
FROM numbered"""
)
def strings_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = S.nest_turns(table(spark, sf_dir, "conversations").filter(F.col("role") != "system"))
    strings = nested.select("conv_id", F.col("messages.content").alias("conversations"))
    return S.unnest_messages(S.to_messages(strings), "conv_id")


@query(f"WITH {ALIASES_SQL} SELECT conv_id, turn, known AS role, text AS content FROM aliased")
def normalise_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unnest_messages(S.to_messages(S.nest_turns(aliased_turns(spark, sf_dir))), "conv_id")


@query(
    f"""WITH {ALIASES_SQL}
SELECT count(*) AS messages, count(*) FILTER (known IS NULL) AS unknown_roles FROM aliased"""
)
def unknown_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unknown_roles(S.normalise_roles(S.nest_turns(aliased_turns(spark, sf_dir))))


@query(f"WITH {ALIASES_SQL} SELECT conv_id, turn, known AS role, text AS content FROM aliased")
def sharegpt_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = S.nest_turns(aliased_turns(spark, sf_dir))
    renamed = F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value")))
    return S.unnest_messages(S.to_messages(nested.select("conv_id", renamed.alias("conversations"))), "conv_id")


@query(
    f"""WITH {PAIRS_SQL}
SELECT conv_id, first_turn, CAST(0 AS BIGINT) AS turn, 'user' AS role,
  question || CASE WHEN conv_id % 2 = 0 THEN '' ELSE chr(10) || 'Context ' || conv_id END AS content FROM pairs
UNION ALL SELECT conv_id, first_turn, 1, 'assistant', coalesce(answer, '') FROM pairs"""
)
def instruction_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = F.when(F.col("conv_id") % 2 == 0, "").otherwise(F.concat(F.lit("Context "), F.col("conv_id")))
    rows = pairs(spark, sf_dir).select(
        "conv_id",
        "first_turn",
        F.col("question").alias("instruction"),
        context.alias("input"),
        F.col("answer").alias("output"),
    )
    return S.unnest_messages(S.to_messages(rows), "conv_id", "first_turn")


@query("SELECT conv_id, turn, role, text AS content FROM conversations")
def nest_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unnest_messages(S.nest_turns(table(spark, sf_dir, "conversations")), "conv_id")


# ---- rendering

# Invented model names in the families that templates exist for, chosen by part size.
FAMILIES = (
    "Llama-3.2-1B", "Llama-3-8B", "llama2-7b", "Qwen3-4B", "Qwen2.5-7B", "Qwen2-1.5B", "Phi-3.5-mini",
    "gemma-2-2b-it", "gemma-7b", "Mistral-7B-v0.3", "gemma3-4b", "other-13B", "Qwen-32B",
)
FAMILIES_SQL = "[" + ", ".join(f"'{f}'" for f in FAMILIES) + "]"


def model_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("p_size") % len(FAMILIES) + 1)
    name = F.concat(F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit("/"), family, F.lit("-bnb-4bit"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", name.alias("model_name"))


MODELS_SQL = f"""models AS (
  SELECT p_partkey, p_name, p_size,
    lower(replace(p_brand, '#', '')) || '/' || {FAMILIES_SQL}[p_size % {len(FAMILIES)} + 1] || '-bnb-4bit' AS model_name
  FROM part)"""


@query(
    rf"""WITH {MODELS_SQL}, low AS (SELECT *, lower(model_name) AS n FROM models)
SELECT p_partkey, model_name, CASE
  WHEN regexp_matches(model_name, '^brand1/') THEN 'vendor-own'
  WHEN regexp_matches(n, 'llama-3\.[12]') THEN 'llama-3.1' WHEN regexp_matches(n, 'llama-?3') THEN 'llama3'
  WHEN regexp_matches(n, 'llama-?2') THEN 'llama' WHEN contains(n, 'qwen3') THEN 'qwen3'
  WHEN regexp_matches(n, 'qwen-?2\.5') THEN 'qwen-2.5' WHEN regexp_matches(n, 'qwen-?2') THEN 'qwen-2'
  WHEN contains(n, 'phi') THEN 'phi-3' WHEN regexp_matches(n, 'gemma-?3') THEN 'gemma-3'
  WHEN regexp_matches(n, 'gemma-?2') THEN 'gemma2' WHEN contains(n, 'gemma') THEN 'gemma'
  WHEN contains(n, 'mistral') THEN 'mistral' ELSE 'chatml' END AS template FROM low"""
)
def select_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = model_names(spark, sf_dir).select("p_partkey", "model_name")
    known = (
        models.select("model_name").filter(F.col("model_name").startswith("brand1/")).distinct()
        .withColumn("known_template", F.lit("vendor-own"))
    )
    return R.select_template(models, known=known)


@query(f"SELECT conv_id, string_agg({PIECE}, '' ORDER BY turn) AS text FROM conversations GROUP BY ALL")
def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_texts(spark, sf_dir)


@query(
    r"""SELECT conv_id, string_agg(
    CASE turn WHEN 0 THEN '<|begin_of_text|>' ELSE '' END ||
    '<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) ||
    trim(text, ' ' || chr(9) || chr(10) || chr(13)) || '<|eot_id|>', '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""
)
def render_chat_llama3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.render_chat(S.nest_turns(table(spark, sf_dir, "conversations")), "llama3")


NAMED = ("chatml", "llama-3.1", "llama", "qwen3", "gemma-3", "mistral", "phi-3", "unheard-of")
NAMED_SQL = "[" + ", ".join(f"'{n}'" for n in NAMED) + "]"


def by_template_sql(turns: str, names: str, n: int) -> str:
    """Turns in the markup that a name chosen by conv_id asks for.

    Families without system turns get system texts at the beginning of the next user turn, or in a user turn at the end.
    """
    return f"""WITH t AS (SELECT *, {names}[conv_id % {n} + 1] AS template,
  trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS body FROM {turns}),
k AS (SELECT *, CASE WHEN template IN ('chatml', 'qwen-2', 'qwen-2.5', 'qwen3') THEN 'chatml' WHEN template IN ('llama3', 'llama-3.1') THEN 'llama3'
  WHEN template IN ('gemma', 'gemma2') THEN 'gemma' ELSE template END AS family FROM t),
folds AS (SELECT *, family IN ('gemma', 'gemma-3', 'llama', 'mistral') AS folds FROM k),
aimed AS (SELECT *, CASE WHEN folds THEN min(CASE WHEN role = 'user' THEN turn END)
  OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS aim FROM folds),
waiting AS (SELECT conv_id, aim, string_agg(CASE family WHEN 'llama' THEN '<<SYS>>' || chr(10) || body || chr(10) || '<</SYS>>' || chr(10) || chr(10)
  WHEN 'gemma-3' THEN body || chr(10) || chr(10) ELSE body || ' ' END, '' ORDER BY turn) AS system
  FROM aimed WHERE folds AND role = 'system' GROUP BY conv_id, aim),
own AS (SELECT a.conv_id, a.turn, a.template, a.family, a.role, a.text, CASE WHEN a.folds AND a.role = 'user' THEN coalesce(w.system, '') ELSE '' END || a.body AS body, a.folds
  FROM aimed a LEFT JOIN waiting w ON w.conv_id = a.conv_id AND w.aim = a.turn AND a.role = 'user'
  UNION ALL SELECT w.conv_id, 1000000, f.template, f.family, 'user', '', w.system, true
  FROM waiting w JOIN (SELECT DISTINCT conv_id, template, family FROM aimed) f USING (conv_id) WHERE w.aim IS NULL),
pieces AS (SELECT conv_id, turn, template, CASE WHEN family = 'chatml' THEN {PIECE}
  WHEN family = 'llama3' THEN '<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || body || '<|eot_id|>'
  WHEN family = 'phi-3' THEN '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10)
  WHEN role = 'system' AND folds THEN ''
  WHEN family IN ('gemma', 'gemma-3') THEN '<start_of_turn>' || CASE role WHEN 'user' THEN role ELSE 'model' END || chr(10) || body || '<end_of_turn>' || chr(10)
  WHEN role = 'user' AND folds THEN '[INST] ' || body || ' [/INST]'
  WHEN family = 'llama' THEN ' ' || body || ' </s><s>' WHEN family = 'mistral' THEN ' ' || body || '</s>' END AS piece FROM own),
joined AS (SELECT conv_id, template, CASE WHEN count(*) = count(piece) AND template <> 'unheard-of'
  THEN string_agg(piece, '' ORDER BY turn) END AS text FROM pieces GROUP BY conv_id, template)
SELECT conv_id, template, coalesce(CASE WHEN template IN ('llama3', 'llama-3.1') THEN '<|begin_of_text|>' WHEN starts_with(template, 'gemma') THEN '<bos>'
  WHEN template IN ('llama', 'mistral') THEN '<s>' ELSE '' END || text, '') AS text FROM joined"""


@query(by_template_sql("conversations", NAMED_SQL, len(NAMED)))
def render_by_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = S.nest_turns(table(spark, sf_dir, "conversations"))
    name = F.element_at(F.array(*[F.lit(n) for n in NAMED]), (F.col("conv_id") % len(NAMED) + 1).cast("int"))
    return R.render_by_template(nested.withColumn("template", name)).select("conv_id", "template", "text")


EVERY_NAME = tuple(TEMPLATES)
EVERY_NAME_SQL = "[" + ", ".join(f"'{n}'" for n in EVERY_NAME) + "]"
INSTRUCTED_SQL = """(SELECT conv_id, turn * 2 AS turn, role, text FROM conversations UNION ALL
  SELECT conv_id, turn * 2 + 1, 'system', 'Note ' || turn || ' for ' || conv_id FROM conversations WHERE (conv_id + turn) % 3 = 0)"""


@query(by_template_sql(INSTRUCTED_SQL, EVERY_NAME_SQL, len(EVERY_NAME)))
def render_system_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System texts behind every third turn, in the markup of every name; no text is empty."""
    turns = table(spark, sf_dir, "conversations")
    note = F.concat(F.lit("Note "), F.col("turn"), F.lit(" for "), F.col("conv_id"))
    notes = turns.filter((F.col("conv_id") + F.col("turn")) % 3 == 0).select("conv_id", (F.col("turn") * 2 + 1).alias("turn"), F.lit("system").alias("role"), note.alias("text"))
    nested = S.nest_turns(turns.withColumn("turn", F.col("turn") * 2).unionByName(notes))
    name = F.element_at(F.array(*[F.lit(n) for n in EVERY_NAME]), (F.col("conv_id") % len(EVERY_NAME) + 1).cast("int"))
    return R.drop_empty(R.render_by_template(nested.withColumn("template", name))).select("conv_id", "template", "text")


BROKEN_SQL = f"""{ALIASES_SQL}, rendered AS (
  SELECT conv_id, CASE WHEN count(*) = count(known) THEN
    string_agg('<|im_start|>' || known || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)
    ELSE '' END AS text FROM aliased GROUP BY conv_id)"""


def aliased_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.render_chat(S.to_messages(S.nest_turns(aliased_turns(spark, sf_dir))))


@query(f"WITH {BROKEN_SQL} SELECT conv_id, text FROM rendered WHERE length(text) > 0")
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_empty(aliased_texts(spark, sf_dir)).select("conv_id", "text")


@query(
    f"""WITH {BROKEN_SQL} SELECT count(*) AS original_samples, count(*) FILTER (text <> '') AS kept_samples,
  count(*) FILTER (text = '') AS dropped_samples FROM rendered"""
)
def empty_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.empty_counts(aliased_texts(spark, sf_dir))


@query(
    f"""WITH flags AS (
  SELECT conv_id, bool_or(contains(lower(text), 'tion')) AS reasoning FROM conversations GROUP BY conv_id),
acts AS (SELECT conv_id, CASE WHEN reasoning THEN 'ok_reasoning_template' WHEN conv_id % 2 = 0
  THEN 'disable_thinking' ELSE 'use_chatml' END AS action FROM flags)
SELECT conv_id, action, action = 'ok_reasoning_template' AS thinking, string_agg(CASE action WHEN 'use_chatml' THEN {PIECE}
  ELSE '<|im_start|>' || role || chr(10) || CASE WHEN role = 'assistant' AND action = 'disable_thinking'
    THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) ELSE '' END || text || '<|im_end|>' || chr(10)
  END, '' ORDER BY turn) AS text
FROM conversations JOIN acts USING (conv_id) GROUP BY ALL"""
)
def thinking_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    flags = flag_reasoning_turns(turns, markers=("tion",))
    nested = S.nest_turns(turns).join(flags, "conv_id")
    action = compatibility(F.lit(True), F.col("has_reasoning"), F.col("conv_id") % 2 == 0)
    return R.render_switched(nested.withColumn("action", action), "qwen3").select("conv_id", "action", "thinking", "text")


@query(
    f"""WITH {MODELS_SQL}, named AS (
  SELECT p_partkey, model_name, 'Org_' || p_size || '/My_' || replace(p_name, ' ', '_') AS dataset_name,
    CASE p_size % 4 WHEN 0 THEN 'auto' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'own-' || p_size END AS wanted FROM models),
split AS (SELECT *, replace(split_part(model_name, '/', 2), '-bnb-4bit', '') AS base,
    replace(lower(split_part(dataset_name, '/', 2)), '_', '-') AS slug FROM named)
SELECT p_partkey, base, slug, split_part(dataset_name, '/', 1) AS author,
  CASE WHEN coalesce(wanted, '') IN ('', 'auto') THEN base || '-' || slug ELSE wanted END AS output_name FROM split"""
)
def derive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    drop = ("-bnb-4bit",)
    fourth = F.col("p_size") % 4
    named = model_names(spark, sf_dir).withColumns(
        {
            "dataset_name": F.concat(
                F.lit("Org_"), F.col("p_size"), F.lit("/My_"), F.replace("p_name", F.lit(" "), F.lit("_"))
            ),
            "wanted": F.when(fourth == 0, "auto").when(fourth == 1, "")
            .when(fourth == 3, F.concat(F.lit("own-"), F.col("p_size"))),
        }
    )
    model, dataset = F.col("model_name"), F.col("dataset_name")
    return named.select(
        "p_partkey",
        model_base(model, drop).alias("base"),
        dataset_slug(dataset).alias("slug"),
        author(dataset).alias("author"),
        output_name(F.col("wanted"), model, dataset, drop).alias("output_name"),
    )


# ---- lengths


@query("SELECT doc_id, CAST(length(text) // 4 AS INTEGER) AS estimated_length FROM documents")
def estimate_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", estimate_tokens(F.col("text")).alias("estimated_length"))


@query(f"WITH {measured('documents', M)} SELECT doc_id, zone, zone = 'borderline' AS needs_tokenization FROM measured")
def length_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    zoned = L.add_lengths(table(spark, sf_dir, "documents").select("doc_id", "text"), M)
    return zoned.select("doc_id", "zone", (F.col("zone") == "borderline").alias("needs_tokenization"))


@query(f"SELECT doc_id, CAST({TOKENS.format('text')} AS INTEGER) AS tokens FROM documents")
def exact_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", count_tokens(F.col("text")).alias("tokens"))


@query(
    f"""WITH {measured('documents', M)} SELECT doc_id, CAST(est AS INTEGER) AS estimated_length, zone,
  CAST(len AS INTEGER) AS length FROM measured"""
)
def final_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.add_lengths(table(spark, sf_dir, "documents").select("doc_id", "text"), M).drop("text")


@query(f"WITH {measured('documents', M)} SELECT doc_id, CAST(len AS INTEGER) AS length FROM measured")
def final_length_with_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hook for a caller's tokenizer, here given the default pattern."""
    pattern = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]"
    counted = L.add_lengths_with(
        table(spark, sf_dir, "documents").select("doc_id", "text"), M, lambda texts: texts.str.count(pattern)
    )
    return counted.select("doc_id", "length")


@query(
    f"WITH {measured('documents', M)} SELECT doc_id, CAST(len AS INTEGER) AS length FROM measured "
    f"WHERE len <= {M.max_seq_length}"
)
def filter_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = L.add_lengths(table(spark, sf_dir, "documents").select("doc_id", "text"), M)
    return L.filter_length(lengths, M).select("doc_id", "length")


@query(f"WITH {measured('documents', M)} {stats_sql(M)}")
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.length_stats(L.add_lengths(table(spark, sf_dir, "documents").select("text"), M), M)


@query(f"WITH {measured('documents', SHORT)} {stats_sql(SHORT, 'source')}")
def length_stats_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a low limit, so that the advice to raise it shows."""
    return L.length_stats(L.add_lengths(table(spark, sf_dir, "documents").select("source", "text"), SHORT), SHORT, ["source"])


@query(f"WITH {TEXTS}, {measured('rendered', M)} {stats_sql(M, where='length(text) > 0', kind='BIGINT')}")
def conversation_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_stats(table(spark, sf_dir, "conversations"), M)


@query(
    f"""WITH {TEXTS}, {measured('rendered', M)} SELECT conv_id, length(text) AS chars, CAST(est AS BIGINT) AS
  estimated_length, zone, CAST(len AS BIGINT) AS length FROM measured"""
)
def conversation_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.conversation_lengths(canonical_turns(table(spark, sf_dir, "conversations")), M)


@query(
    f"""WITH {TEXTS}, {measured('rendered', M)} SELECT conv_id, text, CAST(len AS INTEGER) AS length
FROM measured WHERE len <= {M.max_seq_length} AND length(text) > 0"""
)
def prepare_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prepare_turns(table(spark, sf_dir, "conversations"), M)
    return kept.select("conv_id", "text", F.col("length").cast("int").alias("length"))


@query(
    f"""WITH {PAIRS_SQL}, rendered AS (SELECT conv_id, first_turn, '<|im_start|>user' || chr(10) || question ||
  '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || coalesce(answer, '') || '<|im_end|>' || chr(10)
  AS text FROM pairs), {measured('rendered', SHORT)}
SELECT conv_id, first_turn, text, CAST(len AS INTEGER) AS length FROM measured WHERE len <= {SHORT.max_seq_length}"""
)
def prepare_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_samples(pairs(spark, sf_dir), SHORT).select("conv_id", "first_turn", "text", "length")


@query(f"WITH {BROKEN_SQL}, {measured('rendered', M)} {METADATA_SQL}")
def prep_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.prep_metadata(aliased_texts(spark, sf_dir), M, "conversations", DATE)


@query(
    f"""WITH {BROKEN_SQL} SELECT count(*) AS original_samples, count(*) FILTER (text <> '') AS valid_samples,
  CAST(NULL AS INTEGER) AS max_length, CAST(NULL AS DOUBLE) AS avg_length, CAST(NULL AS INTEGER) AS median_length,
  CAST(0 AS BIGINT) AS filtered_count, {M.max_seq_length} AS max_seq_length, 'conversations' AS dataset_name,
  '{DATE}' AS preprocessing_date FROM rendered"""
)
def prep_metadata_unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.prep_metadata(aliased_texts(spark, sf_dir), M, "conversations", DATE, checked=False)


@query(
    r"""WITH cut AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]')[1:256] AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS joined FROM cut"""
)
def truncate_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = L.truncate_to(table(spark, sf_dir, "documents").select("doc_id", "text"), SHORT.max_seq_length)
    return cut.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("joined"))
