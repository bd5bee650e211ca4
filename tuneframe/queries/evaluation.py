"""Result documents, scores, comparisons, tasks and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.functions import verdicts
from tuneframe.functions.scalars import signed_percent as percent_label
from tuneframe.functions.text import is_length_error as names_length_error
from tuneframe.operators import evals as B
from tuneframe.operators import logs
from tuneframe.plans import evaluation as E
from tuneframe.queries.registry import query, scratch, table, write_files
from tuneframe.sources import listings
from tuneframe.sources import results as S

KEYS = (
    "acc,none", "acc_stderr,none", "exact_match,none", "prompt_level_strict_acc,none", "inst_level_strict_acc,none",
    "accuracy,none", "f1,none", "acc,none_stderr", "acc", "exact_match,strict-match", "exact_match_stderr,strict-match",
)
KEYS_SQL = "[" + ", ".join(f"'{k}'" for k in KEYS) + "]"


def run_columns() -> list[Column]:
    """User pairs as models, the odd user as the fine-tuned variant, ten-day spans as its runs."""
    tuned = F.col("user_id") % 2 == 1
    return [
        F.concat(F.lit("m"), F.floor(F.col("user_id") / 2)).alias("model"),
        F.when(tuned, B.TUNED).otherwise(B.BASE).alias("variant"),
        F.when(tuned, F.substring(F.date_format("ts", "yyyy-MM-dd"), 1, 9)).alias("run_ts"),
    ]


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric entries, their types as tasks.

    A later event overwrites an earlier one of the same key, as in a document.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            *run_columns(),
            F.col("event_type").alias("task"),
            F.element_at(F.array(*[F.lit(key) for key in KEYS]), k % len(KEYS) + 1).alias("key"),
        )
        .agg(F.max_by("value", "event_id").alias("value"))
    )


RAW_SQL = f"""raw AS (SELECT 'm' || user_id // 2 AS model, CASE user_id % 2 WHEN 1 THEN 'fine-tuned' ELSE 'base' END AS variant,
  CASE user_id % 2 WHEN 1 THEN substr(strftime(ts, '%Y-%m-%d'), 1, 9) END AS run_ts, event_type AS task,
  {KEYS_SQL}[CAST(json_extract_string(props, '$.k') AS INTEGER) % {len(KEYS)} + 1] AS key,
  arg_max(value, event_id) AS value FROM events GROUP BY ALL)"""
SCORES_SQL = f"""{RAW_SQL}, named AS (SELECT model, variant, run_ts, task, value, replace(key, '_stderr', '') AS key,
  contains(key, '_stderr') AS err FROM raw),
scores AS (SELECT model, variant, run_ts, task, key, replace(key, ',none', '') AS metric,
  max(value) FILTER (NOT err) AS value, max(value) FILTER (err) AS stderr
  FROM named GROUP BY model, variant, run_ts, task, key HAVING count(*) FILTER (NOT err) > 0)"""
CURRENT_SQL = f"""{SCORES_SQL}, newest AS (SELECT model, max(run_ts) AS run_ts FROM raw WHERE variant = 'fine-tuned'
  GROUP BY model),
current AS (SELECT s.* FROM scores s LEFT JOIN newest n ON s.model = n.model
  WHERE s.variant = 'base' OR s.run_ts = n.run_ts)"""
ORDER = ("prompt_level_strict_acc", "inst_level_strict_acc", "accuracy", "exact_match", "acc")
COMPARED_SQL = f"""{CURRENT_SQL},
shared AS (SELECT b.model, b.task, b.metric, b.value AS base, t.value AS tuned,
    list_position({list(ORDER)}, b.metric) AS place
  FROM current b JOIN current t ON b.model = t.model AND b.task = t.task AND b.key = t.key
  WHERE b.variant = 'base' AND t.variant = 'fine-tuned' AND b.metric IN {ORDER} AND suffix(b.key, ',none')),
best AS (SELECT * FROM shared QUALIFY row_number() OVER (PARTITION BY model, task ORDER BY place) = 1),
both_sides AS (SELECT model, task FROM current GROUP BY model, task HAVING count(DISTINCT variant) = 2),
compared AS (SELECT model, task, metric, coalesce(base, 0.0) AS base_accuracy, coalesce(tuned, 0.0) AS finetuned_accuracy,
  coalesce(tuned - base, 0.0) AS delta, coalesce(CASE WHEN base > 0 THEN (tuned - base) / base * 100 END, 0.0)
  AS delta_percent FROM both_sides LEFT JOIN best USING (model, task))"""


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.normalise_metrics(raw_scores(spark, sf_dir))


def current_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the newest runs, which are found from the list of runs alone."""
    return B.latest_scores(normalised(spark, sf_dir), table(spark, sf_dir, "events").select(*run_columns()))


# ---- documents


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a result document: new shape, legacy shape (errors), broken (sign-ups)."""
    task = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    head = F.when(task == "error", "huggingface").otherwise("results")
    entries = F.concat(
        F.lit('"acc,none": '), F.col("value"), F.lit(', "acc_stderr,none": "N/A", "done": true, "n,none": '), k,
        F.lit(', "share": "0.5", "alias": "'), task, F.lit('"'),
    )
    body = F.concat(F.lit('{"'), head, F.lit('": {"'), task, F.lit('": {'), entries, F.lit("}}}"))
    broken = F.concat(F.lit('{"results": {"'), task)
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(task == "signup", broken).otherwise(body).alias("body")
    )


@query(
    """SELECT event_id, event_type AS task, 'acc,none' AS key, value FROM events WHERE event_type <> 'signup'
UNION ALL SELECT event_id, event_type, 'n,none', CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events
WHERE event_type <> 'signup'"""
)
def parse_eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.parse_eval_results(documents(spark, sf_dir), "event_id")


@query("SELECT count(*) AS documents, count(*) FILTER (event_type = 'signup') AS malformed FROM events")
def malformed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.count_malformed(documents(spark, sf_dir))


@query(
    """SELECT event_type, count(*) AS documents, count(*) FILTER (event_type <> 'signup') AS with_results
FROM events GROUP BY event_type"""
)
def result_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.task_results(F.try_parse_json("body")).isNotNull()
    return documents(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(found).alias("with_results")
    )


# ---- files of results


def result_files(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers as result files, five to a model: two of its base run, one of an older and two of its newest run."""
    place = F.col("s_suppkey") % 5
    body = F.to_json(
        F.struct(
            F.struct(
                F.struct(F.col("s_acctbal").alias("acc,none"), F.lit(0.5).alias("acc_stderr,none")).alias("ifeval"),
                F.struct((F.col("s_acctbal") / 2).alias("exact_match,none"), F.lit("-").alias("alias")).alias("gsm8k"),
            ).alias("results")
        )
    )
    files = table(spark, sf_dir, "supplier").select(
        body.alias("value"),
        F.concat(F.lit("m"), F.floor(F.col("s_suppkey") / 5)).alias("model"),
        F.when(place < 2, B.BASE).otherwise(B.TUNED).alias("variant"),
        F.when(place == 2, "r1").when(place > 2, "r2").alias("run_ts"),
        F.when(place.isin(1, 4), "results_2.json").otherwise("results_1.json").alias("file"),
    )
    root = scratch(spark, "results")
    write_files(files, root, "model", "variant", "run_ts", "file")
    return root


FILES_SQL = """files AS (SELECT 'm' || s_suppkey // 5 AS model, CASE WHEN s_suppkey % 5 < 2 THEN 'base' ELSE 'fine-tuned' END AS variant,
  CASE WHEN s_suppkey % 5 = 2 THEN 'r1' WHEN s_suppkey % 5 > 2 THEN 'r2' END AS run_ts,
  CASE WHEN s_suppkey % 5 IN (1, 4) THEN 'results_2.json' ELSE 'results_1.json' END AS file, s_suppkey, s_acctbal FROM supplier)"""
CHOSEN_SQL = f"""{FILES_SQL}, chosen AS (SELECT * FROM files QUALIFY row_number() OVER (PARTITION BY model, variant ORDER BY run_ts DESC, file DESC) = 1),
scored AS (SELECT model, variant, run_ts, 'ifeval' AS task, 'acc,none' AS key, 'acc' AS metric, s_acctbal AS value, 0.5::DOUBLE AS stderr FROM chosen
  UNION ALL SELECT model, variant, run_ts, 'gsm8k', 'exact_match,none', 'exact_match', s_acctbal / 2, NULL FROM chosen)"""


@query(f"WITH {FILES_SQL} SELECT model, variant, run_ts, file, s_acctbal AS acc FROM files")
def read_eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = S.read_eval_results(spark, result_files(spark, sf_dir), S.PARTITIONED_PATH, "part-*")
    return files.select("model", "variant", "run_ts", "file", F.get_json_object("body", "$.results.ifeval['acc,none']").cast("double").alias("acc"))


@query(f"WITH {FILES_SQL} SELECT model, variant, run_ts, file FROM files")
def list_eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.list_eval_results(spark, result_files(spark, sf_dir), S.PARTITIONED_PATH, "part-*").select("model", "variant", "run_ts", "file")


@query(f"WITH {CHOSEN_SQL} SELECT model, variant, run_ts, task, key, metric, value, stderr FROM scored")
def load_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.load_scores(spark, result_files(spark, sf_dir), layout=S.PARTITIONED_PATH, glob="part-*")


@query(
    f"""WITH {CHOSEN_SQL} SELECT b.model, b.task, b.metric, b.value AS base_accuracy, t.value AS finetuned_accuracy, t.value - b.value AS delta,
  CASE WHEN b.value > 0 THEN (t.value - b.value) / b.value * 100 ELSE 0 END AS delta_percent
FROM scored b JOIN scored t USING (model, task) WHERE b.variant = 'base' AND t.variant = 'fine-tuned'"""
)
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = E.compare_models(spark, result_files(spark, sf_dir), layout=S.PARTITIONED_PATH, glob="part-*")
    return compared.select("model", "task", "metric", "base_accuracy", "finetuned_accuracy", "delta", "delta_percent")


# ---- scores


@query(f"WITH {SCORES_SQL} SELECT model, variant, run_ts, task, key, metric, value, stderr FROM scores")
def normalise_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalised(spark, sf_dir)


def _primary_sql(policy: str, fallback: bool = False) -> str:
    order = list(B.METRIC_POLICIES[policy])
    where = "TRUE" if fallback else f"metric IN {tuple(order)} AND suffix(key, ',none')"
    return f"""WITH {SCORES_SQL} SELECT model, variant, run_ts, task, metric, value FROM scores WHERE {where}
QUALIFY row_number() OVER (PARTITION BY model, variant, run_ts, task
  ORDER BY coalesce(list_position({order}, metric), 99), metric, suffix(key, ',none')) = 1"""


@query(_primary_sql("compare"))
def primary_metric_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.primary_metric(normalised(spark, sf_dir), "compare")


@query(_primary_sql("leaderboard", fallback=True))
def primary_metric_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.primary_metric(normalised(spark, sf_dir), "leaderboard")


@query(_primary_sql("scores"))
def primary_metric_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.primary_metric(normalised(spark, sf_dir), "scores")


@query(f"WITH {CURRENT_SQL} SELECT model, variant, run_ts, task, key, value FROM current")
def latest_finetuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_scores(spark, sf_dir).select("model", "variant", "run_ts", "task", "key", "value")


@query(
    f"""WITH {COMPARED_SQL}
SELECT model, task, metric, base_accuracy, finetuned_accuracy, delta, delta_percent FROM compared"""
)
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.compare(current_scores(spark, sf_dir))


@query(
    f"""WITH {COMPARED_SQL}, texts AS (SELECT model, count(*) AS tasks,
  string_agg(task || ':' || coalesce(metric, '-'), ',' ORDER BY task) AS compared FROM compared GROUP BY model)
SELECT model, bool_or(variant = 'base') AS has_base, bool_or(variant = 'fine-tuned') AS has_tuned,
  coalesce(CAST(any_value(tasks) AS INTEGER), 0) AS tasks, coalesce(any_value(compared), '') AS compared
FROM current LEFT JOIN texts USING (model) GROUP BY model"""
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.map_entries(F.coalesce("comparison", F.expr("cast(map() AS map<string, struct<metric: string, "
        "base_accuracy: double, finetuned_accuracy: double, delta: double, delta_percent: double>>)")))
    shown = F.transform(entries, lambda e: F.concat_ws(":", e["key"], F.coalesce(e["value"]["metric"], F.lit("-"))))
    return B.summary(current_scores(spark, sf_dir)).select(
        "model", "has_base", "has_tuned", F.size(entries).alias("tasks"), F.array_join(F.sort_array(shown), ",").alias("compared")
    )


@query(
    f"""WITH {CURRENT_SQL}
SELECT model, 'org/' || model AS base_model_name, count(*) FILTER (variant = 'base') AS base_metrics,
  count(*) FILTER (variant = 'fine-tuned') AS tuned_metrics, max(run_ts) AS run_ts FROM current GROUP BY model"""
)
def benchmark_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested documents, written as JSON, read back and counted."""
    scores = current_scores(spark, sf_dir)
    models = scores.select("model").distinct()
    names = models.withColumn("base_model_name", F.concat(F.lit("org/"), F.col("model")))
    path = scratch(spark, "summary")
    made = S.summary_documents(scores, names, "2025-01-01T00:00:00")
    S.write_benchmark_summary(made, path)
    back = spark.read.schema(made.schema).json(path)

    def metrics(side: str):
        return F.coalesce(
            F.aggregate(
                F.map_values(f"{side}.results"), F.lit(0).cast("bigint"), lambda n, m: n + F.size(m)
            ),
            F.lit(0).cast("bigint"),
        )

    return back.select(
        F.col("model_name").alias("model"),
        "base_model_name",
        metrics("base_model").alias("base_metrics"),
        metrics("fine_tuned_model").alias("tuned_metrics"),
        F.col("fine_tuned_model.timestamp").alias("run_ts"),
    )


@query(
    f"""WITH {CURRENT_SQL}, best AS (SELECT model, variant, task, value FROM current
  QUALIFY row_number() OVER (PARTITION BY model, variant, task
    ORDER BY coalesce(list_position({list(B.METRIC_POLICIES['leaderboard'])}, metric), 99), metric, suffix(key, ',none')) = 1)
SELECT model, variant, {', '.join(
    f"coalesce(max(printf('%.4f', value)) FILTER (task = '{t}'), '-') AS {t}"
    for t in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM best WHERE model IN (SELECT model FROM current WHERE variant = 'fine-tuned') GROUP BY model, variant"""
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.leaderboard(current_scores(spark, sf_dir), ["click", "error", "purchase", "signup", "view"])


@query(
    f"""WITH {COMPARED_SQL} SELECT model, task, CASE WHEN delta_percent > 0 THEN '+' ELSE '' END ||
  printf('%.1f', CAST(delta_percent AS DOUBLE)) || '%' AS label FROM compared"""
)
def signed_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = B.compare(current_scores(spark, sf_dir))
    return compared.select("model", "task", percent_label(F.col("delta_percent")).alias("label"))


@query(
    f"""WITH {COMPARED_SQL} SELECT model, task, CASE WHEN delta * 100 >= 10 THEN 'excellent' WHEN delta * 100 >= 5 THEN 'good'
  WHEN delta * 100 >= 2 THEN 'marginal' WHEN delta * 100 >= 0 THEN 'weak' WHEN delta * 100 > -3 THEN 'acceptable loss'
  WHEN delta * 100 >= -5 THEN 'regression' ELSE 'possible forgetting' END AS verdict,
  CASE WHEN delta > 0 THEN '↗' WHEN delta < 0 THEN '↘' ELSE '→' END AS direction FROM compared"""
)
def score_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.judge(B.compare(current_scores(spark, sf_dir))).select("model", "task", "verdict", "direction")


@query(
    f"""WITH {COMPARED_SQL}, two AS (SELECT model, max(delta_percent) FILTER (task = 'view') AS g,
  max(delta) FILTER (task = 'click') AS t FROM compared GROUP BY model)
SELECT model, CASE WHEN g < 0 AND t < 0 THEN 'problem' WHEN g < -20 THEN 'investigate' WHEN t <= 0 THEN 'investigate'
  WHEN g < -15 THEN 'watch' ELSE 'fine' END AS verdict FROM two"""
)
def goal_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = (
        B.compare(current_scores(spark, sf_dir))
        .groupBy("model")
        .agg(
            F.max(F.when(F.col("task") == "view", F.col("delta_percent"))).alias("general"),
            F.max(F.when(F.col("task") == "click", F.col("delta"))).alias("own"),
        )
    )
    return two.select("model", verdicts.goal_verdict(F.col("general"), F.col("own")).alias("verdict"))


@query(
    _primary_sql("leaderboard", fallback=True).replace("WITH ", "WITH best AS (WITH ", 1)
    + """), expected AS (SELECT event_type AS task, max(value) AS expected FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT best.*, expected, value - expected AS gap FROM best LEFT JOIN expected USING (task)"""
)
def baseline_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = (
        table(spark, sf_dir, "events").filter(F.col("event_type") != "view")
        .groupBy(F.col("event_type").alias("task")).agg(F.max("value").alias("expected"))
    )
    return B.baseline_gap(B.primary_metric(normalised(spark, sf_dir), "leaderboard"), expected)


# ---- tasks


def valid_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.concat_ws("_", F.lower("p_type"), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("task"))


VALID_SQL = "valid AS (SELECT DISTINCT lower(p_type) || '_' || replace(p_name, ' ', '_') AS task FROM part)"


def asked_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and types of parts, whole names, and customer segments."""
    part = table(spark, sf_dir, "part")
    words = part.select(F.explode(F.split("p_name", " ")).alias("task"))
    types = part.select(F.col("p_type").alias("task"))
    segments = table(spark, sf_dir, "customer").select(F.concat(F.lit("Truthful_"), F.col("c_mktsegment")).alias("task"))
    return words.union(types).union(valid_names(spark, sf_dir)).union(segments)


ASKED_SQL = f"""{VALID_SQL}, asked AS (SELECT unnest(string_split(p_name, ' ')) AS task FROM part
  UNION SELECT p_type FROM part UNION SELECT task FROM valid UNION SELECT 'Truthful_' || c_mktsegment FROM customer),
invalid AS (SELECT task FROM asked WHERE task NOT IN (SELECT task FROM valid))"""


@query(f"WITH {ASKED_SQL} SELECT task FROM invalid")
def invalid_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.invalid_tasks(asked_names(spark, sf_dir), valid_names(spark, sf_dir))


@query(
    f"""WITH {ASKED_SQL}, alike AS (SELECT i.task, v.task AS suggestion,
    row_number() OVER (PARTITION BY i.task ORDER BY v.task) AS rank
  FROM invalid i JOIN valid v ON contains(lower(v.task), lower(i.task)) WHERE NOT contains(lower(i.task), 'truthful'))
SELECT task, suggestion, CAST(rank AS INTEGER) AS rank FROM alike WHERE rank <= 3
UNION ALL SELECT task, unnest(['truthfulqa_mc1', 'truthfulqa_mc2']), unnest([1, 2]) FROM invalid
WHERE contains(lower(task), 'truthful')"""
)
def suggest_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = valid_names(spark, sf_dir)
    return B.suggest_tasks(B.invalid_tasks(asked_names(spark, sf_dir), valid), valid)


@query(
    """SELECT event_type AS task, event_id AS id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id)
  AS INTEGER) AS rank FROM events QUALIFY rank <= 5"""
)
def limit_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.limit_per_task(
        table(spark, sf_dir, "events").select(F.col("event_type").alias("task"), F.col("event_id").alias("id"))
    )


@query(
    """WITH rows AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN '|---|' || p_name || '|'
  WHEN 'PROMO' THEN '  | Group ' || p_name || ' | x |' WHEN 'SMALL' THEN p_name || '|' || p_brand
  ELSE ' | ' || replace(p_name, ' ', '_') || '_' || p_partkey || ' | ' || p_brand || ' |' END AS line FROM part)
SELECT trim(string_split(trim(line), '|')[2]) AS task FROM rows
WHERE starts_with(trim(line), '|') AND NOT contains(line, '---') AND NOT contains(line, 'Group')"""
)
def parse_task_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, name = F.col("p_type"), F.col("p_name")
    line = (
        F.when(kind == "ECONOMY", F.concat(F.lit("|---|"), name, F.lit("|")))
        .when(kind == "PROMO", F.concat(F.lit("  | Group "), name, F.lit(" | x |")))
        .when(kind == "SMALL", F.concat(name, F.lit("|"), F.col("p_brand")))
        .otherwise(
            F.concat(F.lit(" | "), F.replace(name, F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey"),
                     F.lit(" | "), F.col("p_brand"), F.lit(" |"))
        )
    )
    return listings.parse_task_table(table(spark, sf_dir, "part").select(line.alias("value")))


# ---- logs


@query(
    """WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
SELECT doc_id, pos AS line_no, line FROM lines WHERE NOT contains(line, 'tion') AND NOT contains(line, 'sch')"""
)
def filter_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents, with common syllables as the noise."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    kept = logs.filter_log_lines(lines, noise=("tion", "sch"))
    return kept.select("doc_id", F.col("pos").cast("bigint").alias("line_no"), "line")


def failure_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as logs; the last line depends on the source, and some repeat their text after it."""
    message = (
        F.when(F.col("source") == "src0", "No module named 'rouge_score'")
        .when(F.col("source") == "src1", "torch.OutOfMemoryError: CUDA out of memory")
        .when(F.col("source") == "src2", "FileNotFoundError: x.json")
        .when(F.col("source") == "src3", "tokenizer.chat_template is not set; No module named x")
        .when(F.col("source") == "src4", "import langdetect: No module named 'langdetect'")
        .otherwise("exit 1")
    )
    tail = F.when(F.col("lang") == "de", F.col("text")).otherwise("")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.col("text"), F.lit("\n"), message, F.lit("\n"), tail).alias("log")
    )


LOGS_SQL = """logs AS (SELECT doc_id, text || chr(10) || CASE source WHEN 'src0' THEN 'No module named ''rouge_score'''
  WHEN 'src1' THEN 'torch.OutOfMemoryError: CUDA out of memory' WHEN 'src2' THEN 'FileNotFoundError: x.json'
  WHEN 'src3' THEN 'tokenizer.chat_template is not set; No module named x'
  WHEN 'src4' THEN 'import langdetect: No module named ''langdetect''' ELSE 'exit 1' END || chr(10) ||
  CASE lang WHEN 'de' THEN text ELSE '' END AS log FROM documents), tails AS (SELECT doc_id, right(log, 2000) AS t FROM logs)"""


@query(
    f"""WITH {LOGS_SQL}, classed AS (SELECT doc_id, t, CASE WHEN contains(t, 'langdetect') THEN 'langdetect'
  WHEN contains(t, 'No module named') THEN 'missing_module'
  WHEN contains(t, 'CUDA out of memory') OR contains(t, 'OutOfMemoryError') THEN 'out_of_memory'
  WHEN contains(t, 'No such file or directory') OR contains(t, 'FileNotFoundError') THEN 'missing_file'
  WHEN contains(t, 'tokenizer.chat_template is not set') THEN 'no_chat_template' ELSE 'other' END AS failure FROM tails)
SELECT doc_id, failure, CASE WHEN failure = 'missing_module' THEN CASE WHEN contains(t, 'No module named ''')
  THEN split_part(split_part(t, 'No module named ''', 2), '''', 1) ELSE 'unknown' END END AS module FROM classed"""
)
def triage_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.triage_failures(failure_logs(spark, sf_dir)).drop("log")


@query("SELECT page_id, regexp_matches(lower(html), 'length|token|sequence|size|exceed|overflow') AS length_error FROM pages")
def is_length_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", names_length_error(F.col("html")).alias("length_error"))
