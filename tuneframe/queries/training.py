"""Loss histories, run metrics and backups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.operators import runs as M
from tuneframe.operators.evals import compare as compare_scores
from tuneframe.plans.ordered import number_rows
from tuneframe.queries.evaluation import COMPARED_SQL, current_scores
from tuneframe.queries.registry import query, scratch, table, write_files
from tuneframe.sources import runs as S


def loss_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a user as the log of a run; sign-ups are entries without a loss."""
    numbered = number_rows(table(spark, sf_dir, "events"), ["ts", "event_id"], ["user_id"], "step")
    return numbered.select(
        F.col("user_id").alias("run"),
        F.col("step").cast("bigint").alias("step"),
        (F.col("step") / 10).alias("epoch"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("loss"),
        F.lit(2e-4).alias("learning_rate"),
        F.when(F.col("event_type") == "click", F.col("value") / 2).alias("grad_norm"),
    )


LOG_SQL = """log AS (SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
    CASE WHEN event_type <> 'signup' THEN value END AS loss, event_type, value, ts FROM events),
losses AS (SELECT run, step, step / 10 AS epoch, loss, 2e-4 AS learning_rate,
    CASE WHEN event_type = 'click' THEN value / 2 END AS grad_norm FROM log WHERE loss IS NOT NULL)"""


def logged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user, plus runs that logged nothing."""
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run")).agg(
        (F.count(F.lit(1)) + F.col("run") % 3).alias("total_steps"), F.round(F.avg("value"), 6).alias("train_loss")
    )
    silent = table(spark, sf_dir, "customer").select(
        (-F.col("c_custkey") - 1).alias("run"), F.lit(7).cast("bigint").alias("total_steps"),
        F.col("c_acctbal").alias("train_loss"),
    )
    return events.unionByName(silent)


RUNS_SQL = """runs AS (SELECT user_id AS run, count(*) + user_id % 3 AS total_steps, round(avg(value), 6) AS train_loss
    FROM events GROUP BY user_id
  UNION ALL SELECT -c_custkey - 1, 7, c_acctbal FROM customer)"""


@query(f"WITH {LOG_SQL} SELECT run, step, epoch, loss, learning_rate, grad_norm FROM losses")
def loss_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.loss_rows(loss_log(spark, sf_dir))


@query(f"WITH {LOG_SQL} SELECT run, step, epoch, loss, learning_rate, grad_norm FROM losses")
def loss_history_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "losses")
    S.write_loss_history(M.loss_rows(loss_log(spark, sf_dir)), path)
    return S.read_loss_history(spark, path).withColumn("run", F.col("run").cast("bigint"))


@query(
    f"""WITH {LOG_SQL}, {RUNS_SQL}
SELECT run, step, epoch, loss, learning_rate, grad_norm FROM losses
UNION ALL SELECT l.run, total_steps, epoch, loss, learning_rate, grad_norm
FROM (SELECT * FROM losses QUALIFY row_number() OVER (PARTITION BY run ORDER BY step DESC) = 1) l
JOIN runs USING (run) WHERE step < total_steps"""
)
def append_final_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.append_final_step(loss_log(spark, sf_dir), logged_runs(spark, sf_dir))


@query(
    f"""WITH {LOG_SQL}, {RUNS_SQL}
SELECT run, coalesce((SELECT arg_max(loss, step) FROM losses l WHERE l.run = runs.run), train_loss) AS final_loss
FROM runs"""
)
def final_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.final_loss(loss_log(spark, sf_dir), logged_runs(spark, sf_dir))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a registered run."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("training_time_seconds"),
        F.col("l_linenumber").alias("batch_size"),
        F.lit(4).alias("gradient_accumulation_steps"),
        (F.col("l_partkey") % 3 * 10).cast("int").alias("warmup_steps"),
        (F.col("l_suppkey") + 5).alias("total_steps"),
        (F.col("l_tax") * 2).alias("warmup_ratio"),
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey") * 1_000_000).alias("max_vram_bytes"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice / 60 AS training_time_minutes,
  l_linenumber * 4 AS effective_batch_size,
  CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 3 * 10 ELSE CAST(floor((l_suppkey + 5) * (l_tax * 2)) AS BIGINT) END
    AS actual_warmup_steps,
  CASE WHEN l_returnflag <> 'N' AND l_partkey <> 0 THEN l_partkey * 1000000 / 1073741824.0::DOUBLE END AS max_vram_gb
FROM lineitem"""
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.run_metrics(registry(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "training_time_minutes", "effective_batch_size", "actual_warmup_steps", "max_vram_gb"
    )


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a metrics document; closed orders leave entries out."""
    body = F.to_json(
        F.struct(
            F.concat(F.lit("org/model-"), F.col("o_custkey")).alias("model_name"),
            F.col("o_totalprice").alias("training_time_seconds"),
            F.when(F.col("o_orderstatus") != "F", F.col("o_custkey") % 64 + 1).alias("lora_rank"),
            F.when(F.col("o_orderstatus") != "P", F.lit(1e-4)).alias("learning_rate"),
            F.when(F.col("o_orderstatus") == "O", F.lit(True)).alias("packing"),
        )
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))


@query(
    """SELECT o_orderkey, 'org/model-' || o_custkey AS model_name, o_totalprice AS training_time_seconds,
  CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey % 64 + 1 AS INTEGER) ELSE 16 END AS lora_rank,
  CASE WHEN o_orderstatus <> 'P' THEN 1e-4 ELSE 2e-4 END AS learning_rate, o_orderstatus = 'O' AS packing,
  4096 AS max_seq_length, 'unknown' AS dataset_name FROM orders"""
)
def read_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.parse_runs(run_documents(spark, sf_dir), "o_orderkey").select(
        "o_orderkey", "model_name", "training_time_seconds", "lora_rank", "learning_rate", "packing", "max_seq_length",
        "dataset_name",
    )


@query(
    """SELECT 'run=' || s_suppkey AS run, 'org/model-' || s_nationkey AS model_name, s_acctbal AS training_time_seconds,
  CASE WHEN s_suppkey % 3 = 0 THEN 16 ELSE s_nationkey + 1 END AS lora_rank, 2e-4 AS learning_rate, s_suppkey % 2 = 1 AS packing FROM supplier"""
)
def read_run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as runs, each with a folder that holds its metrics; some leave entries out."""
    root = scratch(spark, "runs")
    body = F.to_json(
        F.struct(
            F.concat(F.lit("org/model-"), F.col("s_nationkey")).alias("model_name"),
            F.col("s_acctbal").alias("training_time_seconds"),
            F.when(F.col("s_suppkey") % 3 != 0, F.col("s_nationkey") + 1).alias("lora_rank"),
            F.when(F.col("s_suppkey") % 2 == 1, True).alias("packing"),
        )
    )
    write_files(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("run"), body.alias("value")), root, "run")
    runs = S.read_runs(spark, root, "part-*")
    return runs.select("run", "model_name", "training_time_seconds", "lora_rank", "learning_rate", "packing")


def backed_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a run that was backed up."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    status = F.col("o_orderstatus")
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order"),
        F.concat(F.lit("m"), F.col("o_custkey")).alias("model"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyyMMdd_HHmmss")).alias("trained_date"),
        F.when(status != "P", day).alias("timestamp"),
        F.when(F.col("o_orderkey") % 5 != 0, F.pow(F.lit(2), F.col("o_custkey") % 6 + 3).cast("int")).alias("lora_rank"),
        F.element_at(F.array(*[F.lit(r) for r in (3e-5, 1e-4, 2.5e-4, 0.002)]), (F.col("o_custkey") % 4 + 1).cast("int"))
        .alias("learning_rate"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice") / 1024).alias("final_loss"),
    )
    return M.add_backup_name(runs)


BACKUPS_SQL = """backups AS (SELECT o_orderkey AS "order", 'm' || o_custkey AS model, o_orderstatus,
  CASE o_orderstatus WHEN 'P' THEN '' ELSE strftime(o_orderdate, '%Y%m%d_%H%M%S') END
  || '_rank' || CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(2 ** (o_custkey % 6 + 3) AS INTEGER) AS VARCHAR) ELSE 'unknown' END
  || '_lr' || ['3e-05', '0.0001', '0.00025', '0.002'][o_custkey % 4 + 1]
  || '_loss' || CASE WHEN o_orderkey % 7 <> 0 THEN printf('%.4f', o_totalprice / 1024) ELSE 'unknown' END AS backup_name
  FROM orders)"""


@query(f'WITH {BACKUPS_SQL} SELECT "order", backup_name FROM backups')
def backup_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backed_up(spark, sf_dir).select("order", "backup_name")


PARTS_SQL = r"""parsed AS (SELECT *, string_split(backup_name, '_') AS p FROM named),
parts AS (SELECT *, CASE WHEN length(p[1]) = 8 THEN p[1][1:4] || '-' || p[1][5:6] || '-' || p[1][7:8] ELSE 'unknown' END AS date,
  CASE WHEN length(p[2]) = 6 THEN p[2][1:2] || ':' || p[2][3:4] || ':' || p[2][5:6] ELSE 'unknown' END AS time,
  CASE WHEN regexp_matches(backup_name, '^[^_]*_[^_]*.*_rank') THEN regexp_extract(backup_name, '^[^_]*_[^_]*.*_rank([^_]*)', 1)
  ELSE 'unknown' END AS rank,
  CASE WHEN regexp_matches(backup_name, '^[^_]*_[^_]*.*_lr') THEN regexp_extract(backup_name, '^[^_]*_[^_]*.*_lr([^_]*)', 1)
  ELSE 'unknown' END AS lr,
  CASE WHEN regexp_matches(backup_name, '^[^_]*_[^_]*.*_loss') THEN regexp_extract(backup_name, '^[^_]*_[^_]*.*_loss([^_]*)', 1)
  ELSE 'unknown' END AS loss FROM parsed)"""


@query(
    f"""WITH {BACKUPS_SQL}, named AS (SELECT "order", CASE WHEN "order" % 9 = 0 THEN substr(backup_name, 1, 15) || '_current'
    ELSE backup_name END AS backup_name FROM backups), {PARTS_SQL}
SELECT "order", backup_name, date, time, rank, lr, loss FROM parts"""
)
def parse_backup_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some names stand for the present state and carry no settings; some have no date."""
    named = backed_up(spark, sf_dir)
    current = F.concat(F.substring("backup_name", 1, 15), F.lit("_current"))
    names = named.select("order", F.when(F.col("order") % 9 == 0, current).otherwise(F.col("backup_name")).alias("backup_name"))
    return M.parse_backup_names(names)


@query(
    f"""WITH {BACKUPS_SQL}, files AS (SELECT model, backup_name, l_extendedprice, l_linenumber FROM backups
  JOIN lineitem ON l_orderkey = "order"),
named AS (SELECT model, backup_name, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS size
  FROM files GROUP BY ALL HAVING bool_or(l_linenumber = 1)), {PARTS_SQL},
metrics AS (SELECT model, backup_name, max("order") AS "order" FROM backups WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT model, backup_name AS backup, size, date, time, rank, lr, loss, "order"
FROM parts LEFT JOIN metrics USING (model, backup_name)"""
)
def list_backups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as the files of a backup; only closed orders kept their metrics."""
    runs = backed_up(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order"),
        F.when(F.col("l_linenumber") == 1, "adapter_config.json")
        .otherwise(F.concat(F.lit("file-"), F.col("l_linenumber")))
        .alias("name"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("length"),
    )
    files = runs.select("order", "model", F.col("backup_name").alias("backup")).join(lines, "order")
    metrics = (
        runs.filter(F.col("trained_date").isNotNull())
        .groupBy("model", F.col("backup_name").alias("backup"))
        .agg(F.max("order").alias("order"))
    )
    return M.list_backups(files, metrics, newest=True)


@query(
    """SELECT user_id AS root, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS modified, 'run-' || arg_max(event_id, (ts, 'run-' || event_id)) AS run
FROM events GROUP BY user_id"""
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("root"), F.col("ts").alias("modified"), F.concat(F.lit("run-"), F.col("event_id")).alias("run")
    )
    newest = M.latest_run(runs, "root", "modified", "run")
    return newest.withColumn("modified", F.date_format("modified", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


HEALTH_SQL = f"""WITH {LOG_SQL}, judged AS (SELECT run, step, loss, lag(loss) OVER w AS previous_loss,
  min(loss) OVER (w ROWS UNBOUNDED PRECEDING) AS best_loss,
  avg(loss) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS m FROM losses
  WINDOW w AS (PARTITION BY run ORDER BY step))
SELECT run, step, loss, previous_loss, best_loss, round(m, 6) AS recent_mean, CASE WHEN m IS NULL THEN 'start'
  WHEN loss > m * 2 THEN 'spike' WHEN abs(loss - m) <= abs(m) * 0.01 THEN 'plateau' WHEN loss > m THEN 'rising'
  ELSE 'falling' END AS health FROM judged"""


def _health(judged: DataFrame) -> DataFrame:
    return judged.select(
        "run", "step", "loss", "previous_loss", "best_loss", F.round("recent_mean", 6).alias("recent_mean"), "health"
    )


@query(HEALTH_SQL)
def loss_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health(M.loss_health(loss_log(spark, sf_dir)))


@query(HEALTH_SQL)
def loss_health_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over many slices, which cut runs as a hot run would be."""
    return _health(M.loss_health(loss_log(spark, sf_dir), slices=64))


@query(
    f"""WITH {COMPARED_SQL}, settings AS (SELECT 'm' || user_id // 2 AS model, 'org/d-' || max(user_id) AS dataset_name,
  CAST(16 * (1 + user_id // 2 % 4) AS INTEGER) AS lora_rank FROM events GROUP BY user_id // 2)
SELECT model, task, metric, delta, delta_percent, dataset_name, 2e-4 AS learning_rate, lora_rank
FROM compared JOIN settings USING (model)"""
)
def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.floor(F.col("user_id") / 2)
    runs = table(spark, sf_dir, "events").groupBy(number.alias("number")).agg(F.max("user_id").alias("last"))
    settings = runs.select(
        F.concat(F.lit("m"), F.col("number")).alias("model"),
        F.concat(F.lit("org/d-"), F.col("last")).alias("dataset_name"),
        F.lit(2e-4).alias("learning_rate"),
        (F.lit(16) * (1 + F.col("number") % 4)).cast("int").alias("lora_rank"),
    )
    return M.compare_runs(settings, compare_scores(current_scores(spark, sf_dir)))
