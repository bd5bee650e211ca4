"""Evaluation result documents, in and out."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.operators.evals import BASE, TUNED, summary

# Fixed value: where a result file lies below the output root.
RESULT_PATH = r"([^/]+)/benchmarks/(base|fine-tuned)/(?:([^/]+)/)?lm-eval/(?:.*/)?(results(?:_[^/]*)?\.json)$"

# The same below a root that Spark has written with the parts as partition columns.
PARTITIONED_PATH = r"model=([^/]+)/variant=(base|fine-tuned)/run_ts=(?:__HIVE_DEFAULT_PARTITION__|([^/]+))/file=([^/]+)/part-[^/]*$"

# Numbers only: texts such as "N/A" and booleans are no scores.
_NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _files(spark: SparkSession, paths: str | list[str], layout: str, glob: str, *more: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(paths)
    part = lambda i: F.regexp_extract("path", layout, i)
    return found.filter(F.col("path").rlike(layout)).select(
        part(1).alias("model"),
        F.when(part(2) == "base", BASE).otherwise(TUNED).alias("variant"),
        F.nullif(part(3), F.lit("")).alias("run_ts"),
        part(4).alias("file"),
        F.col("modificationTime").alias("modified"),
        *([F.col("content").cast("string").alias("body")] if "body" in more else []),
        *(["path"] if "path" in more else []),
    )


def list_eval_results(spark: SparkSession, root: str, layout: str = RESULT_PATH, glob: str = "results*.json") -> DataFrame:
    """``(model, variant, run_ts, file, modified, path)`` for every result file below the root; no file is opened.

    ``layout`` finds model, variant, run and file name in a path, ``glob`` the names of files to look at.
    """
    return _files(spark, root, layout, glob, "path")


def read_eval_results(
    spark: SparkSession, root: str, layout: str = RESULT_PATH, glob: str = "results*.json", chosen: DataFrame | None = None
) -> DataFrame:
    """``(model, variant, run_ts, file, modified, body)`` for every result file below the root, or for those ``chosen`` from its list.

    Files that are not chosen are not opened: the others are named to the reader one by one. Their paths
    go through the driver, which has listed all paths of the folder before.
    """
    if chosen is None:
        return _files(spark, root, layout, glob, "body")
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in chosen.select("path").collect()]
    everything = _files(spark, paths or root, layout, glob, "body")
    return everything if paths else everything.limit(0)


def one_file_per_run(files: DataFrame, by: str = "file") -> DataFrame:
    """Of several files in a run the greatest by name, or with ``modified`` the newest.

    Only names are compared in the aggregation; the bodies are fetched by a join with
    its result.
    """
    key = ["model", "variant", "__run"]
    named = files.withColumn("__run", F.coalesce("run_ts", F.lit("")))
    # a legacy file without a time in its name counts only where there is no other
    order = F.struct((F.col("file") != "results.json").alias("timed"), F.col(by).alias("by"), F.col("file"))
    chosen = named.groupBy(*key).agg(F.max(order).alias("__best")).select(*key, F.col("__best.file").alias("file"))
    return named.join(chosen, [*key, "file"], "left_semi").select(*files.columns)


def task_results(document: Column) -> Column:
    """The task map of a result document: new shape, else legacy shape, else null."""
    return F.coalesce(
        F.try_variant_get(document, "$.results", "variant"), F.try_variant_get(document, "$.huggingface", "variant")
    )


def parse_eval_results(files: DataFrame, *keep: str, body: str = "body") -> DataFrame:
    """One row per numeric metric: ``keep`` columns, ``task``, ``key`` and ``value``.

    Documents that are no JSON give no rows; ``count_malformed`` counts them.
    """
    spark = files.sparkSession
    tasks = files.withColumn("__tasks", task_results(F.try_parse_json(body))).select(*keep, "__tasks")
    per_task = tasks.lateralJoin(spark.tvf.variant_explode(F.col("__tasks").outer())).select(
        *keep, F.col("key").alias("task"), F.col("value").alias("__metrics")
    )
    per_metric = per_task.lateralJoin(spark.tvf.variant_explode(F.col("__metrics").outer())).select(
        *keep, "task", "key", "value"
    )
    return per_metric.filter(F.schema_of_variant("value").rlike(_NUMERIC)).withColumn(
        "value", F.try_variant_get("value", "$", "double")
    )


def count_malformed(files: DataFrame, body: str = "body") -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.try_parse_json(body).isNull()).alias("malformed")
    )


def summary_documents(scores: DataFrame, names: DataFrame, timestamp: str) -> DataFrame:
    """The nested summary of each model, one document per row.

    ``names(model, base_model_name)`` has one row per model. A model's result map
    holds each task and metric once, so its size is bound by the task list.
    """
    key = ["model", "variant", "run_ts", "task"]
    per_task = scores.groupBy(*key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("metrics")
    )
    per_side = per_task.groupBy("model", "variant").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("task", F.map_entries("metrics").alias("m"))))).alias("r"),
        F.max("run_ts").alias("run_ts"),
    )
    side = lambda v: F.max_by(
        F.struct(F.transform_values("r", lambda _, m: F.map_from_entries(m)).alias("results"), F.col("run_ts").alias("timestamp")),
        F.when(F.col("variant") == v, F.lit(1)),
    )
    sides = per_side.groupBy("model").agg(side(BASE).alias("base_model"), side(TUNED).alias("fine_tuned_model"))
    parts = summary(scores).select("model", "comparison")
    return (
        sides.join(parts, "model", "left")
        .join(names, "model", "left")
        .select(
            F.col("model").alias("model_name"),
            "base_model_name",
            F.lit(timestamp).alias("timestamp"),
            "base_model",
            "fine_tuned_model",
            "comparison",
        )
    )


def write_benchmark_summary(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)
