"""Loss histories and run metrics on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOSS_COLUMNS = ("step", "epoch", "loss", "learning_rate", "grad_norm")
LOSS_SCHEMA = "step BIGINT, epoch DOUBLE, loss DOUBLE, learning_rate DOUBLE, grad_norm DOUBLE"

RUN_SCHEMA = T.StructType(
    [
        T.StructField("training_time_seconds", T.DoubleType()),
        T.StructField("training_time_minutes", T.DoubleType()),
        T.StructField("final_loss", T.DoubleType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("dataset_samples", T.LongType()),
        T.StructField("dataset_max_samples", T.LongType()),
        T.StructField("total_steps", T.LongType()),
        T.StructField("lora_rank", T.IntegerType()),
        T.StructField("lora_alpha", T.IntegerType()),
        T.StructField("lora_dropout", T.DoubleType()),
        T.StructField("use_rslora", T.BooleanType()),
        T.StructField("max_seq_length", T.IntegerType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("gradient_accumulation_steps", T.IntegerType()),
        T.StructField("effective_batch_size", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("warmup_ratio", T.DoubleType()),
        T.StructField("warmup_steps", T.IntegerType()),
        T.StructField("actual_warmup_steps", T.IntegerType()),
        T.StructField("num_train_epochs", T.IntegerType()),
        T.StructField("max_steps", T.IntegerType()),
        T.StructField("packing", T.BooleanType()),
        T.StructField("max_grad_norm", T.DoubleType()),
        T.StructField("optimizer", T.StringType()),
        T.StructField("use_gradient_checkpointing", T.BooleanType()),
        T.StructField("seed", T.LongType()),
        T.StructField("max_vram_bytes", T.LongType()),
        T.StructField("max_vram_gb", T.DoubleType()),
        T.StructField("trained_date", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# What a run without the entry is taken to have used.
RUN_DEFAULTS = {
    "model_name": "unknown",
    "dataset_name": "unknown",
    "max_seq_length": 4096,
    "lora_rank": 16,
    "lora_alpha": 32,
    "batch_size": 2,
    "gradient_accumulation_steps": 4,
    "learning_rate": 0.0002,
    "num_train_epochs": 1,
    "max_steps": 0,
    "dataset_max_samples": 0,
    "packing": False,
    "training_time_minutes": 0.0,
    "final_loss": 0.0,
}


def write_loss_history(log: DataFrame, path: str, run: str = "run", per_run: bool = False) -> None:
    """CSV with a header and the run as last column; missing numbers stay empty.

    ``per_run`` makes a folder for each run instead, which suits few runs.
    """
    ordered = log.select(*LOSS_COLUMNS, F.col(run).alias("run"))
    writer = ordered.write.mode("overwrite").option("header", True)
    (writer.partitionBy("run") if per_run else writer).csv(path)


def read_loss_history(spark: SparkSession, path: str) -> DataFrame:
    """The five columns, and the run from its column or folder name, null where there is none."""
    return spark.read.schema(LOSS_SCHEMA + ", run STRING").option("header", True).csv(path)


def with_defaults(runs: DataFrame) -> DataFrame:
    return runs.fillna(RUN_DEFAULTS)


def read_runs(spark: SparkSession, path: str, file: str = "training_metrics.json") -> DataFrame:
    """One row per metrics file below the path, with its folder as ``run``."""
    raw = (
        spark.read.schema(RUN_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file)
        .json(path)
    )
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return with_defaults(raw.withColumn("run", folder))


def parse_runs(documents: DataFrame, *keep: str, body: str = "body") -> DataFrame:
    """The same from a column of JSON texts."""
    parsed = documents.select(*keep, F.from_json(body, RUN_SCHEMA).alias("__run")).select(*keep, "__run.*")
    return with_defaults(parsed)
