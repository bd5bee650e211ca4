"""Row-local operators over files as they arrive; none keeps state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tuneframe.functions.templates import ChatTemplate
from tuneframe.functions.text import LengthLimits
from tuneframe.operators.logs import filter_log_lines
from tuneframe.plans.prepare import prepare_samples


def stream_samples(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    limits: LengthLimits,
    template: str | ChatTemplate = "chatml",
    source: str = "parquet",
) -> DataFrame:
    """Prepared samples from a folder that new files are added to."""
    return prepare_samples(spark.readStream.schema(schema).format(source).load(path), limits, template)


def stream_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log lines without the noise, from a folder that log files are added to."""
    return filter_log_lines(spark.readStream.text(path).withColumnRenamed("value", "line"))
