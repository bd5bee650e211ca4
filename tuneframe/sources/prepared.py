"""Prepared datasets: a parquet table beside a one-row table of metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tuneframe.functions.text import LengthLimits
from tuneframe.operators.lengths import add_lengths
from tuneframe.plans.selection import value_at

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("original_samples", T.LongType()),
        T.StructField("valid_samples", T.LongType()),
        T.StructField("max_length", T.IntegerType()),
        T.StructField("avg_length", T.DoubleType()),
        T.StructField("median_length", T.IntegerType()),
        T.StructField("filtered_count", T.LongType()),
        T.StructField("max_seq_length", T.IntegerType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("preprocessing_date", T.StringType()),
    ]
)


def write_prepared(
    samples: DataFrame, path: str, limits: LengthLimits, dataset_name: str, preprocessing_date: str
) -> dict:
    """Check, filter and write rendered samples, and return their metadata.

    Counts, sum and maximum are observed while the table is written, so the samples
    are rendered once. A sample that is too long leaves a row with its length and nothing
    else, so that the median is found among the lengths written, which ``read_prepared`` leaves out.
    """
    before, after = Observation(), Observation()
    counted = samples.observe(before, F.count(F.lit(1)).alias("original"))
    lengths = add_lengths(counted.filter(F.length("text") > 0), limits).observe(
        after,
        F.count(F.lit(1)).alias("total"),
        F.max("length").alias("max"),
        F.sum(F.col("length").cast("bigint")).alias("sum"),
        F.count_if(F.col("length") > limits.max_seq_length).alias("too_long"),
    )
    spark = samples.sparkSession
    _remove(spark, f"{path}/metadata")  # until it is written again, nothing counts as prepared
    fits = F.col("length") <= limits.max_seq_length
    rows = lengths.select(*[F.when(fits, F.col(f"`{c}`")).alias(c) for c in samples.columns if c != "length"], "length")
    rows.write.mode("overwrite").parquet(f"{path}/data")

    stats = after.get
    total, valid = stats["total"], stats["total"] - stats["too_long"]
    counts = spark.read.parquet(f"{path}/data").groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    median = value_at(counts, lambda size: F.floor(size / 2), "length", name="median").first()
    row = {
        "original_samples": before.get["original"],
        "valid_samples": valid,
        "max_length": stats["max"] or 0,
        "avg_length": stats["sum"] / total if total else 0.0,
        "median_length": median["median"] if median else 0,
        "filtered_count": stats["too_long"],
        "max_seq_length": limits.max_seq_length,
        "dataset_name": dataset_name,
        "preprocessing_date": preprocessing_date,
    }
    spark.createDataFrame([row], METADATA_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return row


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """The samples as they were prepared, without those that were too long and the lengths written beside them."""
    return spark.read.parquet(f"{path}/data").filter(F.col("text").isNotNull()).drop("length")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).json(f"{path}/metadata")


def is_prepared(spark: SparkSession, path: str) -> bool:
    """Whether both tables are there; the metadata is written last."""
    try:
        read_prepared(spark, path)
        return not read_metadata(spark, path).isEmpty()
    except AnalysisException:
        return False


def prepare_once(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    limits: LengthLimits,
    dataset_name: str,
    preprocessing_date: str,
    force: bool = False,
) -> DataFrame:
    """Read the prepared table if it exists, else (or if forced) build and write it."""
    if force or not is_prepared(spark, path):
        write_prepared(build(), path, limits, dataset_name, preprocessing_date)
    return read_prepared(spark, path)
