"""Registration of queries and of their SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tuneframe.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that is written and read back."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_files(rows: DataFrame, root: str, *parts: str) -> None:
    """``rows(*parts, value)`` as one file of lines for each combination of ``parts``, in folders named by them as Spark does.

    The files are dealt to as many tasks as shuffles have partitions. Where the root is a plain folder the tasks write them
    as such: Hadoop starts two processes for each file there, to set permissions. Values of parts have to be plain names.
    """
    spark = rows.sparkSession
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *parts)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getUri().getScheme() != "file":
        dealt.write.partitionBy(*parts).text(root)
        return
    folder = place.toUri().getPath()
    named = [F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for p in parts]
    paths = dealt.select(F.concat_ws("/", *named).alias("path"), "value").sortWithinPartitions("path")

    def write(lines) -> None:
        path, out = None, None
        for line in lines:
            if line["path"] != path:
                if out:
                    out.close()
                path = line["path"]
                os.makedirs(f"{folder}/{path}", exist_ok=True)
                out = open(f"{folder}/{path}/part-0", "w", encoding="utf-8", newline="\n")
            out.write((line["value"] or "") + "\n")
        if out:
            out.close()

    files.mkdirs(place)
    paths.foreachPartition(write)
