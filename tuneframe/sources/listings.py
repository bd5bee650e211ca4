"""File listings and task tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fragments of the lines of a task table that hold no task.
TABLE_CHROME = ("---", "Group", "Config Location")


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """``(path, name, length, modified)`` of every file below the root; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("name"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def split_artifact_path(files: DataFrame, root: str) -> DataFrame:
    """Add ``model``, ``area`` and ``depth`` from paths ``<root>/<model>/<area>/...``."""
    inside = F.split(F.substring_index("path", root.rstrip("/") + "/", -1), "/")
    return files.withColumns(
        {"model": F.get(inside, F.lit(0)), "area": F.get(inside, F.lit(1)), "depth": F.size(inside) - 3}
    ).filter(F.col("depth") >= 0)


def parse_task_table(lines: DataFrame, line: str = "value") -> DataFrame:
    """First cells of the rows of a pipe table, sorted; headings and rules are skipped."""
    cleaned = F.btrim(F.col(line), F.lit(" \t\r\n"))
    keep = cleaned.startswith("|")
    for fragment in TABLE_CHROME:
        keep = keep & ~cleaned.contains(fragment)
    cell = F.btrim(F.get(F.split(cleaned, r"\|"), F.lit(1)), F.lit(" \t\r\n"))
    return lines.filter(keep).select(cell.alias("task")).filter(F.length("task") > 0).orderBy("task")


def read_task_list(spark: SparkSession, path: str) -> DataFrame:
    """One task name per line; blank lines are skipped."""
    names = spark.read.text(path).select(F.btrim("value", F.lit(" \t\r\n")).alias("task"))
    return names.filter(F.length("task") > 0).distinct()
