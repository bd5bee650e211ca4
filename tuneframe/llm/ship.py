"""The package on the executors, and keys on their way through pandas."""

from __future__ import annotations

import gc
import io
import pathlib
import tempfile
import time
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tuneframe

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(tuneframe.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"tuneframe/{path.relative_to(root)}")
    target = pathlib.Path(tempfile.mkdtemp(prefix="tuneframe-")) / "tuneframe.zip"
    target.write_bytes(packed.getvalue())
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


_held: dict[str, Callable[[], object]] = {}


def hold(name: str, forget: Callable[[], object]) -> None:
    """Said in a task before its operator's tables are used: those that the worker holds of another are let go of.

    Workers go from stage to stage, so tables that stay with them are there while other operators run.
    """
    for other in [x for x in _held if x != name]:
        _held.pop(other)()
    _held[name] = forget


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that are over.

    Spark removes them when the driver collects the plans that made them, which on a
    driver with little to do is much later than the files fill the executors' disks. Asking
    for that is no promise of Spark's: nothing depends on it but the disk in use. Python's share goes first and
    reaches the JVM by itself, so it is asked twice.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def as_key(name: str) -> Column:
    """A key as text, because numbers beside nulls lose digits in pandas."""
    return F.col(f"`{name}`").cast("string").alias("key")


def with_key(made: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """`made` with its text column `key` turned back into the named column of `source`, first."""
    rest = [c for c in made.columns if c != "key"]
    return made.select(F.col("key").cast(source.schema[name].dataType).alias(name), *rest)
