"""Session settings and the shared folder in which intermediate tables are cut off."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tuneframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC timestamps.

    Nothing here fixes a partition count: AQE merges small shuffle partitions and
    splits skewed ones, so ``spark.sql.shuffle.partitions`` only has to be high
    enough for the largest job of the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which driver and executors have to share.

    Where none is named, a temporary one is taken if the master is local, and else this fails.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError(f"name a folder that all executors share in {CHECKPOINT_KEY}")
        named = tempfile.mkdtemp(prefix="tuneframe-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have a path of intermediate tables removed when the driver ends, by the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so that later reads see the same rows.

    Needed where a column depends on row placement (``spark_partition_id``): a lost
    executor must not make Spark place the rows anew.
    """
    folder = shared_dir(df.sparkSession)  # of this application's own, below the named one
    settled = df.checkpoint(eager=True)
    remove_at_end(df.sparkSession, folder)
    return settled
