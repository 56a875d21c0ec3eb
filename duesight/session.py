"""Session settings the jobs rely on, and tables stored between jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Joins from documents to projects and customers meet hot keys. AQE splits such
# partitions even where that costs one more shuffle above the join.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on the caller's session, for good; sizing stays with the cluster."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``. Only a local session without it gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        return tempfile.mkdtemp(prefix="duesight-")
    return f"{folder.rstrip('/')}/duesight-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What an execution inside has shuffled is deleted when it ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Stored:
    """``rows`` written once to a folder that all executors share, and read back from there as ``frame``.

    Its readers share one computation, read only the columns they need, survive
    the loss of executors, and know its size when they choose a join. Further ``more`` rows with the same columns are written
    after them, each frame by itself, so that the shuffles of one don't lie beside those of the next.
    """

    def __init__(self, rows: DataFrame, folder: str, name: str, *more: DataFrame):
        self._spark, self.path = rows.sparkSession, f"{folder.rstrip('/')}/{name}-{uuid.uuid4()}"
        for frame in (rows, *more):
            frame.write.mode("append").parquet(self.path)
        self.frame = self._spark.read.schema(rows.schema).parquet(self.path)

    def delete(self) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
