"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session without it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="duesight-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: lineage ends here, and losing an executor loses no part."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table this application cut. Results not written yet can't be read afterwards."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _made.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
