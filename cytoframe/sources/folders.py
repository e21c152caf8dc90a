"""The folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a local folder for a local master; on a cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def until_exit(spark: SparkSession, place: str) -> None:
    """The driver's file system removes the folder, which is there already, when its JVM ends; results may read it till then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for what is executed inside; those of before come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: What an execution has shuffled goes when it ends, not when the driver happens to collect garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def removed(spark: SparkSession, place: str) -> None:
    """Frees a folder that no later plan reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """The rows as a table of the shared folder (or of the folder `at`), where later plans read them again and find the same ones."""
    path = f"{at}/{name}" if at else f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with settings(df.sparkSession, DROP_SHUFFLES):
        df.write.parquet(path)
    until_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
