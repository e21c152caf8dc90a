"""What the training-data operators share: tables, the shared scratch folder, local union-find."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..sources.folders import shared_folder, until_exit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Scratch tables made inside `temporary`, by thread.
_MADE: ContextVar[list | None] = ContextVar("scratch", default=None)


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no recomputed lineage.

    Results read them lazily, so an operator can free only what no later plan of its own reads. What is left goes with
    `temporary`, or else when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        if (made := _MADE.get()) is not None:
            made.append(self)

    def write(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", compression).parquet(path)
        until_exit(self.spark, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def observed(self, df: DataFrame, name: str, *measures: Column) -> tuple:
        """`write`, and aggregates of the rows (0 for null) that are observed while they pass, so that no job reads them for it.

        A stage that runs again may be counted twice: it is meant for what is asked of none and of the largest.
        """
        seen, named = Observation(), [m.alias(f"n{k}") for k, m in enumerate(measures)]
        out = self.write(df.observe(seen, *named), name)
        try:
            n = seen.get
        except Py4JJavaError:  # the optimizer saw that no row can come and left the counting out
            n = out.agg(*named).first()
        return out, *(n[f"n{k}"] or 0 for k in range(len(measures)))

    def drop(self, *names: str) -> None:
        """Free tables that no later plan reads."""
        for name in names:
            self._delete(f"{self.root}/{name}")

    def clear(self) -> None:
        self._delete(self.root)

    def _delete(self, place: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary() -> Iterator[None]:
    """Scratch tables that operators of this thread make inside are removed at the end, so what they return must be written by then."""
    made: list[Scratch] = []
    before = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(before)
        for scratch in made:
            scratch.clear()


def give_back() -> None:
    """The system gets what the allocators of the driver's Python still hold of objects that are gone, as of a model's training."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def column(df: DataFrame, name: str) -> Column:
    """A column by its name alone, whatever characters it has."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_row(df: DataFrame, names: tuple[str, ...] | None = None) -> Column:
    """The columns of a row as one struct, so that their names cannot meet an operator's own."""
    return F.struct(*[column(df, c).alias(c) for c in names or df.columns])


def unpacked_row(df: DataFrame, name: str) -> list[Column]:
    return [F.col(name).getField(f.name).alias(f.name) for f in df.schema[name].dataType.fields]


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y): at most per_class labelled training rows of each class, chosen by a hash of the id.

    Only ids are ranked; the texts are then fetched by a join with 2 * per_class ids, which bounds that
    broadcast. An id is one row: of several texts the smallest, of several labels the largest; null labels count for
    nothing, null texts are empty.
    """
    y = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    present = docs.select("doc_id").distinct()
    y = y.join(present, "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit(7)), F.col("doc_id")
    chosen = y.where("y = 1").orderBy(*order).limit(per_class).unionByName(y.where("y = 0").orderBy(*order).limit(per_class))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


def roots(parent: np.ndarray) -> np.ndarray:
    """Each entry's root, by pointer jumping."""
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def link(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Flat union-find after joining i[k] with j[k]; a root is its set's smallest index."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        parent = roots(parent)
