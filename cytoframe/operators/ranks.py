"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.folders import written


def placed(rows: DataFrame, by: list[str], order: list[str | Column], name: str = "place", parts: int | None = None) -> DataFrame:
    """`rows` with their place from 1 within `by`, in `order`; rows that are equal in both take the places of a
    group in any order. Null keys are a group of their own.

    Rows are range-partitioned by (by, order), sorted, and written once with a running id, so that a large group is cut
    into many ranges. The place is the row's id less the smallest of its range, plus the group's rows in earlier ranges:
    sums over one row for each range and group, whose window sees no row of `rows`.
    """
    n = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
    kept = written(ranged.withColumn("_id", F.monotonically_increasing_id()).withColumn("_range", F.spark_partition_id()), "placed")
    counts = kept.groupBy("_range", *by).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    own = [f"_by{i}" for i in range(len(by))]
    offsets = counts.select("_range", *[F.col(c).alias(k) for c, k in zip(by, own)], (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    on = kept["_range"] == offsets["_range"]
    for c, k in zip(by, own):
        on = on & kept[c].eqNullSafe(offsets[k])
    return kept.join(offsets, on).select(*[kept[c] for c in rows.columns], (kept["_id"] + offsets["_shift"]).alias(name))
