"""Chain files of genome alignments as tables of ungapped blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sequences import in_sections, numbered_lines


def read_chain(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Blocks (chain, chrom, block_start, block_end, target_chrom, target_start, target_strand, target_size, score) for
    `operators.variants.lift_over`.

    A header names the chain's ends; its lines give a block's size and the gaps to the next on either side. A block's
    place is the sum of the sizes and gaps before it in its chain (see `sequences.in_sections`), so a file is read in
    splits. Chains without a number are counted in their file. Comments and blank lines are passed over.
    """
    f = F.split(F.trim("value"), r"\s+")
    lines = numbered_lines(spark, paths).where("trim(value) != '' AND NOT startswith(value, '#')").select("file", "line_no", f.alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    number = lambda i: at(i).try_cast("long")
    head = F.struct(number(1).alias("score"), at(2).alias("chrom"), number(5).alias("start"), at(7).alias("target"), number(8).alias("size"), at(9).alias("strand"), number(10).alias("target_start"), number(12).alias("id"))
    lines = lines.withColumn("head", F.when(at(0) == "chain", head))
    size = F.when(F.col("head").isNull(), number(0))
    rows = in_sections(lines.withColumn("size", size), "head", {"before": F.col("size") + F.coalesce(number(1), F.lit(0)), "target_before": F.col("size") + F.coalesce(number(2), F.lit(0))})
    start, other = F.col("head.start") + F.col("before"), F.col("head.target_start") + F.col("target_before")
    return rows.where("size IS NOT NULL").select(
        F.coalesce("head.id", "no").alias("chain"), "head.chrom", start.alias("block_start"), (start + F.col("size")).alias("block_end"), F.col("head.target").alias("target_chrom"), other.alias("target_start"),
        F.col("head.strand").alias("target_strand"), F.col("head.size").alias("target_size"), "head.score",
    )
