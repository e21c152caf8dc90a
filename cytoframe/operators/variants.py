"""Variants: selection, overlap, natural order, merging, lift-over."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import names
from .intervals import join_overlapping, overlapping


def bisulfite_prone(variants: DataFrame) -> DataFrame:
    return variants.where("(ref = 'C' AND alt = 'T') OR (ref = 'G' AND alt = 'A')")


def to_bed(variants: DataFrame) -> DataFrame:
    return variants.select("chrom", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"), "id")


def in_regions(variants: DataFrame, bed: DataFrame) -> DataFrame:
    """Variants of which any reference base lies in a region (0-based half-open), once each."""
    at = variants.withColumn("_s", F.col("pos") - 1).withColumn("_t", F.col("pos") - 1 + F.length("ref"))
    return overlapping(at, bed, start="_s", end="_t").drop("_s", "_t")


def natural_sort(variants: DataFrame) -> DataFrame:
    return variants.orderBy(*names.natural_key(F.col("chrom")), "pos", "id")


def concatenate(*calls: DataFrame) -> DataFrame:
    """Calls of several files, which may overlap, in natural order; repeated calls stay."""
    every = calls[0]
    for more in calls[1:]:
        every = every.unionByName(more)
    return natural_sort(every)


def windows(contigs: DataFrame, size: int = 100_000) -> DataFrame:
    """(chrom, start_pos, end_pos): contigs (chrom, length) cut every `size` bases, 0-based half-open."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start_pos")
    return contigs.where("length > 0").select("chrom", "length", start).select("chrom", "start_pos", F.least(F.col("start_pos") + size, "length").alias("end_pos"))


def merge_samples(variants: DataFrame) -> DataFrame:
    """Sites of several samples' calls (sample, chrom, pos, ref, alt): alleles and samples of each, sorted."""
    g = variants.groupBy("chrom", "pos", "ref").agg(F.array_sort(F.collect_set("alt")).alias("alts"), F.array_sort(F.collect_set("sample")).alias("samples"))
    return g.select("chrom", "pos", "ref", F.array_join("alts", ",").alias("alt"), F.array_join("samples", ",").alias("samples"))


def merge_genotypes(calls: DataFrame) -> DataFrame:
    """(chrom, pos, ref, alts, genotypes): one row for each site of several samples' calls (sample, chrom, pos, ref,
    alts array, genotype such as 0/1).

    Alleles of all samples are sorted; each sample's genotype is numbered anew by them. Missing calls (.) stay so,
    and a sample without a call has no entry. Of several calls of a sample at a site the smallest counts.
    """
    alts = F.array_sort(F.array_distinct(F.flatten(F.collect_set("alts")))).alias("all")
    by = ["chrom", "pos", "ref"]
    sites = calls.groupBy(*by).agg(alts)
    allele = lambda x: F.when(x == ".", F.lit(".")).when(x == "0", F.lit("0")).otherwise(F.array_position("all", F.element_at("alts", x.try_cast("int"))).cast("string"))
    sep = F.when(F.contains("genotype", F.lit("|")), F.lit("|")).otherwise(F.lit("/"))
    rows = calls.join(sites, by).withColumn("g", F.array_join(F.transform(F.split("genotype", "[/|]"), allele), "\x01"))
    rows = rows.withColumn("g", F.replace("g", F.lit("\x01"), sep)).groupBy(*by, "all", "sample").agg(F.min("g").alias("g"))
    g = rows.groupBy(*by, "all").agg(F.array_sort(F.collect_list(F.struct("sample", "g"))).alias("c"))
    return g.select(*by, F.col("all").alias("alts"), F.map_from_entries("c").alias("genotypes"))


def lift_over(bed: DataFrame, blocks: DataFrame, min_match: float = 0.95, bin_size: int = 10_000) -> DataFrame:
    """Intervals (chrom, start_pos, end_pos, ...), once for each row, with the target of their best chain, else null.

    blocks: chain, score, chrom, block_start, block_end, target_chrom, target_start, target_strand ('+' or '-'),
    target_size; the ungapped parts of each chain. A chain takes an interval of which it aligns at least `min_match`;
    the target reaches from its first to its last aligned base, gaps included. Of several chains that with the
    highest score wins, then the smallest number. Empty intervals have no target. Equal rows are lifted once.
    """
    every = list(bed.columns)
    rows = bed.groupBy(*every).agg(F.count("*").alias("_n"))
    met = join_overlapping(rows, blocks, bin_size, b=("block_start", "block_end"))
    low, high = F.greatest("start_pos", "block_start"), F.least("end_pos", "block_end")
    met = met.select(*every, "chain", "score", "target_chrom", "target_strand", "target_size", low.alias("lo"), high.alias("hi"), (F.col("target_start") - F.col("block_start")).alias("shift"))
    g = met.groupBy(*every, "chain", "score", "target_chrom", "target_strand", "target_size").agg(
        F.sum(F.col("hi") - F.col("lo")).alias("bases"), F.min(F.col("lo") + F.col("shift")).alias("a"), F.max(F.col("hi") + F.col("shift")).alias("b")
    )
    g = g.where(F.col("bases") >= min_match * (F.col("end_pos") - F.col("start_pos")))
    forward = F.col("target_strand") == "+"
    t = F.struct(
        F.col("score"), (-F.col("chain")).alias("order"), "target_chrom",
        F.when(forward, F.col("a")).otherwise(F.col("target_size") - F.col("b")).alias("target_from"), F.when(forward, F.col("b")).otherwise(F.col("target_size") - F.col("a")).alias("target_to"),
    )
    best = g.groupBy(*every).agg(F.max(t).alias("t")).select(*[F.col(c).alias(f"_{c}") for c in every], "t")
    same = F.lit(True)
    for c in every:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = rows.join(best, same, "left")
    return out.select(*every, "t.target_chrom", "t.target_from", "t.target_to", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_k")).drop("_k")
