"""The region pipeline from text files: methylation files and binned gene intervals to profiles of groups of cells."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import names
from ..operators import intervals, methylation as me, sites
from ..sources import tables
from ..sources.folders import DROP_SHUFFLES, removed, settings, shared_folder, written
from .config import PipelineConfig

BIN = 1000  # the lowest width of the bins in which sites and intervals meet
WRITERS = 256  # result tables that a task keeps open
#: Rows that are written to open tables need no sort; a task reads few intervals, as each becomes a row for every file.
WRITING = {"spark.sql.maxConcurrentOutputFileWriters": str(WRITERS), "spark.sql.files.maxPartitionBytes": "16m", **DROP_SHUFFLES}


@dataclass(frozen=True)
class Profiles:
    """What the pipeline returns: sums by cell, context, region, strand side and interval; and the profile of each group
    over the regions' bins, one region behind the other. Both are read, lazily, from one written table of the intervals,
    each with the sums of the cells that have a site in it."""

    region_rows: DataFrame
    profiles: DataFrame


def cell_of(path: str, config: PipelineConfig) -> tuple[str, str] | None:
    """The cell and the context label of a methylation file's name; None without a configured context."""
    name = path.rstrip("/").rsplit("/", 1)[-1].rsplit("=", 1)[-1]
    label = config.context_of(name)
    if label is None:
        return None
    cell = re.sub(r"\.allc\.tsv(\.gz)?$", "", name)
    for c in config.contexts:
        cell = cell.replace(f".{c}", "")
    return cell, label


def calls(spark: SparkSession, paths: list[str], config: PipelineConfig) -> DataFrame:
    """The sites of every cell and context with their order in the file; files without a configured context are not read."""
    rows = tables.read_allc(spark, [p for p in paths if cell_of(p, config)], strict=False)
    # a file, or a folder of part files; by plain functions, as a pattern would search each row's whole path
    of = lambda part: [F.endswith(part, F.lit(f".allc.tsv{end}")) for end in ("", ".gz")]
    own, folder = F.substring_index("file", "/", -1), F.substring_index(F.substring_index("file", "/", -2), "/", 1)
    name = F.substring_index(F.when(of(folder)[0] | of(folder)[1], folder).otherwise(own), "=", -1)
    plain, gzip = of(name)
    cell = F.when(plain, F.left(name, F.length(name) - 9)).when(gzip, F.left(name, F.length(name) - 12)).otherwise("")
    for c in config.contexts:
        cell = F.replace(cell, F.lit(f".{c}"), F.lit(""))
    rows = rows.select(cell.alias("sample"), names.first_context(name, config.contexts).alias("context"), "chrom", "pos", "mc", "cov", "ord")
    return rows


def genes(spark: SparkSession, config: PipelineConfig, base: int = 1) -> DataFrame:
    """The intervals of all configured regions: region, rid, chrom, start_pos, end_pos, bin, gene_name, strand_side."""
    every = None
    for name, region in config.regions.items():
        rows = tables.read_stranded_bed(spark, region.bed_file, region.strand_column, base, *region.strand_values)
        part = me.gene_bins(rows.select("cols", "strand_side"), "strand_side").withColumn("region", F.lit(name))
        every = part if every is None else every.unionByName(part)
    return every.where("start_pos IS NOT NULL AND end_pos IS NOT NULL")


def run(spark: SparkSession, allc_paths: list[str], config: PipelineConfig, matrix_path: str, metadata_path: str | None, context: str, base: int = 1) -> Profiles:
    """From files to profiles. matrix_path: genes by cells, the value `transcribed` marks a cell's genes; metadata_path:
    columns barcode and group (each cell is its own group without it); context: the label to profile. The files are named on
    the driver; without one of a configured context there is nothing to profile, which is an error."""
    files = sorted({c for p in allc_paths if (c := cell_of(p, config))})
    if not any(x == context for _, x in files):
        raise ValueError(f"no file of context {context}")
    known = genes(spark, config, base)
    span = ["region", "strand_side", "chrom", "start_pos", "end_pos", "bin"]
    # intervals and files travel as numbers, which the written table fixes; in the order of intervals tables are half as large
    ranged = known.repartitionByRange(*span).groupBy(*span).agg(F.count("*").alias("w")).sortWithinPartitions(*span)
    at = f"{shared_folder(spark)}/steps-{uuid.uuid4().hex}"
    spans = written(ranged.withColumn("sid", F.monotonically_increasing_id()), "spans", at)
    listing = spark.createDataFrame(files, "sample string, context string")
    number = me.numbered(listing)
    sites_ = calls(spark, allc_paths, config).join(F.broadcast(number), listing.columns).select("_i", "chrom", "pos", "mc", "cov", "ord")
    own, bare = ["_i"], spans.select("sid", "chrom", "start_pos", "end_pos")
    last = me.last_call(intervals.lying_in_bins(sites_, bare, "closed", BIN), *own)
    # written between two shuffles, so that the sites' is gone when the sums are shuffled
    parts = written(me.sums_in_bins(last, bare, "sid", "closed", own, BIN), "sums", at)
    found = written(me.with_hits(spans, me.summed(parts, "sid", own), ["sid"]).drop("sid"), "found")
    removed(spark, at)
    # intervals without a site get their zeros here, a row for each file, as the tables are written
    region_id = F.concat("chrom", F.lit(":"), F.col("start_pos").cast("string"), F.lit("-"), F.col("end_pos").cast("string"))
    rows = me.spread(found, listing, "w").select("sample", "context", "region", "strand_side", region_id.alias("region_id"), "bin", F.col("c").alias("total_coverage"), F.col("m").alias("total_methylated"), F.col("n").alias("sites_with_data"))

    matrix = tables.read_matrix(spark, matrix_path)
    expressed = sites.unpivot_matrix(matrix, "gene_name", "transcribed")
    own = found.select("strand_side", "region", "bin", "w", F.inline("_hits")).join(F.broadcast(number.where(F.col("context") == context)), "_i")
    own = own.select("sample", "strand_side", "region", "bin", (F.col("c") * F.col("w")).alias("total_coverage"), (F.col("m") * F.col("w")).alias("total_methylated"))
    nothing = F.lit(0).cast("long")
    zeros = _for_each(found.select("strand_side", "region", "bin").distinct(), listing.where(F.col("context") == context).select("sample"))
    zeros = zeros.select("sample", "strand_side", "region", "bin", nothing.alias("total_coverage"), nothing.alias("total_methylated"))
    binned = me.cell_bins(own.unionByName(zeros), known, expressed, ("region",))
    groups = None
    if metadata_path:
        meta = tables.read_matrix(spark, metadata_path, "_index")
        groups = meta.select("barcode", F.col("group").alias("grp"))
    profile = me.group_profile(binned, groups, config.min_coverage, ("region",)).withColumnRenamed("region", "segment")
    return Profiles(rows, me.combine_segments(profile, [(name, r.n_bins) for name, r in config.regions.items()]))


def _for_each(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Every row for every file; the files come as one array from a subquery, so the plan does not grow with them."""
    listed = files.agg(F.collect_list(F.struct(*files.columns))).scalar()
    return rows.withColumn("_files", listed).select(*[c for c in rows.columns], F.inline("_files"))


def write(result: Profiles, out: str) -> None:
    """Region tables by region, context, strand side and cell, gzipped, as most of their rows are zeros; profiles by group.

    A task keeps up to WRITERS tables open, so that rows are not sorted for it; of more tables the rest is.
    """
    with settings(result.region_rows.sparkSession, WRITING):
        tables.write_tsv(result.region_rows, f"{out}/regions", 3, gzip=True, partition_by=("region", "context", "strand_side", "sample"))
    write_profiles(result, out)


def write_profiles(result: Profiles, out: str) -> None:
    tables.write_tsv(result.profiles, f"{out}/profiles", 3, partition_by=("group",))


def tss_jobs(sheet: DataFrame) -> DataFrame:
    """(allc_path, bed_path, barcode, context, range_start, range_end, strand_col, top_path, bottom_path): the jobs of a
    sample sheet (see JOB_DEFAULTS for absent or blank cells) and where their tables go."""
    jobs = sheet
    for name, value in JOB_DEFAULTS.items():
        now = F.nullif(F.trim(F.col(name)), F.lit("")) if name in sheet.columns else F.lit(None).cast("string")
        jobs = jobs.withColumn(name, F.coalesce(now, F.lit(value)))
    stem = F.concat_ws("/", "out_dir", F.concat_ws(".", "barcode", "context", "category"))
    numbers = [F.col(c).cast("int").alias(c) for c in ("range_start", "range_end", "strand_col")]
    return jobs.select("allc_path", "bed_path", "barcode", "context", *numbers, F.concat(stem, F.lit(".top.tsv")).alias("top_path"), F.concat(stem, F.lit(".bottom.tsv")).alias("bottom_path"))


JOB_DEFAULTS = {"barcode": "sample", "context": "NCG", "category": "NA", "range_start": "-3000", "range_end": "3000", "strand_col": "5"}
