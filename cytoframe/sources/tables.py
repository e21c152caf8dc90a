"""Text tables of sites and intervals: readers with an explicit policy for malformed rows, and writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.intervals import PLACE
from ..operators.sites import in_order

ALLC = ("chrom string", "pos long", "strand string", "context string", "mc long", "cov long", "flag int")
BED3 = ("chrom string", "start_pos long", "end_pos long")
BED5 = (*BED3, "mc long", "cov long")
PACKED = (*BED3, "strand string", "name string")


@dataclass(frozen=True)
class Policy:
    """What counts as a row: `columns` at least, no line that starts with `comment`; a number that does not parse
    skips the row or, with strict, fails the job."""

    columns: int
    comment: str | None = "#"
    strict: bool = False
    inline_comments: bool = False


def read_table(spark: SparkSession, paths: str | list[str], fields: tuple[str, ...], policy: Policy) -> DataFrame:
    """Tab-separated lines, plain or gzip by suffix, as typed columns with `file` and `ord`, which sorts the rows of a
    file, or of a folder of part files.

    Lines are trimmed, so trailing empty columns do not count. Text that is gzipped is one task a file.
    """
    line = F.trim(F.col("value"))
    if policy.inline_comments and policy.comment:
        line = F.trim(F.substring_index(F.col("value"), policy.comment, 1))
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("int")  # of a folder that Spark wrote in order
    order = F.struct(part.alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("ord")
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), order, line.alias("line")).where("line != ''")
    if policy.comment:
        rows = rows.where(~F.startswith("line", F.lit(policy.comment)))
    rows = rows.withColumn("c", F.split("line", "\t")).where(F.size("c") >= policy.columns)
    out, known = [], F.lit(True)
    for i, field in enumerate(fields):
        name, kind = field.split()
        raw = F.get("c", i)
        if kind == "string":
            out.append(raw.alias(name))
            continue
        value = F.trim(raw).cast(kind) if policy.strict else F.trim(raw).try_cast(kind)
        out.append(value.alias(name))
        if i < policy.columns:
            known = known & F.col(name).isNotNull()
    return rows.select("file", "ord", *out).where(known)


def read_allc(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    return read_table(spark, paths, ALLC, Policy(6, strict=strict))


def read_bed(spark: SparkSession, paths: str | list[str], fields: tuple[str, ...] = BED3) -> DataFrame:
    return read_table(spark, paths, fields, Policy(3))


def read_stranded_bed(spark: SparkSession, paths: str | list[str], strand_column: int, base: int, top: str = "+", bottom: str = "-") -> DataFrame:
    """chrom, start_pos, end_pos, cols and strand_side ('top', 'bottom'); the strand column counts from `base` (0 or 1)."""
    if base not in (0, 1):
        raise ValueError(f"base: {base}")
    rows = spark.read.text(paths).select(F.split(F.trim("value"), "\t").alias("cols")).where(F.size("cols") > max(2, strand_column - base))
    strand = F.col("cols")[strand_column - base]
    side = F.when(strand == top, "top").when(strand == bottom, "bottom")
    at = lambda i: F.col("cols")[i].try_cast("long")
    return rows.select(F.col("cols")[0].alias("chrom"), at(1).alias("start_pos"), at(2).alias("end_pos"), "cols", side.alias("strand_side")).where("strand_side IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL")


def read_sheet(spark: SparkSession, path: str, required: tuple[str, ...], defaults: dict[str, str] | None = None) -> DataFrame:
    """A CSV sheet; missing required columns are an error, absent or blank optional ones take their defaults."""
    sheet = spark.read.option("header", True).csv(path)
    if missing := sorted(set(required) - set(sheet.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    for name, value in (defaults or {}).items():
        now = F.col(name) if name in sheet.columns else F.lit(None).cast("string")
        sheet = sheet.withColumn(name, F.coalesce(F.nullif(F.trim(now), F.lit("")), F.lit(value)))
    return sheet


def read_demux_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The rows under the [data] section of a demultiplexing sheet, of which the first names the columns."""
    lines = spark.read.text(path, wholetext=True)  # a file of tens of lines
    after = F.regexp_replace("value", r"(?is)^.*?(^|\n)\[data\][^\n]*\n", "")
    body = lines.select(F.filter(F.split(after, r"\r?\n"), lambda x: F.trim(x) != "").alias("rows"))
    head = [c.strip() for c in (body.select(F.get("rows", F.lit(0)).alias("h")).first()["h"] or "").split(",")]
    rows = body.select(F.explode(F.slice("rows", 2, 1 << 20)).alias("r")).select(F.split("r", ",").alias("c"))
    return rows.select(*[F.trim(F.get("c", F.lit(i))).alias(h) for i, h in enumerate(head)])


def read_matrix(spark: SparkSession, path: str, key: str = "gene_name") -> DataFrame:
    """A CSV matrix or metadata table whose first column, whatever its title, names the rows: it becomes `key`."""
    table = spark.read.option("header", True).csv(path)
    return table.withColumnRenamed(table.columns[0], key)


def discover(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, dir, name, size) of the files under a folder whose names fit a glob, in the order of their paths. Only the
    listing is read, not the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).load(folder)
    place = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.select("path", place.alias("dir"), F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size")).orderBy("path")


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(name): the non-blank lines of a plain list of samples or paths."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name != ''")


def listed_paths(spark: SparkSession, path: str) -> list[str]:
    """The paths of a list file, in its order, for a reader; a list of files, not of rows."""
    return [r["name"] for r in read_names(spark, path).collect()]


def read_results(spark: SparkSession, folder: str, fields: str) -> DataFrame:
    """Written result tables (tab-separated, with a header, one folder for each partition value); a folder that is
    missing or holds no file gives no rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).option("sep", "\t").option("header", True).option("pathGlobFilter", "*.csv*").csv(folder)


def decimals(value: Column, places: int) -> Column:
    """A double as text, for sinks only; null stays null."""
    return F.call_function("format_number", value, F.lit("0." + "0" * places))


def write_tsv(df: DataFrame, path: str, places: int | None = None, header: bool = True, gzip: bool = False, partition_by: tuple[str, ...] = ()) -> None:
    """Tab-separated text; doubles with `places` decimals, nulls as empty cells; one folder for each value of `partition_by`."""
    out = df.select(*[decimals(F.col(c), places).alias(c) if kind == "double" and places is not None else F.col(c) for c, kind in df.dtypes])
    writer = out.write.option("sep", "\t").option("header", header).option("emptyValue", "").option("compression", "gzip" if gzip else "none")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_sites(sites: DataFrame, path: str, gzip: bool = True) -> None:
    """Sites or intervals in order (see `sites.in_order`), headerless: ALLC and BED files."""
    write_tsv(in_order(sites), path, header=False, gzip=gzip)


def write_clustered(rows: DataFrame, path: str, *by: str, group_bytes: int = 8 << 20) -> None:
    """Parquet whose files hold ranges of `by` one after the other, sorted, in small row groups: readers that filter by
    these columns, or by others that rise with them, pass over files' row groups by their statistics."""
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.option("parquet.block.size", group_bytes).parquet(path)


def write_bucketed(sites: DataFrame, name: str, path: str, buckets: int, bin_size: int = 500) -> DataFrame:
    """The table `name` of sites with their lowest bins, bucketed and sorted by them, for `intervals.join_binned`."""
    rows = sites.withColumn("_level", F.lit(0)).withColumn("_bin", F.floor(F.col("pos") / bin_size))
    by = ["chrom", *PLACE]
    rows.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by, "pos").option("path", path).saveAsTable(name)
    return sites.sparkSession.table(name)


def write_bedgraph(bins: DataFrame, path: str, width: int = 100, value: str = "fraction") -> None:
    """Bins (chrom, bin_start, value) as chrom, start, end, value, sorted; bins without a value are left out."""
    rows = bins.where(F.col(value).isNotNull()).orderBy("chrom", "bin_start")
    write_tsv(rows.select("chrom", "bin_start", (F.col("bin_start") + width).alias("bin_end"), value), path, header=False)
