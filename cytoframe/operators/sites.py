"""Conversions between site formats and site filters."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Window, functions as F

from .intervals import overlapping


def to_bed(allc: DataFrame) -> DataFrame:
    name = F.concat_ws("_", "context", F.col("mc").cast("string"), F.col("cov").cast("string"))
    return allc.select("chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"), "strand", name.alias("name"))


def from_bed(bed: DataFrame, strict: bool) -> DataFrame:
    """Unpack context_mc_cov; names with other than three parts (strict) or fewer than three are skipped, as are non-integers."""
    parts = F.split("name", "_")
    right = F.size("p") == 3 if strict else F.size("p") >= 3
    rows = bed.withColumn("p", parts).where(right)
    rows = rows.select(
        "chrom", (F.col("start_pos") + 1).alias("pos"), "strand", F.col("p")[0].alias("context"),
        F.col("p")[1].try_cast("long").alias("mc"), F.col("p")[2].try_cast("long").alias("cov"), F.lit(1).alias("flag"),
    )
    return rows.where("mc IS NOT NULL AND cov IS NOT NULL")


def from_beta(beta: DataFrame) -> DataFrame:
    rows = beta.where("mc IS NOT NULL AND cov IS NOT NULL AND end_pos IS NOT NULL")
    return rows.select("chrom", (F.col("end_pos") - 1).alias("pos"), F.lit("+").alias("strand"), F.lit("CG").alias("context"), "mc", "cov", F.lit(1).alias("flag"))


def unique_sites(allc: DataFrame) -> DataFrame:
    """The sites that occur once; all rows of a repeated (chrom, pos) go."""
    by = Window.partitionBy("chrom", "pos")
    return allc.withColumn("_n", F.count("*").over(by)).where("_n = 1").drop("_n")


def sites_in_cpgs(allc: DataFrame, cpgs: DataFrame) -> DataFrame:
    bed = allc.withColumn("start_pos", F.col("pos") - 1).withColumn("end_pos", F.col("pos"))
    return unique_sites(overlapping(bed, cpgs).drop("start_pos", "end_pos"))


def exact_semi(rows: DataFrame, cpgs: DataFrame) -> DataFrame:
    """Rows whose interval is one of the CpGs'."""
    return rows.join(cpgs.select("chrom", F.col("start_pos").alias("start"), F.col("end_pos").alias("end")), ["chrom", "start", "end"], "left_semi")


def exact_inner(rows: DataFrame, cpgs: DataFrame) -> DataFrame:
    """A row for each CpG row of the same interval: repeated CpGs multiply."""
    return rows.join(cpgs.select("chrom", F.col("start_pos").alias("start"), F.col("end_pos").alias("end")), ["chrom", "start", "end"])


def _observed(counts: Observation) -> dict[str, int]:
    """What was counted; nothing, where the optimizer saw that no row can come and left the counting out."""
    try:
        return counts.get
    except Py4JJavaError:
        return {}


def write_filtered(raw: DataFrame, cpgs: DataFrame, path: str) -> dict[str, int | float | None]:
    """Writes the rows without a null whose interval is a CpG's (see `exact_inner`) as Parquet, and returns what was counted
    while they passed: input, nan_removed, before, after, filtered_out (negative where repeated CpGs multiply rows) and
    retention_pct. The counts are observed, so the rows are read and joined once."""
    columns = ["chrom", "start", "end", "mc", "cov"]
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    first, last = Observation(), Observation()
    rows = raw.select(*columns).observe(first, F.count("*").alias("input"), F.count_if(whole).alias("before")).where(whole)
    exact_inner(rows, cpgs).observe(last, F.count("*").alias("after")).write.parquet(path)
    n = {"input": 0, "before": 0, "after": 0, **_observed(first), **_observed(last)}
    return {
        "input": n["input"], "nan_removed": n["input"] - n["before"], "before": n["before"], "after": n["after"],
        "filtered_out": n["before"] - n["after"], "retention_pct": n["after"] / n["before"] * 100 if n["before"] else None,
    }


def select_columns(df: DataFrame, *wanted: str) -> DataFrame:
    """One or two columns by header name; a missing name is an error, of a repeated one the last column counts."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    if len(set(df.columns)) == len(df.columns):
        return df.select(*wanted)
    apart = df.toDF(*[f"{c}#{i}" for i, c in enumerate(df.columns)])
    last = {c: i for i, c in enumerate(df.columns)}
    return apart.select(*[apart[f"`{c}#{last[c]}`"].alias(c) for c in wanted])


def unpivot_matrix(matrix: DataFrame, key: str, value: str, name: str = "barcode") -> DataFrame:
    """(key, name) of the cells of a wide table that hold `value`; the first column, or `key`, names the rows."""
    cells = [c for c in matrix.columns if c != key]
    return matrix.unpivot(key, cells, name, "_value").where(F.col("_value") == value).select(key, name)


def in_order(sites: DataFrame) -> DataFrame:
    """Sites by chromosome and position, intervals by chromosome and start; other columns break ties."""
    place = "pos" if "pos" in sites.columns else "start" if "start" in sites.columns else "start_pos"
    rest = [c for c, kind in sites.dtypes if c not in ("chrom", place) and not kind.startswith("map")]
    return sites.orderBy("chrom", place, *rest)
