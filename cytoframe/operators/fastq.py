"""Read files: demultiplexing, order, agreement, validation and file catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import names
from .ranks import placed

DEPTHS = (50_000, 100_000, 500_000, 1_000_000, 1_500_000, 2_000_000, 3_000_000, 4_000_000)


def barcode_counts(fastq: DataFrame) -> DataFrame:
    return fastq.groupBy(names.barcode(F.col("header")).alias("barcode")).agg(F.count("*").alias("reads"))


def until_blank_header(fastq: DataFrame) -> DataFrame:
    """Records of each file before its first blank header."""
    stop = fastq.where(F.trim("header") == "").groupBy("file").agg(F.min("rec_no").alias("_stop"))
    return fastq.join(stop, "file", "left").where("_stop IS NULL OR rec_no < _stop").drop("_stop")


def reorder(fastq: DataFrame, reference: DataFrame) -> DataFrame:
    """Records of `fastq` with the rank of their id in `reference` (the last, where an id repeats): (rank, read_id, seq, qual).

    Sort by rank to write. Records without a rank have none; see `same_reads`.
    """
    rank = reference.groupBy(names.read_id(F.col("header")).alias("read_id")).agg(F.max("rec_no").alias("rank"))
    return fastq.withColumn("read_id", names.read_id(F.col("header"))).join(rank, "read_id", "left").select("rank", "read_id", "seq", "qual")


def same_reads(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ids only in the first, only in the second, and repeated in either; all 0 for files that can be synchronised."""
    side = lambda df, n: df.select(names.read_id(F.col("header")).alias("id"), F.lit(n).alias("side"))
    g = side(a, 0).unionByName(side(b, 1)).groupBy("id").agg(F.count_if(F.col("side") == 0).alias("x"), F.count_if(F.col("side") == 1).alias("y"))
    return g.agg(F.count_if(F.col("y") == 0).alias("only_first"), F.count_if(F.col("x") == 0).alias("only_second"), F.count_if((F.col("x") > 1) | (F.col("y") > 1)).alias("repeated"))


def mismatches(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Records at one index whose names differ, with the line number of their header; the shorter file ends the comparison."""
    a = r1.select("rec_no", names.first_token(F.col("header")).alias("r1_name"))
    b = r2.select("rec_no", names.first_token(F.col("header")).alias("r2_name"))
    return a.join(b, "rec_no").where("r1_name != r2_name").select((4 * F.col("rec_no") + 1).alias("line_num"), "r1_name", "r2_name")


def sort_by_header(fastq: DataFrame) -> DataFrame:
    """Records by first token, then by the whole line, bytewise."""
    return fastq.orderBy(names.first_token(F.col("header")), "header", "seq", "plus", "qual")


def four_way(records: DataFrame) -> DataFrame:
    """(file_type, matched, ord, read_name): the names in all four files in I1's order, then each file's others, sorted.

    records: file_type (I1, I2, R1, R2), rec_no, header. Of a name that repeats in a file the last record counts.
    """
    named = records.select("file_type", "rec_no", names.first_token(F.col("header")).alias("read_name"))
    by = named.groupBy("read_name").agg(
        F.count_distinct("file_type").alias("n"), F.min(F.when(F.col("file_type") == "I1", F.col("rec_no"))).alias("first"), F.collect_set("file_type").alias("types")
    )
    rows = by.select("read_name", (F.col("n") == 4).alias("matched"), F.when(F.col("n") == 4, F.col("first")).alias("ord"), F.explode("types").alias("file_type"))
    return rows.select("file_type", "matched", "ord", "read_name")


def four_way_records(records: DataFrame) -> DataFrame:
    """(file_type, place, header, seq, plus, qual): the records of each file in their new order, from 1: those in all four
    files in I1's order, then the others by name. Of a name that repeats in a file the last record stays. Places are
    counted by ranges of the order (see `ranks.placed`), so a file may be of any size."""
    last = records.withColumn("read_name", names.first_token(F.col("header"))).groupBy("file_type", "read_name").agg(
        F.max_by(F.struct("header", "seq", "plus", "qual"), "rec_no").alias("r"), F.max("rec_no").alias("rec_no")
    )
    order = four_way(records).select("file_type", "read_name", "matched", "ord")
    rows = last.join(order, ["file_type", "read_name"])
    out = placed(rows.select("file_type", "matched", "ord", "read_name", "r"), ["file_type"], [F.desc("matched"), "ord", "read_name"])
    return out.select("file_type", "place", "r.*")


def concatenated_records(records: DataFrame, files: DataFrame) -> DataFrame:
    """(sample, read_type, part, rec_no, header, seq, plus, qual): the records (dir, name, rec_no, ...) of every sample and
    type; sorted by part and rec_no they are the concatenated file."""
    return records.join(concatenation(files), ["dir", "name"]).select("sample", "read_type", "part", "rec_no", "header", "seq", "plus", "qual")


def check(lines: DataFrame) -> DataFrame:
    """(file, status, reads) from numbered lines (file, line_no from 0, value): the first violation in file order wins."""
    k = F.col("line_no") % 4
    bad = F.when((k == 0) & ~F.startswith(F.col("value"), F.lit("@")), "bad header").when((k == 2) & ~F.startswith(F.col("value"), F.lit("+")), "bad separator")
    g = lines.select("file", "line_no", bad.alias("bad")).groupBy("file").agg(F.min_by("bad", F.when(F.col("bad").isNotNull(), F.col("line_no"))).alias("bad"), F.count("*").alias("n"))
    status = F.when(F.col("bad").isNotNull(), F.col("bad")).when(F.col("n") % 4 != 0, "truncated").otherwise("ok")
    return g.select("file", status.alias("status"), F.when(status == "ok", F.floor(F.col("n") / 4)).otherwise(0).alias("reads"))


def check_summary(checked: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "ok")
    total = F.coalesce(F.sum("reads"), F.lit(0))
    return checked.agg(ok.alias("passed"), (F.count("*") - ok).alias("failed"), total.alias("total_reads"), F.coalesce(F.floor(F.try_divide(total, ok)), F.lit(0)).alias("average_reads"))


def catalogue(files: DataFrame) -> DataFrame:
    """(name, sample, read_type) of files whose read type is known."""
    out = files.select(*files.columns, names.sample_id(F.col("name")).alias("sample"), names.read_type(F.col("name")).alias("read_type"))
    return out.where("read_type IS NOT NULL")


def pairing(files: DataFrame) -> DataFrame:
    """Files of each sample by type, and whether mates are missing."""
    types = "R1", "R2", "I1", "I2"
    g = catalogue(files).groupBy("sample").agg(*[F.count_if(F.col("read_type") == t).alias(t.lower()) for t in types])
    return g.withColumn("uneven", (F.col("r1") != F.col("r2")) | (F.col("i1") != F.col("i2")))


def concatenation(files: DataFrame) -> DataFrame:
    """The parts of every (sample, read_type) in the order of their paths."""
    by = Window.partitionBy("sample", "read_type").orderBy("dir", "name")
    return catalogue(files).select("sample", "read_type", F.row_number().over(by).alias("part"), "dir", "name")


def sample_numbers(files: DataFrame) -> DataFrame:
    """S01, S02, ... over the sorted prefixes; one row for each sample, so the ranking is over few rows."""
    prefix = files.select(names.sample_prefix(F.col("name")).alias("prefix")).where("prefix IS NOT NULL").distinct()
    n = F.row_number().over(Window.orderBy("prefix")).cast("string")
    return prefix.select("prefix", F.concat(F.lit("S"), F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n)).alias("sample_number"))


def batches(files: DataFrame, size: int = 10) -> DataFrame:
    """Sorted file names in batches of `size`; a listing of files, not of reads."""
    n = F.row_number().over(Window.orderBy("dir", "name")) - 1
    return files.select("dir", "name", F.floor(n / size).alias("batch"))


def rename_plan(files: DataFrame) -> DataFrame:
    """(dir, old, new, action): sample number and lane removed; aborted for a directory of several lanes; skipped where
    a file of the new name is there already or an earlier file, by name, takes it."""
    lane = F.regexp_extract("name", r"_L(\d+)_", 1)
    lanes = files.groupBy("dir").agg(F.count_distinct(F.when(lane != "", lane)).alias("lanes"))
    rows = files.join(lanes, "dir").select("dir", F.col("name").alias("old"), F.regexp_replace("name", r"_S\d+_L\d+_", "_").alias("new"), "lanes").where("old != new")
    there = files.select("dir", F.col("name").alias("new"), F.lit(True).alias("there")).distinct()
    rows = rows.join(there, ["dir", "new"], "left").withColumn("k", F.row_number().over(Window.partitionBy("dir", "new").orderBy("old")))
    action = F.when(F.col("lanes") > 1, "abort").when(F.col("there") | (F.col("k") > 1), "skip").otherwise("rename")
    return rows.select("dir", "old", "new", action.alias("action"))


def demultiplex(fastq: DataFrame, sheet: DataFrame, mismatches: int = 1) -> DataFrame:
    """Records with the sample whose index is within `mismatches`, null where none or several samples are that near.

    sheet: (sample, index). Each index is expanded to its neighbours, so barcodes meet samples in an equi join.
    """
    near = sheet.select("sample", F.col("index").alias("_b"))
    for _ in range(mismatches):
        at, letter = F.explode(F.sequence(F.lit(1), F.length("_b"))).alias("_i"), F.explode(F.array(*map(F.lit, "ACGTN"))).alias("_x")
        more = near.where("length(_b) > 0").select("sample", "_b", at).select("sample", "_b", "_i", letter)
        near = near.unionByName(more.select("sample", F.overlay("_b", "_x", F.col("_i"), F.lit(1)).alias("_b"))).distinct()
    best = near.groupBy("_b").agg(F.count_distinct("sample").alias("_n"), F.min("sample").alias("sample")).where("_n = 1").drop("_n")
    rows = fastq.withColumn("barcode", names.barcode(F.col("header"))).withColumn("_b", F.substring_index("barcode", "+", 1))
    return rows.join(best, "_b", "left").drop("_b")


def sample_depths(fastq: DataFrame, depths: tuple[int, ...] = DEPTHS, seed: int = 100) -> DataFrame:
    """The records of nested samples, each with `depth`, the smallest of `depths` whose sample holds it.

    The sample of a depth holds the records with that many smallest md5 of seed:id (equal ones in the order of rec_no), so
    mates of one id in two files are chosen together, and a smaller sample is part of a larger one. Sizes are
    exact: records are counted by the first 16 bits of the hash, which leaves the few prefixes in which a depth lies to
    be ordered, each by itself. All depths come from one count and one pass; with fewer records than a depth it holds all.
    """
    hashed = fastq.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), names.read_id(F.col("header"))).cast("binary")))
    hashed = hashed.withColumn("_p", F.conv(F.substr("_h", F.lit(1), F.lit(4)), 16, 10).cast("int"))
    depth = lambda rank: F.least(*[F.when(rank <= d, F.lit(d)) for d in sorted(depths)], F.lit(None))
    upto = F.sum("_n").over(Window.orderBy("_p"))  # over 65,536 rows at most
    counts = hashed.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
    counts = counts.where(F.col("_before") < max(depths))
    low, high = depth(F.col("_before") + 1), depth(F.col("_upto"))
    rows = hashed.join(F.broadcast(counts.select("_p", "_before", low.alias("depth"), low.eqNullSafe(high).alias("_whole"))), "_p")
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_p").orderBy("_h", "rec_no"))
    cut = rows.where("NOT _whole").withColumn("depth", depth(rank)).where("depth IS NOT NULL")
    return rows.where("_whole").unionByName(cut).select(*fastq.columns, "depth")


def same_names(files: DataFrame, first: str, second: str) -> DataFrame:
    """(name, in_second): the files of directory `first` and whether `second` has one of the same name."""
    own = files.where(F.col("dir") == first).select("name")
    other = files.where(F.col("dir") == second).select("name", F.lit(True).alias("_in"))
    return own.join(other, "name", "left").select("name", F.coalesce("_in", F.lit(False)).alias("in_second"))


def mate_files(files: DataFrame) -> DataFrame:
    """(dir, i1, i2, r1, r2) for each I1 file whose R1 and R2 exist; i2 is null where there is none."""
    own = files.where(F.contains("name", F.lit("_I1"))).select("dir", F.col("name").alias("i1"))
    out = own
    for kind, how in (("I2", "left"), ("R1", "inner"), ("R2", "inner")):
        want = out.withColumn("_w", F.replace("i1", F.lit("_I1"), F.lit(f"_{kind}")))
        have = files.select("dir", F.col("name").alias("_w"), F.col("name").alias(kind.lower()))
        out = want.join(have, ["dir", "_w"], how).drop("_w")
    return out.select("dir", "i1", "i2", "r1", "r2")


def match_counts(matched: DataFrame) -> DataFrame:
    """Names of each file in all four files, and others."""
    return matched.groupBy("file_type").agg(F.count_if("matched").alias("matched_reads"), F.count_if(~F.col("matched")).alias("unmatched_reads"))
