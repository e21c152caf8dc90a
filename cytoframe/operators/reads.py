"""Read pairs: pairing by arrival, dovetails, fragments, masks and flag counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PAIRED, UNMAPPED, MATE_UNMAPPED, REVERSE, READ1, READ2 = 1, 4, 8, 16, 64, 128
#: Strand of a pair by the flag of its first-seen record.
STRANDS = {99: "OT", 83: "OB", 147: "CTOT", 163: "CTOB"}


def has(flag: str | Column, bit: int) -> Column:
    return (F.col(flag) if isinstance(flag, str) else flag).bitwiseAND(bit) != 0


def properly_mapped(reads: DataFrame) -> DataFrame:
    return reads.where(has("flag", PAIRED) & ~has("flag", UNMAPPED) & ~has("flag", MATE_UNMAPPED))


def in_span(reads: DataFrame, chrom: Column, span: str) -> DataFrame:
    """Reads (0-based half-open) that touch a span such as chr4:100-200, which is 1-based with both ends."""
    name, _, ends = span.rpartition(":")
    first, last = (int(x.replace(",", "")) for x in ends.split("-"))
    return reads.where((chrom == name) & (F.col("start_pos") < last) & (F.col("end_pos") > first - 1))


def pairs(reads: DataFrame) -> DataFrame:
    """One row for each complete pair: (qname, pair_no, first, second) in the order of arrival.

    The first record of a name waits, the second closes the pair, the third waits anew; what is left without
    a partner has no row. Filters belong before this: they change which record comes second.
    """
    fields = [c for c in ("flag", "ref_id", "start_pos", "end_pos") if c in reads.columns]
    n = F.row_number().over(Window.partitionBy("qname").orderBy("ord")) - 1
    rows = reads.withColumn("_n", n).select("qname", F.floor(F.col("_n") / 2).alias("pair_no"), (F.col("_n") % 2).alias("_k"), F.struct(*fields).alias("r"))
    g = rows.groupBy("qname", "pair_no").agg(F.max(F.when(F.col("_k") == 0, F.col("r"))).alias("first"), F.max(F.when(F.col("_k") == 1, F.col("r"))).alias("second"))
    return g.where("second IS NOT NULL")


def ordered_pairs(reads: DataFrame) -> DataFrame:
    """Pairs as read1 and read2: the second-seen record where it is flagged read 1, else the first-seen, is read1."""
    return by_read(pairs(properly_mapped(reads)))


def by_read(p: DataFrame) -> DataFrame:
    """Pairs (qname, pair_no, first, second) as read1 and read2."""
    swap = has(F.col("second.flag"), READ1)
    return p.select("qname", "pair_no", F.when(swap, F.col("second")).otherwise(F.col("first")).alias("r1"), F.when(swap, F.col("first")).otherwise(F.col("second")).alias("r2"))


def dovetail() -> Column:
    """A mate reaches past the other's outer end; the mates have one reference and opposite strands."""
    f1, f2 = ~has(F.col("r1.flag"), REVERSE), ~has(F.col("r2.flag"), REVERSE)
    r1, r2 = "r1.", "r2."
    past = lambda a, b: (F.col(b + "end_pos") < F.col(a + "end_pos")) | (F.col(b + "start_pos") < F.col(a + "start_pos"))
    return (F.col("r1.ref_id") == F.col("r2.ref_id")) & F.when(f1 & ~f2, past(r1, r2)).when(~f1 & f2, past(r2, r1)).otherwise(F.lit(False))


def fragments(reads: DataFrame) -> DataFrame:
    """(chrom, start, end, strand, size) of pairs with one reference and opposite strands, start before end."""
    f1, f2 = ~has(F.col("r1.flag"), REVERSE), ~has(F.col("r2.flag"), REVERSE)
    plus, minus = f1 & ~f2, ~f1 & f2
    p = ordered_pairs(reads).where("r1.ref_id = r2.ref_id").where(plus | minus)
    p = p.select(
        F.col("r1.ref_id").alias("chrom"), F.when(plus, F.col("r1.start_pos")).otherwise(F.col("r2.start_pos")).alias("start"),
        F.when(plus, F.col("r2.end_pos")).otherwise(F.col("r1.end_pos")).alias("end"), F.when(plus, "+").otherwise("-").alias("strand"),
    )
    return p.where("start < end").withColumn("size", F.col("end") - F.col("start"))


def size_histogram(frags: DataFrame, low: int = 1, high: int = 500) -> DataFrame:
    """Dense counts for low..high."""
    spine = frags.sparkSession.range(low, high + 1).withColumnRenamed("id", "size")
    return spine.join(frags.where(F.col("size").between(low, high)).groupBy("size").agg(F.count("*").alias("n")), "size", "left").select("size", F.coalesce("n", F.lit(0)).alias("count"))


def size_classes(reads: DataFrame) -> DataFrame:
    """Pairs with one reference by their outer span, orientation ignored."""
    span = F.greatest("r1.end_pos", "r2.end_pos") - F.least("r1.start_pos", "r2.start_pos")
    kind = F.when(span <= 50, "small").when(span <= 100, "medium").when(span <= 150, "long").otherwise("xlarge")
    g = ordered_pairs(reads).where("r1.ref_id = r2.ref_id").groupBy(kind.alias("size_class")).agg(F.count("*").alias("pairs"))
    return g.select("size_class", "pairs", (F.col("pairs") / F.sum("pairs").over(Window.partitionBy()) * 100).alias("pct"))  # four rows


def directional(reads: DataFrame, four: bool = True) -> DataFrame:
    """Pairs of mapped reads with the strand of the first-seen flag; other flags are dropped."""
    label = F.lit(None).cast("string")
    for flag, strand in STRANDS.items():
        name = strand if four else ("plus" if strand in ("OT", "CTOT") else "minus")
        label = F.when(F.col("first.flag") == flag, F.lit(name)).otherwise(label)
    return pairs(reads.where(~has("flag", UNMAPPED))).withColumn("strand_group", label).where("strand_group IS NOT NULL")


def flag_combinations(reads: DataFrame) -> DataFrame:
    """Mapped records by read 1, flag, tags and the ordinal that toggles 1, 2 within a name."""
    n = (F.row_number().over(Window.partitionBy("qname").orderBy("ord")) - 1) % 2 + 1
    rows = reads.where(~has("flag", UNMAPPED)).select(has("flag", READ1).alias("is_read1"), "flag", F.coalesce("xr", F.lit("NA")).alias("xr"), F.coalesce("xg", F.lit("NA")).alias("xg"), n.alias("read"))
    return rows.groupBy("is_read1", "flag", "xr", "xg", "read").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "flag", "is_read1", "read", "xr", "xg")


def mask_outside(quals: Column, positions: Column, start: Column, end: Column) -> Column:
    """Qualities with those outside [start, end), and those without a position, set to 0."""
    return F.zip_with(quals, positions, lambda q, p: F.when((p >= start) & (p < end), q).otherwise(0))


def mask_ends(quals: Column, flag: Column, head: tuple[int, int], tail: tuple[int, int]) -> Column:
    """Qualities with the first and last of read 1 or read 2 set to 0, in stored order; unmapped, secondary,
    supplementary and other reads stay as they are."""
    off = flag.bitwiseAND(UNMAPPED | 0x100 | 0x800) != 0
    h = F.when(has(flag, READ1), head[0]).when(has(flag, READ2), head[1]).otherwise(0)
    t = F.when(has(flag, READ1), tail[0]).when(has(flag, READ2), tail[1]).otherwise(0)
    n = F.size(quals)
    h = F.least(h, n)
    t = F.least(t, n - h)
    zeros = lambda k: F.array_repeat(F.lit(0), k)
    return F.when(off, quals).otherwise(F.concat(zeros(h), F.slice(quals, h + 1, n - h - t), zeros(t)))


def _marked(reads: DataFrame) -> DataFrame:
    """`reads` with masked_from, masked_to and branch (see `mask_dovetails`), each record with its mate by one window."""
    ok = has("flag", PAIRED) & ~has("flag", UNMAPPED) & ~has("flag", MATE_UNMAPPED)
    by = Window.partitionBy("qname", "_ok").orderBy("ord")
    own, even = F.struct("flag", "ref_id", "start_pos", "end_pos"), (F.row_number().over(by) - 1) % 2 == 0
    rows = reads.withColumn("_ok", ok).where("_ok IS NOT NULL").withColumn("_own", own)
    rows = rows.withColumn("_even", even).withColumn("_mate", F.when(F.col("_even"), F.lead("_own").over(by)).otherwise(F.lag("_own").over(by)))
    second = F.when(F.col("_even"), F.col("_mate.flag")).otherwise(F.col("flag"))
    mine = has(second, READ1) == ~F.col("_even")  # this record is read 1: the second one if that is flagged so, else the first
    rows = rows.withColumn("r1", F.when(mine, F.col("_own")).otherwise(F.col("_mate"))).withColumn("r2", F.when(mine, F.col("_mate")).otherwise(F.col("_own")))
    branch = F.when(~F.col("_ok"), 0).when(F.col("_mate").isNull(), 2).when(F.col("r1.ref_id") == F.col("r2.ref_id"), 1)
    rows = rows.withColumn("branch", branch).where("branch IS NOT NULL")
    cut = (F.col("branch") == 1) & dovetail()
    return rows.select(*reads.columns, F.when(cut, F.greatest("r1.start_pos", "r2.start_pos")).alias("masked_from"), F.when(cut, F.least("r1.end_pos", "r2.end_pos")).alias("masked_to"), "branch")


def mask_dovetails(reads: DataFrame) -> DataFrame:
    """(qname, ord, flag, masked_from, masked_to, branch): where each record's qualities stay, in output order of `branch`.

    Unpaired and unmapped records pass (0), pairs come next with the overlap as bounds where they dovetail (1),
    records without a partner last (2); pairs over two references are dropped. Null bounds mask nothing.
    """
    return _marked(reads).select("qname", "ord", "flag", "masked_from", "masked_to", "branch")


def reference_positions(cigar: Column, start: Column) -> Column:
    """The reference position of every stored base, from the CIGAR text; null for inserted and soft-clipped ones."""
    ops = F.arrays_zip(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1)).alias("n"), F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2)).alias("op"))
    begin = F.struct(start.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        n, op = x["n"].cast("int"), x["op"]
        both, stored = op.isin("M", "=", "X"), op.isin("I", "S")
        moved = F.when(both | op.isin("D", "N"), acc["at"] + n).otherwise(acc["at"])
        more = F.when(both, F.sequence(acc["at"], acc["at"] + n - 1)).when(stored, F.array_repeat(F.lit(None).cast("long"), n)).otherwise(F.array().cast("array<bigint>"))
        return F.struct(moved.alias("at"), F.concat(acc["out"], more).alias("out"))

    return F.aggregate(ops, begin, step)["out"]


def masked_records(reads: DataFrame) -> DataFrame:
    """The records that `mask_dovetails` keeps, with their qualities masked and (branch, qname, ord) as output order.

    reads: qname, ord, flag, ref_id, start_pos, end_pos, cigar, quals. Bases without a reference position are masked
    as well where a record has bounds.
    """
    rows = _marked(reads)
    at = reference_positions(F.col("cigar"), F.col("start_pos"))
    quals = F.when(F.col("masked_from").isNotNull(), mask_outside(F.col("quals"), at, F.col("masked_from"), F.col("masked_to"))).otherwise(F.col("quals"))
    return rows.withColumn("quals", quals).drop("masked_from", "masked_to")


def _with_pair(reads: DataFrame) -> DataFrame:
    """Records with their pair's number and both members in the order of arrival; leftovers have no row."""
    by = Window.partitionBy("qname").orderBy("ord")
    n = F.row_number().over(by) - 1
    own = F.struct("flag", "ref_id", "start_pos", "end_pos", "ord")
    rows = reads.withColumn("_n", n).withColumn("pair_no", F.floor(F.col("_n") / 2)).withColumn("_own", own)
    pair = Window.partitionBy("qname", "pair_no").orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("first", F.first("_own").over(pair)).withColumn("second", F.nth_value("_own", 2).over(pair))
    return rows.where("second IS NOT NULL").drop("_own")


def dovetail_records(reads: DataFrame) -> DataFrame:
    """The records of dovetailed pairs with `mate` (1: read 1) and `closed`, the order of each pair's second record:
    sorted by closed and mate they are the output file."""
    rows = _with_pair(properly_mapped(reads))
    swap = has(F.col("second.flag"), READ1)
    rows = rows.withColumn("r1", F.when(swap, F.col("second")).otherwise(F.col("first"))).withColumn("r2", F.when(swap, F.col("first")).otherwise(F.col("second")))
    rows = rows.where(dovetail()).withColumn("mate", F.when(F.col("ord") == F.col("r1.ord"), 1).otherwise(2))
    return rows.withColumn("closed", F.col("second.ord")).drop("_n", "pair_no", "first", "second", "r1", "r2")


def split_by_size(reads: DataFrame) -> DataFrame:
    """The records of pairs with one reference and the class of the pair's outer span, `output` (see `size_classes`)."""
    rows = _with_pair(properly_mapped(reads)).where("first.ref_id = second.ref_id")
    span = F.greatest("first.end_pos", "second.end_pos") - F.least("first.start_pos", "second.start_pos")
    kind = F.when(span <= 50, "small").when(span <= 100, "medium").when(span <= 150, "long").otherwise("xlarge")
    return rows.withColumn("output", kind).drop("_n", "pair_no", "first", "second")


def split_by_strand(reads: DataFrame, four: bool = True) -> DataFrame:
    """The records of mapped pairs whose first-seen flag tells the strand, with `output`: OT, OB, CTOT and CTOB, or plus and minus."""
    label = F.lit(None).cast("string")
    for flag, strand in STRANDS.items():
        name = strand if four else ("plus" if strand in ("OT", "CTOT") else "minus")
        label = F.when(F.col("first.flag") == flag, F.lit(name)).otherwise(label)
    rows = _with_pair(reads.where(~has("flag", UNMAPPED)))
    return rows.withColumn("output", label).where("output IS NOT NULL").drop("_n", "pair_no", "first", "second")
