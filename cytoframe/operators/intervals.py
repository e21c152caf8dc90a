"""Interval joins as equi joins on bins of several widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.folders import written

CLOSED, ZERO_BASED = "closed", "zero_based_half_open"
STEP = 16  # bins of the next level are so many times as wide; an interval touches one more bin of its level at most
LEVELS = 9
BLOCK = 4096  # bins whose running sums are added up together
PLACE = ["_level", "_bin"]
SHARES = 10_000  # a bin is never crowded with less than this part of all points, so crowded bins are that many at most


def bounds(start: Column, end: Column, coord: str) -> tuple[Column, Column]:
    """First and last 1-based position of an interval that is given closed or 0-based half-open."""
    if coord not in (CLOSED, ZERO_BASED):
        raise ValueError(f"coord: {coord}")
    return (start if coord == CLOSED else start + 1), end


def level_of(first: Column, last: Column, bin_size: int) -> Column:
    """The lowest level of whose bins [first, last] is no longer than STEP."""
    out = F.when(last - first < bin_size * STEP, F.lit(0))
    for level in range(1, LEVELS - 1):
        out = out.when(last - first < bin_size * STEP ** (level + 1), F.lit(level))
    return out.otherwise(F.lit(LEVELS - 1))


def sorted_join(df: DataFrame) -> DataFrame:
    """A side of a join of exploded rows, which is sorted and merged: Spark sizes such rows by the files that they come
    from, and would send many times its broadcast limit through the driver."""
    return df.hint("merge")


def _width(level: Column, bin_size: int) -> Column:
    return F.lit(bin_size).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), level * (STEP.bit_length() - 1))


def _all_bins(df: DataFrame, lo: Column, hi: Column, keep: list[str]) -> DataFrame:
    """`keep` and a row for each bin that [lo, hi] touches of its own level (`_own`) and of the higher ones in `_levels`."""
    rows = df.select("*", F.explode(F.array_union(F.array("_own"), "_levels")).alias("_level")).where("_level >= _own").withColumn("_w", _width(F.col("_level"), 1))
    return rows.select(*keep, "_level", F.explode(F.sequence(F.floor(lo / F.col("_w")), F.floor(hi / F.col("_w")))).alias("_bin"))


def levels_of(intervals: DataFrame, first: Column, last: Column, bin_size: int) -> Column:
    """The levels that any of the intervals has, as a subquery: an array of LEVELS numbers at most, from bits that are or-ed."""
    bit = lambda level: F.call_function("shiftleft", F.lit(1), level)
    met = F.coalesce(F.bit_or(bit(level_of(first, last, bin_size))), F.lit(0))
    return intervals.where(first <= last).agg(F.array_compact(F.array(*[F.when(met.bitwiseAND(1 << k) != 0, F.lit(k)) for k in range(LEVELS)]))).scalar()


def _spread(intervals: DataFrame, coord: str, bin_size: int, start: str, end: str) -> DataFrame:
    lo, hi = bounds(F.col(start), F.col(end), coord)
    rows = intervals.where(lo <= hi).withColumn("_level", level_of(lo, hi, bin_size)).withColumn("_w", _width(F.col("_level"), bin_size))
    return rows.select(*intervals.columns, "_level", F.explode(F.sequence(F.floor(lo / F.col("_w")), F.floor(hi / F.col("_w")))).alias("_bin"))


def _placed(points: DataFrame, intervals: DataFrame, coord: str, bin_size: int, pos: str, start: str, end: str) -> DataFrame:
    """The points with one bin of each level that an interval has."""
    lo, hi = bounds(F.col(start), F.col(end), coord)
    rows = points.withColumn("_levels", levels_of(intervals, lo, hi, bin_size)).select(*points.columns, F.explode("_levels").alias("_level"))
    return rows.withColumn("_bin", F.floor(F.col(pos) / _width(F.col("_level"), bin_size)))


def lying_in_bins(points: DataFrame, intervals: DataFrame, coord: str, bin_size: int = 1000, pos: str = "pos", start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    """All points with their bins (PLACE), shuffled to where `join_points` needs them: for intervals that touch most bins,
    where `in_bins` would sort and shuffle for little."""
    return _placed(points, intervals, coord, bin_size, pos, start, end).repartition("chrom", *PLACE)


def in_bins(points: DataFrame, intervals: DataFrame, coord: str, bin_size: int = 1000, pos: str = "pos", start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    """The points of bins that an interval touches, with their bins (PLACE): what `join_points` can match at all.

    What is grouped by chrom, PLACE and pos and joined afterwards stays where this join has put it.
    """
    bare = intervals.select("chrom", start, end)
    touched = _spread(bare, coord, bin_size, start, end).select("chrom", *PLACE).distinct()
    return _placed(points, bare, coord, bin_size, pos, start, end).join(sorted_join(touched), ["chrom", *PLACE], "left_semi")


def join_points(
    points: DataFrame, intervals: DataFrame, coord: str, bin_size: int = 1000, pos: str = "pos", start: str = "start_pos", end: str = "end_pos", crowded: int | None = None,
    placed: bool = False,
) -> DataFrame:
    """Every (point, interval) with the point inside.

    Bins have LEVELS widths, each STEP times the one before. An interval goes to the bins of one level that it touches,
    the lowest where these are STEP + 1 at most, however long it is; a point goes to one bin of each level that any
    interval has (one, where all are short). A pair meets in exactly one bin, so nothing has to be made distinct.
    Both sides have chrom; other columns must differ in name. Empty intervals meet nothing. Points may come
    with the bins that `in_bins` gave them for the same intervals.

    Bins of more than `crowded` points (and 1/SHARES of all) are cut by a hash of the position, which their
    intervals meet in each part; the points are then counted first. Without it that is left to adaptive execution.
    With `placed` the rows keep the columns that they met by (PLACE, `_salt`), by which they lie.
    """
    lo, hi = bounds(F.col(start), F.col(end), coord)
    own = points if "_bin" in points.columns else _placed(points, intervals, coord, bin_size, pos, start, end)
    spread, on = _spread(intervals, coord, bin_size, start, end), ["chrom", *PLACE]
    if crowded:
        own, spread = _salted(own, spread, on, pos, crowded)
        on = [*on, "_salt"]
    met = own.join(sorted_join(spread), on).where((F.col(pos) >= lo) & (F.col(pos) <= hi))
    return met if placed else met.drop(*PLACE, "_salt")


def up_to(points: DataFrame, marks: DataFrame, sums: list[str], bin_size: int, pos: str = "pos") -> DataFrame:
    """(chrom, pos, *sums): for each mark (chrom, pos; distinct) the sums over all points of its chromosome up to it, itself
    included. Points are distinct by chrom and pos, their summed columns whole numbers.

    A point meets no mark: within bins sums run on in the order of positions, and one row of each bin carries its sum on, in
    blocks of bins. A bin holds at most two rows for each of its positions. Points that come partitioned by chrom and `_bin`
    (see `bin_of`) stay where they are.
    """
    here, zero = F.col(pos), F.lit(0).cast("long")
    own = F.col("_bin") if "_bin" in points.columns else bin_of(here, bin_size)
    known = points.where(F.col("chrom").isNotNull() & here.isNotNull()).select("chrom", own, here.cast("long").alias("pos"), F.lit(False).alias("_mark"), *[F.coalesce(F.col(c).cast("long"), zero).alias(c) for c in sums])
    asked = marks.select("chrom", bin_of(here, bin_size), here.cast("long").alias("pos"), F.lit(True).alias("_mark"), *[zero.alias(c) for c in sums])
    order = Window.partitionBy("chrom", "_bin").orderBy("pos", "_mark")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = known.unionByName(asked).select("chrom", "_bin", "pos", "_mark", *[F.sum(c).over(running).alias(c) for c in sums], F.lead("pos").over(order).isNull().alias("_last"))
    rows = written(rows.where("_mark OR _last"), "running")
    ends = rows.where("_last").select("chrom", "_bin", F.floor(F.col("_bin") / BLOCK).alias("_block"), *sums)
    earlier = lambda by, at: Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    blocks = ends.groupBy("chrom", "_block").agg(*[F.sum(c).alias(c) for c in sums])
    blocks = blocks.select("chrom", "_block", *[F.coalesce(F.sum(c).over(earlier(["chrom"], "_block")), zero).alias(f"_b_{c}") for c in sums])
    before = ends.select("chrom", "_bin", "_block", *[F.coalesce(F.sum(c).over(earlier(["chrom", "_block"], "_bin")), zero).alias(f"_e_{c}") for c in sums])
    before = before.join(blocks, ["chrom", "_block"]).select("chrom", "_bin", *[(F.col(f"_e_{c}") + F.col(f"_b_{c}")).alias(f"_e_{c}") for c in sums])
    return rows.where("_mark").join(before, ["chrom", "_bin"]).select("chrom", "pos", *[(F.col(c) + F.col(f"_e_{c}")).alias(c) for c in sums])


def bin_of(pos: Column, bin_size: int) -> Column:
    return F.floor(pos / bin_size).alias("_bin")


def join_binned(sites: DataFrame, intervals: DataFrame, coord: str, bin_size: int, pos: str = "pos", start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    """`join_points` for a table of sites that is bucketed by its lowest bins (see `tables.write_bucketed`), of this width.

    Intervals of the lowest level meet its sites where they lie: only the intervals are shuffled, into the table's buckets.
    Longer ones, which would need many bins, take the common way; with none of them that part has no rows.
    """
    lo, hi = bounds(F.col(start), F.col(end), coord)
    level = level_of(lo, hi, bin_size)
    short = sites.join(sorted_join(_spread(intervals.where(level == 0), coord, bin_size, start, end)), ["chrom", *PLACE]).where((F.col(pos) >= lo) & (F.col(pos) <= hi)).drop(*PLACE)
    return short.unionByName(join_points(sites.drop(*PLACE), intervals.where(level > 0), coord, bin_size, pos, start, end))


def _salted(placed: DataFrame, spread: DataFrame, on: list[str], pos: str, crowded: int) -> tuple[DataFrame, DataFrame]:
    counts = placed.groupBy(*on).agg(F.count("*").alias("_n"))
    least = counts.agg(F.greatest(F.lit(crowded), F.coalesce(F.ceil(F.sum("_n") / SHARES), F.lit(0)))).scalar()
    hot = counts.withColumn("_most", least).where("_n > _most").select(*on, F.ceil(F.col("_n") / F.col("_most")).alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    placed = placed.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(F.xxhash64(pos), parts)).drop("_parts")
    spread = spread.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return placed, spread


def join_overlapping(rows: DataFrame, others: DataFrame, bin_size: int = 1000, a: tuple[str, str] = ("start_pos", "end_pos"), b: tuple[str, str] = ("other_start", "other_end")) -> DataFrame:
    """Every pair of half-open intervals (chrom, a) and (chrom, b) that share a base, once.

    A side goes to the bins that it touches of its own level and of each higher level that the other side has, some
    STEP + 2 * LEVELS at most. A pair is that of the higher of its two levels and of the bin of its first common base.
    """
    (s, e), (t, u) = a, b

    def reach(df: DataFrame, first: str, last: str, found: Column, own: str) -> DataFrame:
        lo, hi = F.col(first), F.col(last) - 1
        placed = df.where(lo <= hi).withColumn("_own", level_of(lo, hi, bin_size)).withColumn("_levels", found)
        return _all_bins(placed, lo / bin_size, hi / bin_size, [*df.columns, F.col("_own").alias(own)])

    x = reach(rows, s, e, levels_of(others, F.col(t), F.col(u) - 1, bin_size), "_la")
    y = reach(others, t, u, levels_of(rows, F.col(s), F.col(e) - 1, bin_size), "_lb")
    first = F.floor(F.greatest(s, t) / _width(F.col("_level"), bin_size))
    met = x.join(sorted_join(y), ["chrom", *PLACE]).where((F.col(s) < F.col(u)) & (F.col(e) > F.col(t)) & (F.col("_level") == F.greatest("_la", "_lb")) & (F.col("_bin") == first))
    return met.drop(*PLACE, "_la", "_lb")


def overlapping(rows: DataFrame, others: DataFrame, bin_size: int = 1000, start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    """The rows, once each, whose half-open interval overlaps one of `others` (chrom, start_pos, end_pos).

    Rows that go to one bin answer once, by a semi join. Those that go to several (they cross a bin's end, or the others
    have several levels) are numbered and answer in each; one answer of each number is kept. Empty intervals overlap
    nothing; repeated rows are kept.
    """
    bare = others.select(F.col("chrom").alias("_c"), F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e")).where("_s < _e")
    theirs = levels_of(bare, F.col("_s"), F.col("_e") - 1, bin_size)
    ours = levels_of(rows, F.col(start), F.col(end) - 1, bin_size)

    def bins(df: DataFrame, lo: Column, hi: Column, found: Column) -> DataFrame:
        return df.withColumn("_own", level_of(lo, hi, bin_size)).withColumn("_levels", found)

    theirs_lo, theirs_hi = F.col("_s"), F.col("_e") - 1
    spread = _all_bins(bins(bare, theirs_lo, theirs_hi, ours), theirs_lo / bin_size, theirs_hi / bin_size, ["_c", "_s", "_e"])
    spread = spread.withColumnsRenamed({"_level": "_k", "_bin": "_b"})

    def met(df: DataFrame) -> DataFrame:
        on = (df["chrom"] == spread["_c"]) & (df["_level"] == spread["_k"]) & (df["_bin"] == spread["_b"]) & (df[start] < spread["_e"]) & (df[end] > spread["_s"])
        return df.join(sorted_join(spread), on, "left_semi").drop(*PLACE)

    lo, hi = F.col(start), F.col(end) - 1
    own = bins(rows.where(lo <= hi), lo, hi, theirs).withColumn("_w", _width(F.col("_own"), bin_size))
    first = F.floor(lo / F.col("_w"))
    single = (F.coalesce(F.array_max("_levels"), F.lit(-1)) <= F.col("_own")) & (first == F.floor(hi / F.col("_w")))
    one = met(own.where(single).select(*rows.columns, F.col("_own").alias("_level"), first.alias("_bin")))
    many = own.where(~single).withColumn("_row", F.monotonically_increasing_id())
    many = met(_all_bins(many, lo / bin_size, hi / bin_size, [*rows.columns, "_row"])).dropDuplicates(["_row"]).drop("_row")
    return one.unionByName(many)
