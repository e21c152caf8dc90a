"""Bins of several widths: exact joins of any lengths, bounded explosion, crowded bins in parts."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cytoframe.operators import intervals

LENGTHS = st.one_of(st.integers(0, 3), st.integers(0, 400), st.integers(0, 3_000_000), st.integers(200_000_000, 250_000_000))
POINTS = st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.integers(1, 500), st.integers(1, 250_000_000))), max_size=25)
SPANS = st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.integers(0, 500), st.integers(0, 200_000_000)), LENGTHS), max_size=12)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=8, deadline=None)
@given(POINTS, SPANS, st.sampled_from(["closed", "zero_based_half_open"]), st.sampled_from([None, 1, 3]))
def test_points_in_intervals_of_all_lengths(spark, points, spans, coord, crowded):
    p = spark.createDataFrame([(i, c, x) for i, (c, x) in enumerate(points)], "i int, chrom string, pos long")
    r = spark.createDataFrame([(j, c, s, s + n) for j, (c, s, n) in enumerate(spans)], "j int, chrom string, start_pos long, end_pos long")
    shift = 0 if coord == "closed" else 1
    want = sorted((i, j) for i, (c, x) in enumerate(points) for j, (d, s, n) in enumerate(spans) if c == d and s + shift <= x <= s + n)
    assert rows(intervals.join_points(p, r, coord, 7, crowded=crowded).select("i", "j")) == want
    near = intervals.in_bins(p, r, coord, 7)
    assert rows(intervals.join_points(near, r, coord, 7).select("i", "j")) == want


@settings(max_examples=8, deadline=None)
@given(SPANS, SPANS)
def test_overlaps_of_all_lengths(spark, one, two):
    a = spark.createDataFrame([(i, c, s, s + n) for i, (c, s, n) in enumerate(one)], "i int, chrom string, start_pos long, end_pos long")
    b = spark.createDataFrame([(j, c, s, s + n) for j, (c, s, n) in enumerate(two)], "j int, chrom string, other_start long, other_end long")
    pairs = sorted((i, j) for i, (c, s, n) in enumerate(one) for j, (d, t, m) in enumerate(two) if c == d and n and m and s < t + m and t < s + n)
    assert rows(intervals.join_overlapping(a, b, 7).select("i", "j")) == pairs
    others = b.withColumnsRenamed({"other_start": "start_pos", "other_end": "end_pos"})
    assert rows(intervals.overlapping(a, others, 7).select("i")) == sorted({(i,) for i, _ in pairs})


def test_explosion_is_bounded_by_levels(spark):
    """A thousand sites and three whole chromosomes: no interval has more rows than STEP + 1, no point more than levels."""
    r = spark.range(1000).select(F.lit("c").alias("chrom"), (F.col("id") * 50).alias("start_pos"), (F.col("id") * 50).alias("end_pos"))
    r = r.unionByName(spark.range(3).select(F.lit("c").alias("chrom"), F.col("id").alias("start_pos"), F.lit(250_000_000).cast("long").alias("end_pos")))
    spread = intervals._spread(r, "closed", 500, "start_pos", "end_pos")
    assert spread.count() <= 1000 * 2 + 3 * (intervals.STEP + 1)
    p = spark.range(1, 101).select(F.lit("c").alias("chrom"), (F.col("id") * 17).alias("pos"))
    assert intervals._placed(p, r, "closed", 500, "pos", "start_pos", "end_pos").count() == 200  # two levels occur
    assert intervals.join_points(p, r, "closed", 500).where("end_pos = 250000000").count() == 300
    two = r.withColumnsRenamed({"start_pos": "other_start", "end_pos": "other_end"}).withColumn("other_end", F.col("other_end") + 1)
    assert intervals.join_overlapping(r.withColumn("end_pos", F.col("end_pos") + 1), two, 500).count() == 1000 + 2 * 2998 + 9  # the first site lies before two of the three chromosomes


def test_crowded_bins_are_cut(spark):
    """A third of all points in one bin: no part holds more than some twice the limit."""
    p = spark.range(3000).select(F.lit("c").alias("chrom"), F.when(F.col("id") < 1000, F.col("id") % 499 + 1).otherwise(F.col("id") * 1000).alias("pos"))
    r = spark.createDataFrame([("c", 1, 499), ("c", 400, 5000)], "chrom string, start_pos long, end_pos long")
    placed = intervals._placed(p, r, "closed", 500, "pos", "start_pos", "end_pos")
    salted, spread = intervals._salted(placed, intervals._spread(r, "closed", 500, "start_pos", "end_pos"), ["chrom", *intervals.PLACE], "pos", 100)
    assert salted.groupBy("chrom", *intervals.PLACE, "_salt").count().agg(F.max("count")).first()[0] <= 200
    assert spread.count() < 60
    want = p.crossJoin(r.select("start_pos", "end_pos")).where("pos between start_pos and end_pos").count()
    assert intervals.join_points(p, r, "closed", 500, crowded=100).count() == want
