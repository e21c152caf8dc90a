import gzip
import random
import re
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cytoframe.functions import names
from cytoframe.functions.smoothing import lowess, smooth
from cytoframe.operators import fastq, intervals, methylation, motif, ranks, read_quality, reads, sites, variants
from cytoframe.plans import region_pipeline
from cytoframe.plans.config import PipelineConfig
from cytoframe.sources import chain, sequences, tables
from cytoframe.streaming import reads as stream


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 60)), max_size=25), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 30)), max_size=12), st.sampled_from(["closed", "zero_based_half_open"]))
def test_binned_join_is_the_naive_join(spark, points, spans, coord):
    p = spark.createDataFrame([(i, c, x) for i, (c, x) in enumerate(points)], "i int, chrom string, pos long")
    r = spark.createDataFrame([(j, c, s, s + n) for j, (c, s, n) in enumerate(spans)], "j int, chrom string, start_pos long, end_pos long")
    got = rows(intervals.join_points(p, r, coord, 7).select("i", "j"))
    shift = 0 if coord == "closed" else 1
    assert got == sorted((i, j) for i, (c, x) in enumerate(points) for j, (d, s, n) in enumerate(spans) if c == d and s + shift <= x <= s + n)


def test_regions_empty_duplicated_and_boundaries(spark):
    allc = spark.createDataFrame([("c", 10, 1, 2, 0), ("c", 10, 3, 4, 1), ("c", 11, 0, 0, 2), ("c", 20, 5, 9, 3)], "chrom string, pos long, mc long, cov long, ord long")
    r = spark.createDataFrame([(1, "c", 10, 20), (2, "c", 10, 20), (3, "d", 1, 5)], "rid long, chrom string, start_pos long, end_pos long")
    got = {x["rid"]: x for x in methylation.region_methylation(allc, r, "closed").collect()}
    assert [got[i]["total_coverage"] for i in (1, 2, 3)] == [13, 13, 0]  # the last call of a site counts
    assert got[1]["sites_with_data"] == 3 and got[3]["methylation_percentage"] is None
    half = {x["rid"]: x for x in methylation.region_methylation(allc, r, "zero_based_half_open").collect()}
    assert half[1]["total_coverage"] == 9
    with pytest.raises(ValueError):
        methylation.region_methylation(allc, r, "open")


def test_overlapping_cpgs_prefer_the_first_base(spark):
    allc = spark.createDataFrame([("c", 10, 1, 2), ("c", 11, 3, 5), ("c", 12, 1, 1), ("c", 13, 9, 9)], "chrom string, pos long, mc long, cov long")
    cpgs = spark.createDataFrame([("c", 10), ("c", 11), ("c", 10)], "chrom string, start_pos long")
    assert rows(methylation.merge_cpgs(allc, cpgs)) == [("c", 9, 11, 1, 2), ("c", 10, 12, 4, 6)]


def test_combine_segments_twice_for_compatibility(spark):
    p = spark.createDataFrame([("up", 1), ("body", 0), ("other", 3)], "segment string, bin int")
    assert rows(methylation.combine_segments(p, [("up", 5), ("body", 7)])) == [("body", 5), ("up", 1)]
    assert methylation.combine_segments(p, [("up", 5), ("body", 7)], twice=True).count() == 4


def test_bed_round_trip_and_packed_names(spark):
    allc = spark.createDataFrame([("c", 5, "+", "CG", 1, 2, 1)], ", ".join(tables.ALLC))
    bed = sites.to_bed(allc).withColumnsRenamed({"start": "start_pos", "end": "end_pos"})
    assert rows(sites.from_bed(bed, True)) == rows(allc)
    odd = spark.createDataFrame([("c", 1, 2, "+", "CG_1"), ("c", 1, 2, "+", "CG_1_2_3"), ("c", 1, 2, "+", "CG_x_2")], ", ".join(tables.PACKED))
    assert sites.from_bed(odd, True).count() == 0 and sites.from_bed(odd, False).count() == 1


def test_motifs_sharing_a_base_and_isolation(spark):
    f = spark.createDataFrame([("a", "acgtcga"), ("b", "ACGA" + "C" * 40 + "TCGT"), ("n", None), ("e", "")], "chrom string, seq string")
    for length in (5, 11, 1000):
        chunks = sequences.chunked(f, length, 50)
        assert rows(motif.cpgs(chunks, 3)) == [("a", 1, 3, False), ("b", 1, 3, True), ("b", 45, 47, True)]
        assert [r["solo"] for r in motif.cpgs(chunks, 44).where("chrom = 'b'").collect()] == [False, False]


def test_motifs_are_the_same_from_chunks_of_any_length(spark, tmp_path):
    r = random.Random(4)
    texts = {f"s{i}": "".join(r.choice(["ACG", "ACGT", "TCGACGACG", "ACGACGACGACGACGACG", "N", "cgta", "GGA" * 20]) for _ in range(60)) for i in range(6)} | {"chain": "ACG" * 200 + "A", "none": "", "short": "A"}
    lines = ["junk"]
    for name, seq in texts.items():
        lines += [f">{name} more"] + [seq[i : i + 37] for i in range(0, len(seq), 37)]
    (tmp_path / "x.fa").write_text("\n".join(lines))
    want = []
    for name, seq in texts.items():
        up = seq.upper()
        every = [m.start() for m in re.finditer("CG", up)]
        for m in re.finditer("[AT]CG[AT]", up):
            p = m.start() + 1
            want.append((name, p, p + 2, not any(q != p and abs(q - p) <= 10 for q in every)))
    assert len(want) > 300
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for length in (6, 25, 64, 5000):
            chunks = sequences.read_fasta(spark, str(tmp_path / "x.fa"), length, 12).cache()
            assert rows(motif.cpgs(chunks, 10)) == sorted(want)
            assert max(len(x["seq"]) for x in chunks.collect()) <= length + 24
            assert {x["chrom"]: x["seq"] for x in sequences.whole_sequences(chunks).collect()} == texts
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_are_numbered_without_a_sort(spark, tmp_path):
    """Splits of one file, gzip files and several files; the plan has no window over lines."""
    want = {}
    for k, n in enumerate((1, 333, 90)):
        text = "".join(f"line {i} of {k}\n" for i in range(n))
        (tmp_path / f"a{k}.txt").write_text(text)
        with gzip.open(tmp_path / f"b{k}.txt.gz", "wt") as f:
            f.write(text)
        want |= {f"a{k}.txt": n, f"b{k}.txt.gz": n}
    for size in ("100", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = sequences.numbered_lines(spark, str(tmp_path))
            assert all(f"line {x['line_no']} of " in x["value"] for x in got.collect())
            assert {x["file"].rsplit("/", 1)[1]: x["n"] for x in got.groupBy("file").agg(F.count_distinct("line_no").alias("n")).collect()} == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    plan = sequences.read_fastq(spark, str(tmp_path / "a1.txt"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "value" not in plan[plan.index("Window") :].splitlines()[0]


@pytest.mark.parametrize("groups", [1, 3])
def test_places_of_one_group_in_many_ranges(spark, groups):
    r = spark.range(2000).select((F.col("id") % groups).alias("g"), F.xxhash64("id").alias("x"), (F.col("id") % 50).alias("y"))
    out = ranks.placed(r, ["g"], [F.desc("y"), "x"], parts=7)
    for g in range(groups):
        own = sorted(((x["place"], x["y"], x["x"]) for x in out.where(F.col("g") == g).collect()))
        assert [p for p, _, _ in own] == list(range(1, len(own) + 1))
        assert own == [(i, y, x) for i, (y, x) in enumerate(sorted(((y, x) for _, y, x in own), key=lambda t: (-t[0], t[1])), 1)]
    assert "Window" in out._jdf.queryExecution().optimizedPlan().toString()  # over counts of ranges alone
    assert ranks.placed(r.where("false"), ["g"], ["x"]).count() == 0


def _reads(spark, data):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "ord long, qname string, flag int, ref_id int, start_pos long, end_pos long")


def test_third_read_waits_anew_and_pair_rules(spark):
    r = _reads(spark, [("q", 99, 0, 10, 60), ("q", 147, 0, 40, 90), ("q", 99, 0, 1, 5), ("x", 99, 0, 1, 9), ("x", 147, 1, 3, 9), ("s", 99, 0, 50, 90), ("s", 147, 0, 20, 70), ("o", 65, 0, 1, 9), ("o", 129, 0, 5, 12)])
    p = reads.ordered_pairs(r)
    assert sorted(x["qname"] for x in p.collect()) == ["o", "q", "s", "x"]
    assert [x["qname"] for x in p.where(reads.dovetail()).collect()] == ["s"]
    assert rows(reads.fragments(r)) == [(0, 10, 90, "+", 80), (0, 50, 70, "+", 20)]
    assert dict((a, b) for a, b, _ in rows(reads.size_classes(r))) == {"medium": 2, "small": 1}


def test_masks(spark):
    df = spark.createDataFrame([([30, 30, 30, 30], [1, None, 3, 4], 64), ([30] * 4, [1, 2, 3, 4], 4)], "q array<int>, p array<long>, flag int")
    out = df.select(reads.mask_outside(F.col("q"), F.col("p"), F.lit(1), F.lit(4)), reads.mask_ends(F.col("q"), F.col("flag"), (1, 0), (2, 0))).collect()
    assert list(out[0]) == [[30, 0, 30, 0], [0, 30, 0, 0]] and out[1][1] == [30] * 4


def test_names(spark):
    df = spark.createDataFrame([("@NS_1/1 x", "Smp_S1_L001_R1_001.fastq.gz", "chr10"), ("@NS_1 1:N:0:ATCG", "A_I2.fq", "chr2")], "h string, n string, c string")
    got = df.select(names.read_id(F.col("h")), names.barcode(F.col("h")), names.sample_id(F.col("n")), names.read_type(F.col("n")), names.read_part(F.col("n"))).collect()
    assert list(got[0]) == ["NS_1", "@NS_1/1 x", "Smp", "R1", "R1"] and list(got[1]) == ["NS_1", "ATCG", "A", "I2", "I2"]
    assert [r["c"] for r in df.orderBy(*names.natural_key(F.col("c"))).collect()] == ["chr2", "chr10"]
    assert spark.range(1).select(names.hamming(F.lit("ACGT"), F.lit("AGGA"))).first()[0] == 2


def test_demultiplex_within_one_mismatch(spark):
    f = spark.createDataFrame([(f"@r:{b}+GG",) for b in ("ACGT", "ACGA", "AAAA", "CCCC")], "header string")
    sheet = spark.createDataFrame([("one", "ACGT"), ("two", "CCCC")], "sample string, index string")
    assert {r["header"][3:7]: r["sample"] for r in fastq.demultiplex(f, sheet).collect()} == {"ACGT": "one", "ACGA": "one", "AAAA": None, "CCCC": "two"}


CHAINS = "chain long, score long, chrom string, block_start long, block_end long, target_chrom string, target_start long, target_strand string, target_size long"


def test_lift_over_of_reversed_blocks_gaps_and_repeated_rows(spark):
    bed = spark.createDataFrame([("c", 10, 12), ("c", 99, 100), ("c", 10, 12), ("c", 15, 35), ("c", 5, 5)], "chrom string, start_pos long, end_pos long")
    blocks = spark.createDataFrame([(1, 50, "c", 5, 20, "n", 105, "-", 1000), (1, 50, "c", 21, 40, "n", 120, "-", 1000), (2, 20, "c", 0, 60, "m", 500, "+", 900)], CHAINS)
    got = rows(variants.lift_over(bed, blocks, bin_size=16).na.fill(-1).na.fill("-"))
    assert got == [("c", 5, 5, "-", -1, -1), ("c", 10, 12, "n", 888, 890), ("c", 10, 12, "n", 888, 890), ("c", 15, 35, "n", 866, 885), ("c", 99, 100, "-", -1, -1)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 30)), max_size=15), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 30)), max_size=8))
def test_overlap_semi_join_is_the_naive_one(spark, mine, others):
    span = "chrom string, start_pos long, end_pos long"
    a = spark.createDataFrame([(c, s, s + n) for c, s, n in mine], span)
    b = spark.createDataFrame([(c, s, s + n) for c, s, n in others], span)
    want = sorted((c, s, s + n) for c, s, n in mine if n and any(c == d and m and s < t + m and s + n > t for d, t, m in others))
    assert rows(intervals.overlapping(a, b, bin_size=7)) == want


def test_variants_reach_into_regions(spark):
    v = spark.createDataFrame([("c", 10, "ATG", "A"), ("c", 12, "A", "T")], "chrom string, pos long, ref string, alt string")
    r = spark.createDataFrame([("c", 10, 11)], "chrom string, start_pos long, end_pos long")
    assert [x["pos"] for x in variants.in_regions(v, r).collect()] == [10]


def test_rename_plan_sees_files_that_are_there(spark):
    f = spark.createDataFrame([("d", n) for n in ("A_S1_L001_R1.fq", "A_R1.fq", "B_S1_L001_R1.fq", "B_S2_L001_R1.fq")] + [("e", "C_S1_L001_R1.fq"), ("e", "D_S1_L002_R1.fq")], "dir string, name string")
    assert {(r["old"], r["action"]) for r in fastq.rename_plan(f).collect()} == {("A_S1_L001_R1.fq", "skip"), ("B_S1_L001_R1.fq", "rename"), ("B_S2_L001_R1.fq", "skip"), ("C_S1_L001_R1.fq", "abort"), ("D_S1_L002_R1.fq", "abort")}


def test_reference_positions_of_every_operation(spark):
    df = spark.createDataFrame([("2S3M1I2M2D1M3N1=1X2H", 10), (None, 5)], "c string, s long")
    got = [r[0] for r in df.select(reads.reference_positions(F.col("c"), F.col("s"))).collect()]
    assert got == [[None, None, 10, 11, 12, None, 13, 14, 17, 21, 22], None]


def test_merged_genotypes(spark):
    c = spark.createDataFrame([("a", "c", 5, "C", ["T"], "0/1"), ("b", "c", 5, "C", ["G", "T"], "1|2"), ("b", "c", 9, "A", ["G"], "./.")], "sample string, chrom string, pos long, ref string, alts array<string>, genotype string")
    got = {r["pos"]: (r["alts"], r["genotypes"]) for r in variants.merge_genotypes(c).collect()}
    assert got == {5: (["G", "T"], {"a": "0/2", "b": "1|2"}), 9: (["G"], {"b": "./."})}


def test_synchronised_files_hold_the_same_reads(spark):
    a = spark.createDataFrame([("@x/1",), ("@y/1",), ("@y/1",)], "header string")
    b = spark.createDataFrame([("@y/2",), ("@z/2",)], "header string")
    assert tuple(fastq.same_reads(a, b).first()) == (1, 1, 1)


def test_sampled_reads_keep_mates_together(spark):
    """Nested samples of exact sizes, the same for both mates, in however many prefixes the depths lie."""
    f = spark.createDataFrame([(i, f"@r{i}/{m}") for i in range(500) for m in (1, 2)], "rec_no long, header string")
    one, two = ({r["header"][:-2]: r["depth"] for r in fastq.sample_depths(f.where(f"header LIKE '%/{m}'"), (10, 30, 499)).collect()} for m in (1, 2))
    assert one == two and [sum(d <= n for d in one.values()) for n in (10, 30, 499)] == [10, 30, 499]
    same = f.withColumn("header", F.lit("@one"))  # all records of one id
    assert sorted(r["rec_no"] for r in fastq.sample_depths(same.where("rec_no < 100").dropDuplicates(), (5, 8)).where("depth = 5").collect()) == [0, 1, 2, 3, 4]
    assert fastq.sample_depths(f, (5000,)).count() == 1000 and fastq.sample_depths(f.where("false"), (5,)).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.text("MIDSN=X", min_size=0, max_size=5), st.integers(0, 40)), max_size=8), st.sampled_from([1, 2]))
def test_depth_equals_a_count_of_bases(spark, data, least):
    """Any cigar, any bin width; a read's last qualities may be missing."""
    r, made, depth = random.Random(1), [], {}
    for start, ops, lost in data:
        parts = [(r.randint(1, 9), op) for op in ops]
        stored = sum(n for n, op in parts if op in "MIS=X")
        quals = [r.randint(20, 40) for _ in range(max(0, stored - lost))]
        made.append((1, 0, start, "".join(f"{n}{op}" for n, op in parts), quals))
        at, q = start, 0
        for n, op in parts:
            if op in "M=X":
                for i in range(n):
                    if q + i < len(quals) and quals[q + i] >= 30:
                        depth[at + i] = depth.get(at + i, 0) + 1
            at += n if op in "MDN=X" else 0
            q += n if op in "MIS=X" else 0
    made += [(1, 4, 5, "9M", [40] * 9), (1, 0, None, "9M", [40] * 9), (1, 0, 5, None, None), (1, 0, 5, "9M", None)]
    df = spark.createDataFrame(made, "ref_id int, flag int, start_pos long, cigar string, quals array<int>")
    for width in (4, 16384):
        got = read_quality.base_depth(df, 30, least, width).collect()
        assert {p: x["depth"] for x in got for p in range(x["start"], x["end"])} == {p: n for p, n in depth.items() if n >= least}


def test_position_quality_of_odd_reads(spark):
    df = spark.createDataFrame([("a", "ACgt", "I!5"), ("a", None, None), ("a", "", ""), ("b", None, "IJ"), (None, "A", "I"), ("a", "N-", "II")], "file string, seq string, qual string")
    got = {(x["file"], x["position"]): x for x in read_quality.position_quality(df).collect()}
    assert set(got) == {("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2)}
    assert got["a", 1]["mean"] == 40 and got["a", 1]["a"] == 0.5 and got["a", 1]["n"] == 0.5 and got["a", 2]["q1"] == 0 and got["a", 2]["q3"] == 40
    assert got["a", 4]["mean"] is None and got["a", 4]["t"] == 1 and got["b", 2]["reads"] == 1 and got["b", 2]["a"] is None
    assert read_quality.position_quality(df.where("false")).count() == 0


def test_smoothing(spark):
    x = np.arange(50.0)
    assert np.allclose(lowess(x, 3 * x + 1, 0.3), 3 * x + 1)
    p = spark.createDataFrame([("g", i, float(i)) for i in range(10)] + [("g", 10, None)], "group string, bin int, pct double")
    assert smooth(p, "group", "bin", "pct", 0).count() == 10


def test_smoothing_equals_plain_loops():
    """Local lines by tricube weights, with three robust steps, point by point."""
    r = np.random.default_rng(3)
    x = np.sort(r.uniform(0, 10, 40))
    y = np.sin(x) + r.normal(0, 0.1, 40)
    k = int(np.ceil(0.4 * 40))
    robust = np.ones(40)
    for step in range(4):
        fit = np.empty(40)
        for i in range(40):
            d = np.abs(x - x[i])
            h = np.sort(d)[k - 1]
            w = np.clip(1 - (d / h) ** 3, 0, None) ** 3 * robust
            m, n = (w * x).sum() / w.sum(), (w * y).sum() / w.sum()
            slope = (w * (x - m) * (y - n)).sum() / (w * (x - m) ** 2).sum()
            fit[i] = n + slope * (x[i] - m)
        e = np.abs(y - fit)
        robust = np.clip(1 - (e / (6 * np.median(e))) ** 2, 0, None) ** 2
    assert np.abs(lowess(x, y, 0.4) - fit).max() < 0.02


def test_files_in_several_splits(spark, tmp_path):
    """Records and sequences that lie across the splits of a file."""
    records = [(f"@r{i} x:{i}", "ACGT"[: i % 4 + 1], "+", "IIII"[: i % 4 + 1]) for i in range(300)]
    (tmp_path / "a.fastq").write_text("\n".join("\n".join(r) for r in records) + "\n@tail\nAC")
    (tmp_path / "a.fa").write_text("; note\n" + "".join(f">c{i} about\n" + "ACGT\n" * (i % 7) for i in range(80)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = sequences.numbered_lines(spark, str(tmp_path / "a.fastq"))
        assert lines.rdd.getNumPartitions() > 10
        got = sequences.read_fastq(spark, str(tmp_path / "a.fastq")).orderBy("rec_no").collect()
        assert [(r["header"], r["seq"], r["plus"], r["qual"]) for r in got] == [*records, ("@tail", "AC", None, None)]
        assert rows(sequences.whole_sequences(sequences.read_fasta(spark, str(tmp_path / "a.fa")))) == sorted((f"c{i}", "ACGT" * (i % 7)) for i in range(80))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_discovery_lists_and_missing_results(spark, tmp_path):
    for name in ("b/x.fastq.gz", "a/y.fastq.gz", "a/z.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("1")
    got = tables.discover(spark, str(tmp_path), "*.fastq.gz").collect()
    assert [(r["dir"][-1], r["name"], r["size"]) for r in got] == [("a", "y.fastq.gz", 1), ("b", "x.fastq.gz", 1)]
    (tmp_path / "list.txt").write_text("one\n\n two \n")
    assert tables.listed_paths(spark, str(tmp_path / "list.txt")) == ["one", "two"]
    assert tables.read_results(spark, str(tmp_path / "none"), "a long").count() == 0
    (tmp_path / "s.csv").write_text("[Header]\nx,1\n[Data],,\nSample_ID,Sample_Name,index\ns1,one,ACGT\n\ns2,two,GGGG\n")
    assert rows(tables.read_demux_sheet(spark, str(tmp_path / "s.csv"))) == [("s1", "one", "ACGT"), ("s2", "two", "GGGG")]
    (tmp_path / "c.chain").write_text("chain 9 chr1 100 + 10 40 n1 90 - 5 34 7\n10 2 1\n18\n\nchain 5 chr2 50 + 0 4 n2 60 + 1 5 8\n4\n")
    assert rows(chain.read_chain(spark, str(tmp_path / "c.chain")).select("chain", "block_start", "block_end", "target_start", "score")) == [(7, 10, 20, 5, 9), (7, 22, 40, 16, 9), (8, 0, 4, 1, 5)]


def test_pipeline_from_files(spark, tmp_path):
    (tmp_path / "c1.NCGN-Both.allc.tsv").write_text("chr1\t5\t+\tACGT\t1\t2\t1\nchr1\t5\t+\tACGT\t2\t4\t1\nchr1\t90\t+\tACGT\t1\t1\t1\n")
    with gzip.open(tmp_path / "c2.NCGN-Both.allc.tsv.gz", "wt") as f:
        f.write("chr1\t6\t-\tACGT\t3\t3\t1\n")
    (tmp_path / "c3.other.allc.tsv").write_text("chr1\tbroken\n")
    (tmp_path / "body.bed").write_text("chr1\t1\t10\t0\tx\t+\tg1\nchr1\t1\t10\t1\tx\t-\tg2\nchr1\t50\t60\t0\tx\t+\tg1\n")
    (tmp_path / "m.csv").write_text("gene,c1,c2\ng1,transcribed,silent\ng2,transcribed,transcribed\n")
    (tmp_path / "meta.csv").write_text("id,group,barcode\n1,A,c1\n2,B,c2\n")
    config = PipelineConfig.parse(f"contexts: [NCGN-Both]\nregions: {{body: {{bed_file: {tmp_path}/body.bed, strand_column: 6, n_bins: 2}}}}\nmin_coverage: 4")
    paths = [str(tmp_path / n) for n in ("c1.NCGN-Both.allc.tsv", "c2.NCGN-Both.allc.tsv.gz", "c3.other.allc.tsv")]
    out = region_pipeline.run(spark, paths, config, str(tmp_path / "m.csv"), str(tmp_path / "meta.csv"), "NCGN")
    got = {(r["sample"], r["region_id"], r["strand_side"]): (r["total_coverage"], r["total_methylated"], r["sites_with_data"]) for r in out.region_rows.collect()}
    assert got == {("c1", "chr1:1-10", "top"): (4, 2, 1), ("c1", "chr1:1-10", "bottom"): (4, 2, 1), ("c1", "chr1:50-60", "top"): (0, 0, 0), ("c2", "chr1:1-10", "top"): (3, 3, 1), ("c2", "chr1:1-10", "bottom"): (3, 3, 1), ("c2", "chr1:50-60", "top"): (0, 0, 0)}
    # the top bin's sums count once for each of the two transcribed rows of g1
    assert rows(out.profiles.select("group", "segment", "bin", "total_coverage", "methylation_percentage").na.fill(-1.0)) == [("A", "body", 0, 8, 50.0), ("A", "body", 1, 4, 50.0), ("B", "body", 1, 3, -1.0)]
    region_pipeline.write(out, str(tmp_path / "out"))
    back = tables.read_results(spark, str(tmp_path / "out/profiles"), "segment string, bin long, total_coverage long, total_methylated long, methylation_percentage string, group string")
    assert sorted(r["group"] for r in back.collect()) == ["A", "A", "B"]
    with pytest.raises(ValueError):
        region_pipeline.run(spark, paths, config, str(tmp_path / "m.csv"), None, "HCH")


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("# x\nc\t5\t+\tCG\t1\t2\t1\nc\t6\t+\tCG\t1\nc\t7\t+\tCG\tx\t2\t1\n")
    assert tables.read_allc(spark, str(tmp_path / "a.tsv"), strict=False).count() == 1
    with pytest.raises(Exception):
        tables.read_allc(spark, str(tmp_path / "a.tsv")).collect()
    with gzip.open(tmp_path / "r.fastq.gz", "wt") as f:
        f.write("@a 1:N:0:AC\nACG\n+\nIII\n@b\nA\n")
    r = tables_fastq = sequences.read_fastq(spark, str(tmp_path / "r.fastq.gz"))
    assert [(x["rec_no"], x["seq"], x["plus"]) for x in tables_fastq.orderBy("rec_no").collect()] == [(0, "ACG", "+"), (1, "A", None)]
    sequences.write_fastq(r.where("rec_no = 0"), str(tmp_path / "out"), compress=False)
    assert sequences.read_fastq(spark, str(tmp_path / "out/part-*")).where("rec_no = 0").first()["header"] == "@a 1:N:0:AC"
    (tmp_path / "x.fa").write_text(">c1 d\nAC\nGT\n>c2\nA\n")
    assert rows(sequences.whole_sequences(sequences.read_fasta(spark, str(tmp_path / "x.fa")))) == [("c1", "ACGT"), ("c2", "A")]
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\nc\t5\trs\tC\tT,G\t9.5\t.\tDP=3;X=1\n")
    v = sequences.read_vcf(spark, str(tmp_path / "v.vcf")).first()
    assert (v["pos"], v["alt"], v["info"]["DP"], v["filter"]) == (5, ["T", "G"], "3", None)


def test_variant_and_bin_sinks(spark, tmp_path):
    v = spark.createDataFrame([("chr10", 4, "a", "C", ["T", "G"], {"DP": "3"}, "GT", "0/1"), ("chr2", 9, None, "G", ["A"], {}, "GT", None)], "chrom string, pos long, id string, ref string, alt array<string>, info map<string,string>, format string, s1 string")
    sequences.write_vcf(v, str(tmp_path / "v"), ["##fileformat=VCFv4.2"], {"s1": "donor"})
    lines = "".join(p.read_text() for p in sorted((tmp_path / "v").glob("part-*"))).splitlines()
    assert lines[0] == "##fileformat=VCFv4.2" and lines[1].split("\t")[-2:] == ["FORMAT", "donor"]
    assert lines[2:] == ["chr2\t9\t.\tG\tA\t.\t.\t.\tGT\t.", "chr10\t4\ta\tC\tT,G\t.\t.\tDP=3\tGT\t0/1"]
    assert sequences.read_vcf(spark, str(tmp_path / "v")).count() == 2
    tables.write_bedgraph(spark.createDataFrame([("c", 100, 0.5), ("c", 0, 0.25), ("c", 200, None)], "chrom string, bin_start long, fraction double"), str(tmp_path / "b"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "b").glob("part-*"))) == "c\t0\t100\t0.25\nc\t100\t200\t0.5\n"


def test_bam_and_integrity(spark, tmp_path):
    name, cigar, seq = b"q\0", struct.pack("<I", 4 << 4), bytes([0x12, 0x48])
    body = struct.pack("<iiBBHHHiiii", 0, 9, len(name), 60, 0, 1, 99, 4, -1, -1, 0) + name + cigar + seq + bytes([30] * 4) + b"XRZCT\0" + b"NMC\x02"
    raw = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 100) + struct.pack("<i", len(body)) + body
    whole = gzip.compress(raw) + sequences.BGZF_END
    (tmp_path / "a.bam").write_bytes(whole)
    (tmp_path / "b.bam").write_bytes(whole[:40])
    r = sequences.read_bam(spark, str(tmp_path / "a.bam")).first()
    assert (r["qname"], r["flag"], r["ref_name"], r["start_pos"], r["end_pos"], r["cigar"], r["seq"], r["tags"]) == ("q", 99, "c1", 9, 13, "4M", "ACGT", {"XR": "CT", "NM": "2"})
    assert {x["path"][-5:]: (x["gzip_ok"], x["bam_ok"]) for x in sequences.integrity(spark, str(tmp_path)).collect()} == {"a.bam": (True, True), "b.bam": (False, False)}
    assert zlib.crc32(b"") == 0


def test_config():
    c = PipelineConfig.parse("contexts: [NCGN-Both]\nregions: {body: {bed_file: x.bed, strand_column: 5}}\nmin_coverage: 3")
    assert c.context_of("cell1.NCGN-Both.allc.tsv.gz") == "NCGN" and c.context_of("z") is None and c.regions["body"].n_bins == 20


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stream.ROCKSDB)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_streamed_pairs_over_a_restart(spark, tmp_path, rocksdb):
    """Reads out of order within and over runs from one checkpoint, a third read, a mate that comes too late, a late row."""
    schema = "qname string, rec_no long, time timestamp, flag int, ref_id int, start_pos long, end_pos long"

    def run(reads):
        made = spark.createDataFrame([(q, n, t, 99, 0, n, n + 5) for q, n, t in reads], "qname string, rec_no long, t long, flag int, ref_id int, start_pos long, end_pos long")
        made.withColumn("t", F.timestamp_seconds("t")).withColumnRenamed("t", "time").select(*[f.split()[0] for f in schema.split(", ")]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = stream.match_pairs(source, "100 seconds", "50 seconds")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
        return sorted((r["qname"], r["rec1"], r["rec2"]) for r in spark.read.schema(stream.PAIR).parquet(str(tmp_path / "out")).collect())

    assert run([("b", 4, 40), ("b", 2, 20), ("a", 1, 10), ("three", 5, 50), ("three", 7, 70), ("three", 6, 60)]) == []  # none is passed yet
    assert run([("a", 3, 15), ("late", 8, 80), ("on", 9, 200)]) == [("a", 1, 3), ("b", 2, 4), ("three", 5, 6)]
    # `late` has waited its 50 seconds in vain; a row from before the watermark is dropped; `on` pairs with its mate
    got = run([("on", 11, 390), ("a", 2, 12), ("on", 10, 240), ("late", 12, 340), ("end", 99, 900)])
    assert got == [("a", 1, 3), ("b", 2, 4), ("on", 9, 10), ("three", 5, 6)]


def test_metrics_are_counted_while_writing(spark, tmp_path):
    """One execution writes the rows and gives the six numbers."""
    raw = spark.createDataFrame([("c", 1, 3, 1, 2), ("c", 1, 3, None, 2), ("c", 5, 7, 1, 1), ("c", 9, 11, 0, 4)], "chrom string, start long, end long, mc long, cov long")
    cpgs = spark.createDataFrame([("c", 1, 3), ("c", 9, 11), ("c", 9, 11), ("c", 9, 11)], "chrom string, start_pos long, end_pos long")
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    before = store.executionsCount()
    got = sites.write_filtered(raw, cpgs, str(tmp_path / "kept"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    assert store.executionsCount() == before + 1
    assert got == {"input": 4, "nan_removed": 1, "before": 3, "after": 4, "filtered_out": -1, "retention_pct": 4 / 3 * 100}
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 4
    none = sites.write_filtered(raw.where("false"), cpgs, str(tmp_path / "none"))
    assert none["input"] == none["after"] == 0 and none["retention_pct"] is None


def test_spans_of_clustered_reads_pass_over_row_groups(spark, tmp_path):
    r = spark.range(200_000).select(F.concat(F.lit("chr"), (F.col("id") % 3).cast("string")).alias("chrom"), (F.hash("id") % 1_000_000).cast("long").alias("start_pos")).withColumn("end_pos", F.col("start_pos") + 60)
    tables.write_clustered(r, str(tmp_path / "t"), "chrom", "start_pos", group_bytes=100_000)
    found = reads.in_span(spark.read.parquet(str(tmp_path / "t")), F.col("chrom"), "chr1:5,000-9,000")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, reads.in_span(r, F.col("chrom"), "chr1:5,000-9,000").collect())) != []
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.queryExecution().toRdd().count()
    scanned = plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert 0 < scanned < 60_000


def test_region_join_over_a_bucketed_table(spark, tmp_path):
    """No exchange of sites, and the same sums, long regions included."""
    allc = spark.range(3000).select(F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("chrom"), (F.col("id") * 7).alias("pos"), (F.col("id") % 5).alias("mc"), F.lit(6).cast("long").alias("cov"))
    table = tables.write_bucketed(allc, "bucketed_sites", str(tmp_path / "b"), 4, 100)
    regions = spark.createDataFrame([(i, f"c{i % 2}", i * 40, i * 40 + (9000 if i % 50 == 0 else 30)) for i in range(400)], "rid long, chrom string, start_pos long, end_pos long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        short = intervals.join_binned(table, regions.where("end_pos - start_pos < 100"), "closed", 100)
        lines = short._jdf.queryExecution().executedPlan().toString().split("Union")[1].split("FileScan")[1:2]
        top = short._jdf.queryExecution().executedPlan().toString()
        join = top[top.index("SortMergeJoin") :]
        sites_side = join[: join.index("FileScan")]
        assert lines and "Exchange" not in sites_side and "Bucketed: true" in join
        got = {r["rid"]: (r["total_coverage"], r["sites_with_data"]) for r in methylation.bucketed_region_sums(table, regions, "closed", 100).collect()}
        want = {r["rid"]: (r["total_coverage"], r["sites_with_data"]) for r in methylation.region_sums(allc, regions, "closed", 100).collect()}
        assert got == want and len(want) == 400 and want[0][1] > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_sites")


def test_columns_by_a_repeated_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "y", "x")
    assert sites.select_columns(df, "x").first()[0] == 3 and tuple(sites.select_columns(df, "y", "x").first()) == (2, 3)
    with pytest.raises(ValueError):
        sites.select_columns(df, "z")


def test_inline_comments_and_order_of_written_reads(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("c\t5\t+\tCG\t1\t2\t1 # note\n# whole\nc\t6\t+\tCG # cut off\n  \nc\t7\t-\tCG\t0\t1\t1\n")
    got = tables.read_table(spark, str(tmp_path / "a.tsv"), tables.ALLC, tables.Policy(6, inline_comments=True))
    assert [(r["pos"], r["flag"]) for r in got.orderBy("ord").collect()] == [(5, 1), (7, 1)]
    assert tables.read_table(spark, str(tmp_path / "a.tsv"), tables.ALLC, tables.Policy(6, inline_comments=False)).count() == 2
    r = spark.range(300).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("qname"), F.lit(99).alias("flag"), (F.col("id") % 3).cast("int").alias("ref_id"), F.concat(F.lit("chr"), (F.col("id") % 3).cast("string")).alias("ref_name"), (F.hash("id") % 1000 + 1000).cast("long").alias("start_pos"), F.lit("5M").alias("cigar"), F.array(F.lit(30)).alias("quals"))
    sequences.write_sam(r.repartition(5), str(tmp_path / "sam"), ("@HD\tVN:1.6",))
    lines = [x for f in sorted((tmp_path / "sam").glob("part-*")) for x in f.read_text().splitlines()]
    place = [(x.split("\t")[2], int(x.split("\t")[3])) for x in lines[1:]]
    assert lines[0].startswith("@HD") and len(place) == 300 and place == sorted(place)
