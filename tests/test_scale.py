"""Plans whose largest step grows no faster than the input."""

import pathlib
import random
import re
import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from cytoframe.operators import intervals, methylation, read_quality
from cytoframe.plans import catalog, region_pipeline
from cytoframe.plans.config import PipelineConfig
from cytoframe.sources import sequences, tables
from cytoframe.streaming import reads as stream


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_intervals_are_not_broadcast(spark):
    """Spark sizes exploded rows by their source, which is small here; their bins are sorted and merged all the same."""
    a = spark.range(2000).select(F.lit("c").alias("chrom"), (F.col("id") * 90).alias("start_pos"), (F.col("id") * 90 + 70).alias("end_pos"))
    p = a.select("chrom", F.col("start_pos").alias("pos"))
    other = a.select("chrom", F.col("start_pos").alias("other_start"), F.col("end_pos").alias("other_end"))
    near = intervals.in_bins(p, a, "closed", 7)
    for df in (intervals.overlapping(a, a.where("start_pos % 180 = 0"), 7), near, intervals.join_points(p, a, "closed", 7), intervals.join_overlapping(a, other, 7)):
        assert "SortMergeJoin" in plan(df) and "BroadcastHashJoin" not in plan(df)
    assert intervals.overlapping(a, a.where("start_pos % 180 = 0"), 7).count() == 1000 and near.count() == 2000


def test_long_regions_are_summed_from_their_ends(spark, tmp_path):
    """No site meets a region; the sums are those of a walk over all sites, with nulls, repeated and empty regions."""
    rng = random.Random(7)
    sites = [(rng.choice(["c", "d", None]), rng.choice([None, *range(-20, 3_000_000, 9001), *range(60)]), rng.choice([None, 0, 1, 4]), rng.choice([None, 0, 5]), i) for i in range(3000)]
    regions = [(i // 2, rng.choice(["c", "d", "e", None]), rng.choice([None, 0, 7, 9, 3_000_000]), rng.choice([None, 0, 8, 9, 50, 2_000_000, 10**10])) for i in range(300)]
    allc = spark.createDataFrame(sites, "chrom string, pos long, mc long, cov long, ord long").repartition(3)
    given = spark.createDataFrame(regions, "rid long, chrom string, start_pos long, end_pos long")
    last = {(c, p): (m, n) for c, p, m, n, _ in sites}
    for coord, more in (("closed", 0), ("zero_based_half_open", 1)):
        sums = {}
        for rid, c, lo, hi in regions:
            if None not in (c, lo, hi):
                own = [v for (d, p), v in last.items() if d == c and p is not None and lo + more <= p <= hi]
                sums[rid] = [a + b for a, b in zip(sums.get(rid, (0, 0, 0)), (sum(n or 0 for _, n in own), sum(m or 0 for m, _ in own), len(own)))]
        out = methylation.region_methylation(allc, given, coord, bin_size=10, long=True)
        got = sorted((r["rid"], r["total_coverage"], r["total_methylated"], r["sites_with_data"]) for r in out.collect())
        assert got == sorted((rid, *sums.get(rid, (0, 0, 0))) for rid, *_ in regions) and any(g[3] > 100 for g in got)
    for t in ("lineitem", "orders"):
        (tmp_path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    assert "lineitem.parquet" not in plan(catalog.QUERIES["region_methylation_mixed"](spark, str(tmp_path)))


def test_qualities_of_a_batch_at_once(spark, tmp_path):
    """No function is called for each base; the values and texts are those of the functions that were, odd ones too."""
    rng = random.Random(9)
    values = [None, [], [None], [40, None, -34, -33, 94, 95, 222, 223, 300]] + [[rng.randrange(94) for _ in range(rng.randrange(60))] for _ in range(200)]
    given = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<int>").repartition(3)
    text = F.array_join(F.transform("v", lambda q: F.char(q + 33)), "")
    got = given.select("i", text.alias("want"), F.arrow_udf(sequences.quality_text, "string")("v").alias("got"))
    assert got.where("NOT (want <=> got)").count() == 0 and got.where("got IS NOT NULL").count() == 203
    texts = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "*", "I\u00e9\u20acJ", "\U0001f600I", *("".join(chr(33 + q) for q in v) for v in values[4:])])], "i int, t string").repartition(3)
    found = {r["i"]: (r["t"], r["v"]) for r in texts.select("i", "t", F.arrow_udf(sequences.quality_values, "array<int>")("t").alias("v")).collect()}
    assert len(found) == 205 and all(v == (None if t is None else [ord(x) - 33 for x in t]) for t, v in found.values())
    part = pa.array(values, pa.list_(pa.int32())).slice(5, 50)
    assert sequences.quality_values(sequences.quality_text(part)).to_pylist() == part.to_pylist()
    assert sequences.quality_values(pa.array(["ab", None, "c\u00e9"]).slice(1)).to_pylist() == [None, [66, 200]]
    reads = spark.createDataFrame([("q", 0, 0, "c", 5, "2M", [40, 2]), ("r", 0, 0, "c", 5, None, None)], "qname string, flag int, ref_id int, ref_name string, start_pos long, cigar string, quals array<int>")
    sequences.write_sam(reads, str(tmp_path / "sam"))
    again = sequences.read_sam(spark, str(tmp_path / "sam")).select("qname", "quals")
    assert "lambda" not in plan(again) and sorted(map(tuple, again.collect())) == [("q", [40, 2]), ("r", None)]


def test_pairs_of_a_bucket_of_names():
    """Many names at once: the pairs of a walk over each name's reads, and what waits on."""
    rng = random.Random(3)
    for n in (0, 1, 2, 400):
        rows = [(f"q{rng.randrange(60)}", i, rng.randrange(0, 100), 99, 0, i, i + 5) for i in range(n)]
        want, waits = [], []
        for name in {r[0] for r in rows}:
            first = None
            for r in sorted(r for r in rows if r[0] == name and r[2] <= 70):
                if first is None or r[2] - first[2] > 20:
                    first = r
                else:
                    want.append((name, first[1], r[1]))
                    first = None
            waits += [first] if first is not None and first[2] + 20 > 70 else []
        waits += [r for r in rows if r[2] > 70]
        done, kept, wake = stream.paired(pd.DataFrame(rows, columns=stream.NAMES), 70, 20)
        assert sorted(zip(done["qname"], done["rec1"], done["rec2"])) == sorted(want)
        assert sorted(kept.itertuples(index=False, name=None)) == sorted(waits)
        assert wake == min((r[2] if r[2] > 70 else r[2] + 20 for r in waits), default=0)


def test_runs_of_all_reads_at_once():
    """The bases that a walk over each read finds: several operations, short, absent and null qualities, odd texts."""
    rng = random.Random(5)
    reads = [(rng.randrange(1000), "".join(f"{rng.randrange(12)}{rng.choice('MIDNSHP=X')}" for _ in range(rng.randrange(6))), [rng.choice([10, 30, 40, None]) for _ in range(rng.randrange(40))]) for _ in range(300)]
    reads += [(5, "*", [40]), (5, "3M", None), (7, "2x3M", [40] * 9), (9, "12", [40]), (9, "3M", [40] * 9)]
    want = []
    for i, (at, cigar, quals) in enumerate(reads):
        q = 0
        for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
            n = int(n)
            if op in "M=X":
                want += [(i, at + k) for k in range(n) if q + k < len(quals or []) and (quals[q + k] or 0) >= 30]
            at += n if op in "MDN=X" else 0
            q += n if op in "MIS=X" else 0
    for skip in (0, 7):
        part = pa.RecordBatch.from_arrays([pa.array([r[k] for r in reads], t) for k, t in enumerate((pa.int64(), pa.string(), pa.list_(pa.int32())))], names=list("acq")).slice(skip)
        row, low, high = read_quality.covered_runs(part.column(0).to_numpy(), part.column(1), part.column(2), 30)
        got = sorted((i + skip, x) for i, a, b in zip(row.tolist(), low.tolist(), high.tolist()) for x in range(a, b))
        assert got == sorted(w for w in want if w[0] >= skip)


def test_base_depth_decodes_reads_once(spark):
    """The Python step stands in no plan of the result: what it gave is written."""
    df = spark.createDataFrame([(0, 0, 20_000 * i, "9M", [40] * 9) for i in range(4)] * 2, "ref_id int, flag int, start_pos long, cigar string, quals array<int>")
    got = read_quality.base_depth(df)
    assert "MapInArrow" not in plan(got)
    assert sorted(map(tuple, got.collect())) == [(0, 20_000 * i, 20_000 * i + 9, 2) for i in range(4)]


def test_zeros_of_all_names_are_not_shuffled(spark):
    """Rows are multiplied by names above the last exchange; every row has every name once, with its hits or zeros."""
    rows = spark.range(50).select(F.col("id").alias("rid"), (F.col("id") % 3).alias("x")).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("rid"), F.lit(9).cast("long").alias("x")))
    names = spark.createDataFrame([("a", "u"), ("b", "u"), ("b", "v")], "sample string, context string")
    hits = spark.createDataFrame([("b", "u", 3, 5, 2, 1), ("a", "u", 3, 7, 1, 2), ("b", "v", 49, 1, 0, 1), ("z", "u", 4, 1, 1, 1), ("a", "u", None, 1, 1, 1)], "sample string, context string, rid long, c long, m long, n long")
    out = methylation.for_each(rows, hits, ["rid"], names)
    text = plan(out)
    assert text.index("Generate inline") < text.index("Exchange")
    got = {(r["rid"], r["sample"], r["context"]): (r["c"], r["m"], r["n"]) for r in out.collect()}
    assert len(got) == out.count() == 51 * 3
    assert {k: v for k, v in got.items() if v != (0, 0, 0)} == {(3, "b", "u"): (5, 2, 1), (3, "a", "u"): (7, 1, 2), (49, "b", "v"): (1, 0, 1)}
    assert methylation.for_each(rows, hits.where("false"), ["rid"], names).where("c + m + n = 0").count() == 153


def test_order_over_part_files(spark, tmp_path):
    """`ord` goes on from part file to part file, whatever their sizes."""
    long, short = [("c1", 5 + i, "+", "CG", 1, 2, 1) for i in range(300)], [("c1", 5, "+", "CG", 0, 9, 1)]
    for n, part in enumerate((short, long, short)):
        with open(tmp_path / f"part-0000{n}-x.txt", "w") as f:
            f.writelines("\t".join(map(str, r)) + "\n" for r in part)
    got = tables.read_allc(spark, str(tmp_path))
    assert methylation.last_call(got).where("pos = 5").collect()[0]["cov"] == 9
    assert methylation.last_call(tables.read_allc(spark, [str(tmp_path / f"part-0000{n}-x.txt") for n in (0, 1)])).where("pos = 5").collect()[0]["cov"] == 2


def test_region_tables_are_written_in_little_space(spark, tmp_path, monkeypatch):
    """What an execution shuffled is gone when its table is written; region rows come from one written table, without a shuffle
    or a sort of a row for each interval and file, and are gzipped. Repeated intervals and such without a bin have their sums."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    kept = lambda: {f.name for d in disk for f in pathlib.Path(d).rglob("shuffle_*")}
    for c in ("c1", "c2"):
        (tmp_path / f"{c}.NCGN-Both.allc.tsv").write_text("".join(f"chr1\t{p}\t+\tACGT\t1\t{2 if c == 'c1' else 3}\t1\n" for p in range(1, 4000, 10)))
    spans = [("chr1", s, s + 1500, b, "x", strand, "g1") for s, b, strand in ((1, "0", "+"), (1, "0", "+"), (500, "", "+"), (2500, "1", "-"), (9000, "1", "-"))]
    (tmp_path / "body.bed").write_text("".join("\t".join(map(str, s)) + "\n" for s in spans))
    (tmp_path / "m.csv").write_text("gene,c1,c2\ng1,transcribed,silent\n")
    config = PipelineConfig.parse(f"contexts: [NCGN-Both]\nregions: {{body: {{bed_file: {tmp_path}/body.bed, strand_column: 6, n_bins: 2}}}}")
    before = kept()
    out = region_pipeline.run(spark, [str(tmp_path / f"{c}.NCGN-Both.allc.tsv") for c in ("c1", "c2")], config, str(tmp_path / "m.csv"), None, "NCGN")
    until = time.time() + 20  # files are removed in the background
    while kept() - before and time.time() < until:
        time.sleep(0.1)
    assert not kept() - before
    text = plan(out.region_rows)
    assert "Generate inline" in text and "hashpartitioning" not in text and "allc.tsv" not in text
    want = sorted((c, f"chr1:{s}-{e}", n * v, n, n) for c, v in (("c1", 2), ("c2", 3)) for _, s, e, *_ in spans for n in [sum(s <= p <= e for p in range(1, 4000, 10))])
    fields = "region_id string, bin long, total_coverage long, total_methylated long, sites_with_data long, region string, context string, strand_side string, sample string"
    for writers in ("256", "1"):
        monkeypatch.setitem(region_pipeline.WRITING, "spark.sql.maxConcurrentOutputFileWriters", writers)
        region_pipeline.write(out, str(tmp_path / writers))
        back = tables.read_results(spark, str(tmp_path / writers / "regions"), fields).select("sample", "region_id", "total_coverage", "total_methylated", "sites_with_data")
        assert sorted(map(tuple, back.collect())) == want and any(w[4] == 150 for w in want)
    files = [p.name for p in (tmp_path / "256/regions").rglob("part-*")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0" and spark.conf.get("spark.sql.files.maxPartitionBytes") != "16m"
