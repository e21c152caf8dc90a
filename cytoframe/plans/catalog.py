"""The registered queries over the reshaped driver tables, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import names, smoothing
from ..operators import fastq, intervals, methylation as me, motif, ranks, read_quality, reads, sites, variants
from ..sources import chain, sequences, tables
from ..sources.folders import DROP_SHUFFLES, removed, settings, shared_folder
from ..streaming import reads as stream
from . import region_pipeline as flagship
from .config import PipelineConfig, Region
from .views import cte, frame

CELLS = tuple(f"cell{i}" for i in range(20))
SAMPLES = ", ".join(f"('{c}')" for c in CELLS)
SHEET = (("s1", "ACGT"), ("s2", "GGAT"), ("s3", "TTTT"), ("s4", "CAGT"), ("s5", "ATCG"))
MIN_COVERAGE = 5000

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


def samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in CELLS], "sample string")


LAST = "s AS (SELECT chrom, pos, arg_max(mc, rec_no) AS mc, arg_max(cov, rec_no) AS cov FROM allc GROUP BY chrom, pos)"


@query(f"{cte('allc')} SELECT CAST(sum(cov) AS BIGINT) AS total_cov, count(*) AS total_count, CAST(sum(mc) AS BIGINT) AS total_methylated FROM allc")
def allc_totals(spark, sf):
    return me.totals(frame(spark, sf, "allc"))


@query(f"{cte('allc')}, {LAST} SELECT chrom, pos, mc, cov FROM s")
def allc_dedupe_last(spark, sf):
    return me.last_call(frame(spark, sf, "allc"))


def _region_sql(low: str, head: str, regions: str = "regions") -> str:
    return f"""{cte('allc', regions)}, {LAST}, h AS (SELECT r.rid, sum(s.cov) AS c, sum(s.mc) AS m, count(s.pos) AS n FROM {regions} r JOIN s ON s.chrom = r.chrom AND s.pos >= {low} AND s.pos <= r.end_pos GROUP BY r.rid)
SELECT {head}, r.chrom, r.start_pos AS start, r.end_pos AS "end", CAST(coalesce(c, 0) AS BIGINT) AS total_coverage, CAST(coalesce(m, 0) AS BIGINT) AS total_methylated,
 CAST(m AS DOUBLE) / nullif(CAST(c AS DOUBLE), 0) * 100 AS methylation_percentage, CAST(coalesce(n, 0) AS BIGINT) AS sites_with_data FROM {regions} r LEFT JOIN h USING (rid)"""


def _named(df: DataFrame, *first: Column | str) -> DataFrame:
    return df.select(*first, "chrom", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "total_coverage", "total_methylated", "methylation_percentage", "sites_with_data")


@query(_region_sql("r.start_pos", "r.rid, r.end_pos - r.start_pos + 1 AS region_length"))
def region_methylation_closed(spark, sf):
    out = me.region_methylation(frame(spark, sf, "allc"), frame(spark, sf, "regions"), "closed")
    return _named(out, "rid", (F.col("end_pos") - F.col("start_pos") + 1).alias("region_length"))


@query(_region_sql("r.start_pos", "r.rid, r.end_pos - r.start_pos + 1 AS region_length", "mixed"))
def region_methylation_mixed(spark, sf):
    """Sites, short and long regions and whole chromosomes in one table."""
    out = me.region_methylation(frame(spark, sf, "allc"), frame(spark, sf, "mixed"), "closed", long=True)
    return _named(out, "rid", (F.col("end_pos") - F.col("start_pos") + 1).alias("region_length"))


@query(ORACLE_SQL["region_methylation_closed"])
def region_methylation_bucketed(spark, sf):
    """The regions over a table of sites that is bucketed by bins, and read without a shuffle."""
    at = _folder(spark, "sites")
    known = tables.write_bucketed(me.last_call(frame(spark, sf, "allc")), at.rsplit("/", 1)[-1].replace("-", "_"), at, 8)
    out = me.bucketed_region_sums(known, frame(spark, sf, "regions").select("rid", "chrom", "start_pos", "end_pos"), "closed")
    out = out.withColumn("methylation_percentage", me.percent(F.col("total_methylated"), F.col("total_coverage")))
    return _named(out, "rid", (F.col("end_pos") - F.col("start_pos") + 1).alias("region_length"))


_RID = "concat_ws('_', r.chrom, CAST(r.start_pos AS VARCHAR), CAST(r.end_pos AS VARCHAR)) AS region_id"


def _region_id() -> Column:
    return F.concat_ws("_", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string")).alias("region_id")


@query(_region_sql("r.start_pos + 1", _RID))
def region_methylation_bed0(spark, sf):
    return _named(me.region_methylation(frame(spark, sf, "allc"), frame(spark, sf, "regions"), "zero_based_half_open"), _region_id())


@query(_region_sql("r.start_pos", _RID))
def region_methylation_bed1(spark, sf):
    return _named(me.region_methylation(frame(spark, sf, "allc"), frame(spark, sf, "regions"), "closed"), _region_id())


def _cell_regions(spark, sf) -> DataFrame:
    """Sums of every region row in every cell, with the region's strand side and bin."""
    r = frame(spark, sf, "regions").withColumn("strand_side", F.when(F.col("strand") == "+", "top").otherwise("bottom"))
    r = r.select("rid", "chrom", "start_pos", "end_pos", "strand_side", "bin")
    near = intervals.in_bins(frame(spark, sf, "allc"), r, "closed", 500)
    return me.region_sums(me.last_call(near, "sample"), r, "closed", names=samples(spark))


_CELL = f"""s AS (SELECT sample, chrom, pos, arg_max(mc, rec_no) AS mc, arg_max(cov, rec_no) AS cov FROM allc GROUP BY sample, chrom, pos),
h AS (SELECT s.sample, r.rid, sum(s.cov) AS c, sum(s.mc) AS m, count(*) AS n FROM regions r JOIN s ON s.chrom = r.chrom AND s.pos >= r.start_pos AND s.pos <= r.end_pos GROUP BY ALL),
names(sample) AS (VALUES {SAMPLES}),
cr AS (SELECT k.sample, r.rid, CASE WHEN r.strand = '+' THEN 'top' ELSE 'bottom' END AS strand_side, r.chrom, r.start_pos, r.end_pos, r.bin, r.gene_name,
 CAST(coalesce(c, 0) AS BIGINT) AS total_coverage, CAST(coalesce(m, 0) AS BIGINT) AS total_methylated, CAST(coalesce(n, 0) AS BIGINT) AS sites_with_data
 FROM regions r CROSS JOIN names k LEFT JOIN h ON h.rid = r.rid AND h.sample = k.sample)"""


@query(f"{cte('allc', 'regions')}, {_CELL} SELECT sample, strand_side, concat(chrom, ':', CAST(start_pos AS VARCHAR), '-', CAST(end_pos AS VARCHAR)) AS region_id, bin, total_coverage, total_methylated, sites_with_data FROM cr")
def binned_region_by_strand(spark, sf):
    region_id = F.concat("chrom", F.lit(":"), F.col("start_pos").cast("string"), F.lit("-"), F.col("end_pos").cast("string"))
    return _cell_regions(spark, sf).select("sample", "strand_side", region_id.alias("region_id"), "bin", "total_coverage", "total_methylated", "sites_with_data")


FIRST, LAST_OFFSET = -1000, 1000


def _tss_sql(source: str, keys: str = "", key_rows: str = "") -> str:
    k = f"{keys}, " if keys else ""
    on = f"USING ({k}o)"
    return f"""{cte('allc', 'regions')}, {LAST}, t AS (SELECT *, CASE WHEN strand = '+' THEN 'top' ELSE 'bottom' END AS strand_side FROM regions),
h AS (SELECT {k}x.pos - t.start_pos AS o, sum(x.cov) AS c, sum(x.mc) AS m, count(*) AS n FROM t JOIN {source} x ON x.chrom = t.chrom AND x.pos >= t.start_pos + {FIRST} AND x.pos <= t.start_pos + {LAST_OFFSET} GROUP BY ALL),
spine AS (SELECT {k}CAST(unnest(range({FIRST}, {LAST_OFFSET} + 1)) AS BIGINT) AS o {key_rows})
SELECT {k}o AS position_relative_to_tss, CAST(coalesce(c, 0) AS BIGINT) AS total_coverage, CAST(coalesce(m, 0) AS BIGINT) AS total_methylated,
 CAST(m AS DOUBLE) / nullif(CAST(c AS DOUBLE), 0) * 100 AS methylation_percentage, coalesce(n, 0) AS sites_with_data FROM spine LEFT JOIN h {on}"""


@query(_tss_sql("s"))
def tss_profile_last(spark, sf):
    return me.anchor_profile(frame(spark, sf, "allc"), frame(spark, sf, "regions"), FIRST, LAST_OFFSET, "last")


@query(_tss_sql("allc"))
def tss_profile_all(spark, sf):
    return me.anchor_profile(frame(spark, sf, "allc"), frame(spark, sf, "regions"), FIRST, LAST_OFFSET, "all")


@query(_tss_sql("allc", "strand_side", "FROM (VALUES ('top'), ('bottom')) v(strand_side)"))
def tss_profile_by_strand(spark, sf):
    tss = frame(spark, sf, "regions").withColumn("strand_side", F.when(F.col("strand") == "+", "top").otherwise("bottom"))
    sides = spark.createDataFrame([("top",), ("bottom",)], "strand_side string")
    return me.anchor_profile(frame(spark, sf, "allc"), tss, FIRST, LAST_OFFSET, "all", ("strand_side",), sides)


_OVERALL = f"""{cte('allc', 'regions')}, names(sample) AS (VALUES {SAMPLES}),
h AS (SELECT a.sample, sum(a.mc) AS m, sum(a.cov) AS c, count(*) AS n FROM allc a JOIN regions r ON a.chrom = r.chrom AND a.pos >= r.start_pos + 1 AND a.pos <= r.end_pos WHERE a.cov > 0 GROUP BY a.sample),
o AS (SELECT sample, CAST(coalesce(m, 0) AS BIGINT) AS total_mc, CAST(coalesce(c, 0) AS BIGINT) AS total_cov, CAST(m AS DOUBLE) / nullif(CAST(c AS DOUBLE), 0) AS methylation_fraction, coalesce(n, 0) AS sites_with_data FROM names LEFT JOIN h USING (sample))"""


@query(f"{_OVERALL} SELECT * FROM o")
def overall_methylation(spark, sf):
    return me.overall(frame(spark, sf, "allc"), frame(spark, sf, "regions"), samples(spark))


@query(f"{_OVERALL} SELECT count(*) FILTER (WHERE sites_with_data > 0) AS files, CAST(sum(total_mc) AS BIGINT) AS total_mc, CAST(sum(total_cov) AS BIGINT) AS total_cov, CAST(sum(total_mc) AS DOUBLE) / nullif(CAST(sum(total_cov) AS DOUBLE), 0) AS fraction FROM o")
def overall_methylation_total(spark, sf):
    o = overall_methylation(spark, sf).agg(F.count_if(F.col("sites_with_data") > 0).alias("files"), F.sum("total_mc").alias("total_mc"), F.sum("total_cov").alias("total_cov"))
    return o.withColumn("fraction", F.try_divide("total_mc", "total_cov"))


_MERGED = """hit AS (SELECT a.chrom, coalesce(x.start_pos, y.start_pos) AS p, a.mc, a.cov FROM allc a LEFT JOIN cpg_bed x ON x.chrom = a.chrom AND x.start_pos = a.pos LEFT JOIN cpg_bed y ON y.chrom = a.chrom AND y.start_pos + 1 = a.pos),
merged AS (SELECT chrom, p - 1 AS start, p + 1 AS "end", CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov FROM hit WHERE p IS NOT NULL GROUP BY chrom, p)"""


@query(f"{cte('allc', 'cpg_bed')}, {_MERGED} SELECT * FROM merged")
def cpg_merge(spark, sf):
    return me.merge_cpgs(frame(spark, sf, "allc"), frame(spark, sf, "cpg_bed"))


@query(f"""{cte('allc')} SELECT chrom, pos - 1 AS start, pos AS "end", strand, concat(context, '_', CAST(mc AS VARCHAR), '_', CAST(cov AS VARCHAR)) AS name FROM allc""")
def allc_to_bed(spark, sf):
    return sites.to_bed(frame(spark, sf, "allc"))


def _unpack_sql(test: str) -> str:
    return f"""{cte('packed')}, p AS (SELECT *, string_split(name, '_') AS q FROM packed) SELECT chrom, start_pos + 1 AS pos, strand, q[1] AS context, CAST(q[2] AS BIGINT) AS mc, CAST(q[3] AS BIGINT) AS cov, 1 AS flag FROM p WHERE len(q) {test}"""


@query(_unpack_sql(">= 3"))
def bed_to_allc_lenient(spark, sf):
    return sites.from_bed(frame(spark, sf, "packed"), strict=False)


@query(_unpack_sql("= 3"))
def bed_to_allc_strict(spark, sf):
    return sites.from_bed(frame(spark, sf, "packed"), strict=True)


@query(f"{cte('beta')} SELECT chrom, end_pos - 1 AS pos, '+' AS strand, 'CG' AS context, mc, cov, 1 AS flag FROM beta WHERE mc IS NOT NULL")
def beta_to_allc(spark, sf):
    return sites.from_beta(frame(spark, sf, "beta"))


@query(f"""{cte('allc', 'cpg_bed')}, k AS (SELECT * FROM allc a WHERE EXISTS (SELECT 1 FROM cpg_bed c WHERE c.chrom = a.chrom AND a.pos - 1 < c.end_pos AND a.pos > c.start_pos)),
n AS (SELECT *, count(*) OVER (PARTITION BY chrom, pos) AS n FROM k) SELECT chrom, pos, strand, context, mc, cov, flag FROM n WHERE n = 1""")
def overlap_semi_filter(spark, sf):
    return sites.sites_in_cpgs(frame(spark, sf, "allc"), frame(spark, sf, "cpg_bed")).select("chrom", "pos", "strand", "context", "mc", "cov", "flag")


_BED5 = """b AS (SELECT chrom, start + 1 AS start, "end" + 1 AS "end", mc, cov FROM merged UNION ALL SELECT chrom, start, "end", mc, cov FROM merged), d AS (SELECT * FROM cpg_bed UNION ALL SELECT * FROM cpg_bed WHERE start_pos % 2 = 0)"""


def _bed5(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Merged CpGs in both coordinate systems (half of them are no CpG of the list), and the list with repeats."""
    m, c = cpg_merge(spark, sf), frame(spark, sf, "cpg_bed")
    shifted = m.select("chrom", (F.col("start") + 1).alias("start"), (F.col("end") + 1).alias("end"), "mc", "cov")
    return shifted.unionByName(m), c.unionByName(c.where("start_pos % 2 = 0"))


@query(f"""{cte('allc', 'cpg_bed')}, {_MERGED}, {_BED5} SELECT * FROM b WHERE EXISTS (SELECT 1 FROM d WHERE d.chrom = b.chrom AND d.start_pos = b.start AND d.end_pos = b."end")""")
def exact_semi_filter(spark, sf):
    return sites.exact_semi(*_bed5(spark, sf))


@query(f"""{cte('allc', 'cpg_bed')}, {_MERGED}, {_BED5} SELECT b.* FROM b JOIN d ON d.chrom = b.chrom AND d.start_pos = b.start AND d.end_pos = b."end" """)
def exact_inner_filter(spark, sf):
    return sites.exact_inner(*_bed5(spark, sf))


@query(f"""{cte('allc', 'cpg_bed')}, {_MERGED}, {_BED5}, r AS (SELECT chrom, start, "end", CASE WHEN mc % 5 = 0 THEN NULL ELSE mc END AS mc, cov FROM b), k AS (SELECT * FROM r WHERE mc IS NOT NULL),
n AS (SELECT (SELECT count(*) FROM r) AS input, (SELECT count(*) FROM k) AS before, (SELECT count(*) FROM k JOIN d ON d.chrom = k.chrom AND d.start_pos = k.start AND d.end_pos = k."end") AS after)
SELECT input, input - before AS nan_removed, before, after, before - after AS filtered_out, CAST(after AS DOUBLE) / before * 100 AS retention_pct FROM n""")
def filter_metrics(spark, sf):
    rows, listed = _bed5(spark, sf)
    n = sites.write_filtered(rows.withColumn("mc", F.when(F.col("mc") % 5 != 0, F.col("mc"))), listed, _folder(spark, "filtered"))
    return spark.createDataFrame([tuple(n.values())], "input long, nan_removed long, before long, after long, filtered_out long, retention_pct double")


@query(f"{cte('allc', 'cells')} SELECT grp, chrom, pos, strand, context, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov FROM allc JOIN cells ON barcode = sample GROUP BY ALL")
def merge_allc_by_group(spark, sf):
    return me.merge_by_group(frame(spark, sf, "allc"), frame(spark, sf, "cells"))


@query(f"""{cte('allc')} SELECT chrom, (pos - 1) // 100 * 100 AS bin_start, CAST(sum(mc) AS BIGINT) AS mc, CAST(sum(cov) AS BIGINT) AS cov, CAST(sum(mc) AS DOUBLE) / nullif(CAST(sum(cov) AS DOUBLE), 0) AS fraction
FROM allc WHERE regexp_full_match(context, '[ACGTN]CG[ACGTN]') GROUP BY chrom, bin_start""")
def bin100_methylation(spark, sf):
    return me.binned(frame(spark, sf, "allc"))


def _cells(spark, sf, keys: tuple[str, ...] = ()) -> DataFrame:
    seg = F.element_at(F.array(F.lit("up"), F.lit("body"), F.lit("down")), (F.col("rid") % 3 + 1).cast("int"))
    r = frame(spark, sf, "regions").withColumn("strand_side", F.when(F.col("strand") == "+", "top").otherwise("bottom"))
    if keys:
        r = r.withColumn("segment", seg)
    near = intervals.in_bins(frame(spark, sf, "allc"), r, "closed", 500)
    rows = me.cell_region_bins(me.last_call(near, "sample"), r, CELLS, "closed", keys)
    expressed = transcription_unpivot(spark, sf)
    return me.cell_bins(rows, r, expressed, keys)


_BINS = f"""{cte('allc', 'regions', 'cells', 'transcription')}, {_CELL},
rows AS (SELECT *, ['up', 'body', 'down'][rid % 3 + 1] AS segment FROM cr),
genes AS (SELECT *, CASE WHEN strand = '+' THEN 'top' ELSE 'bottom' END AS strand_side, ['up', 'body', 'down'][rid % 3 + 1] AS segment FROM regions)"""


def _bins(keys: str) -> str:
    k = "".join(f"r.{x}, " for x in keys.split())
    on = "".join(f" AND g.{x} = r.{x}" for x in keys.split())
    # the join multiplies result rows by gene rows; both sides are counted first to keep it small
    return f"""{_BINS}, r AS (SELECT sample, strand_side, {keys + ',' if keys else ''} bin, sum(total_coverage) AS c, sum(total_methylated) AS m FROM rows GROUP BY ALL),
g AS (SELECT t.barcode, strand_side, {keys + ',' if keys else ''} bin, count(*) AS g FROM genes JOIN transcription t ON t.gene_name = genes.gene_name AND t.status = 'transcribed' GROUP BY ALL),
cb AS (SELECT r.sample, {k} r.bin, CAST(sum(r.c * g.g) AS BIGINT) AS total_coverage, CAST(sum(r.m * g.g) AS BIGINT) AS total_methylated FROM r JOIN g ON g.barcode = r.sample AND g.strand_side = r.strand_side AND g.bin = r.bin{on} GROUP BY ALL)"""


def _profile(keys: str, group: str, source: str) -> str:
    k = f"{keys}, " if keys else ""
    return f"""p AS (SELECT {group} AS "group", {k}bin, CAST(sum(total_coverage) AS BIGINT) AS total_coverage, CAST(sum(total_methylated) AS BIGINT) AS total_methylated,
 CASE WHEN sum(total_coverage) >= {MIN_COVERAGE} THEN CAST(sum(total_methylated) AS DOUBLE) / nullif(CAST(sum(total_coverage) AS DOUBLE), 0) * 100 END AS methylation_percentage FROM {source} GROUP BY ALL)"""


@query(f"{_bins('')} SELECT * FROM cb")
def cell_bin_sums(spark, sf):
    return _cells(spark, sf)


@query(f"{_bins('')}, {_profile('', 'grp', 'cb JOIN cells ON barcode = sample')} SELECT * FROM p")
def group_bin_profile(spark, sf):
    return me.group_profile(_cells(spark, sf), frame(spark, sf, "cells"), MIN_COVERAGE)


@query(f"{_bins('')}, {_profile('', 'sample', 'cb')} SELECT * FROM p")
def cell_bin_profile(spark, sf):
    return me.group_profile(_cells(spark, sf), None, MIN_COVERAGE)


SEGMENTS = [("up", 20), ("body", 20), ("down", 20)]


@query(f"""{_bins('segment')}, {_profile('segment', 'grp', 'cb JOIN cells ON barcode = sample')}
SELECT "group", segment, bin + CASE segment WHEN 'up' THEN 0 WHEN 'body' THEN 20 ELSE 40 END AS bin, total_coverage, total_methylated, methylation_percentage FROM p""")
def combined_regions_profile(spark, sf):
    profile = me.group_profile(_cells(spark, sf, ("segment",)), frame(spark, sf, "cells"), MIN_COVERAGE, ("segment",))
    return me.combine_segments(profile, SEGMENTS)


@query(f"{cte('transcription')} SELECT gene_name, barcode FROM transcription WHERE status = 'transcribed'")
def transcription_unpivot(spark, sf):
    wide = frame(spark, sf, "transcription").groupBy("gene_name").pivot("barcode", list(CELLS)).agg(F.first("status"))
    return sites.unpivot_matrix(wide, "gene_name", "transcribed")


_MOTIF = f"""{cte('fasta')}, f AS (SELECT chrom, upper(seq) AS seq FROM fasta),
cg AS (SELECT chrom, unnest(list_filter(range(0, length(seq)), lambda i: substr(seq, CAST(i + 1 AS BIGINT), 2) = 'CG')) AS p FROM f),
gap AS (SELECT chrom, p, lag(p) OVER w AS a, lead(p) OVER w AS b FROM cg WINDOW w AS (PARTITION BY chrom ORDER BY p)),
pieces AS (SELECT chrom, string_split_regex(seq, '[AT]CG[AT]') AS q FROM f),
piece AS (SELECT chrom, unnest(q) AS s, generate_subscripts(q, 1) AS k, len(q) AS n FROM pieces),
hits AS (SELECT chrom, CAST(sum(length(s)) OVER (PARTITION BY chrom ORDER BY k) AS BIGINT) + (k - 1) * 4 + 1 AS start, k, n FROM piece),
w AS (SELECT h.chrom, h.start, (a IS NULL OR h.start - a > 35) AND (b IS NULL OR b - h.start > 35) AS solo FROM hits h JOIN gap g ON g.chrom = h.chrom AND g.p = h.start WHERE k < n)"""


def _chunks(spark, sf) -> DataFrame:
    return sequences.chunked(frame(spark, sf, "fasta"), 16_384)


@query(f"""{_MOTIF} SELECT chrom, start, start + 2 AS "end" FROM w""")
def motif_positions(spark, sf):
    return motif.cpgs(_chunks(spark, sf)).drop("solo")


@query(f"""{_MOTIF} SELECT chrom, start, start + 2 AS "end" FROM w WHERE solo""")
def motif_solo(spark, sf):
    return motif.cpgs(_chunks(spark, sf)).where("solo").drop("solo")


@query(f"{_MOTIF} SELECT coalesce(chrom, 'total') AS chrom, count(*) AS wcgw, count(*) FILTER (WHERE solo) AS solo, CAST(count(*) FILTER (WHERE solo) AS DOUBLE) / count(*) * 100 AS pct FROM w GROUP BY ROLLUP (chrom)")
def motif_stats(spark, sf):
    return motif.statistics(_chunks(spark, sf))


@query(f"""{cte('reads')}, m AS (SELECT *, (row_number() OVER (PARTITION BY qname ORDER BY rec_no) - 1) % 2 + 1 AS read FROM reads WHERE flag & 4 = 0)
SELECT flag & 64 <> 0 AS is_read1, flag, coalesce(xr, 'NA') AS xr, coalesce(xg, 'NA') AS xg, CAST(read AS INTEGER) AS read, count(*) AS "count" FROM m GROUP BY ALL""")
def flag_combinations(spark, sf):
    return reads.flag_combinations(frame(spark, sf, "reads"))


def _pairs_sql(where: str = "flag & 1 <> 0 AND flag & 4 = 0 AND flag & 8 = 0") -> str:
    return f"""{cte('reads')}, m AS (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY rec_no) - 1 AS n FROM reads WHERE {where}),
fs AS (SELECT a.qname, a.n // 2 AS pair_no, a.flag AS f1, a.ref_id AS c1, a.start_pos AS s1, a.end_pos AS e1, b.flag AS f2, b.ref_id AS c2, b.start_pos AS s2, b.end_pos AS e2 FROM m a JOIN m b ON b.qname = a.qname AND b.n = a.n + 1 WHERE a.n % 2 = 0),
p AS (SELECT qname, pair_no, CASE WHEN f2 & 64 <> 0 THEN f2 ELSE f1 END AS f1, CASE WHEN f2 & 64 <> 0 THEN c2 ELSE c1 END AS c1, CASE WHEN f2 & 64 <> 0 THEN s2 ELSE s1 END AS s1, CASE WHEN f2 & 64 <> 0 THEN e2 ELSE e1 END AS e1,
 CASE WHEN f2 & 64 <> 0 THEN f1 ELSE f2 END AS f2, CASE WHEN f2 & 64 <> 0 THEN c1 ELSE c2 END AS c2, CASE WHEN f2 & 64 <> 0 THEN s1 ELSE s2 END AS s2, CASE WHEN f2 & 64 <> 0 THEN e1 ELSE e2 END AS e2 FROM fs)"""


@query(f"{_pairs_sql()} SELECT qname, pair_no, f1 AS flag1, s1 AS start1, e1 AS end1, f2 AS flag2, s2 AS start2, e2 AS end2 FROM p")
def read_pairs(spark, sf):
    p = reads.ordered_pairs(frame(spark, sf, "reads"))
    return p.select("qname", "pair_no", *[F.col(f"r{k}.{c}").alias(f"{a}{k}") for k in (1, 2) for c, a in (("flag", "flag"), ("start_pos", "start"), ("end_pos", "end"))])


@query(ORACLE_SQL["read_pairs"])
def read_pairs_streamed(spark, sf):
    """The same pairs from a stream of files in any order, paired by event time."""
    at, big = _folder(spark, "reads"), 1 << 40
    r = ranks.placed(reads.properly_mapped(frame(spark, sf, "reads")), [], ["ord"], "rec_no")
    end = spark.range(1).select(F.lit("end").alias("qname"), F.lit(big).alias("rec_no"), F.timestamp_seconds(F.lit(1 << 32)).alias("time"), F.lit(99).alias("flag"), F.lit(0).alias("ref_id"), F.lit(0).cast("long").alias("start_pos"), F.lit(0).cast("long").alias("end_pos"))
    timed = r.select("qname", "rec_no", F.timestamp_seconds(F.col("ord.l_orderkey") + 1).alias("time"), "flag", "ref_id", "start_pos", "end_pos")
    timed.repartition(max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))).write.parquet(f"{at}/in")
    end.write.mode("append").parquet(f"{at}/in")  # moves the watermark past all reads
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stream.ROCKSDB)
    try:
        source = spark.readStream.schema(timed.schema).parquet(f"{at}/in")
        pairs = stream.match_pairs(source, "400 days", "1 hour")
        pairs.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = spark.read.schema(pairs.schema).parquet(f"{at}/out")
    n = F.row_number().over(Window.partitionBy("qname").orderBy("rec1")) - 1
    both = [F.struct(*[F.col(f"{c}{k}").alias(c) for c in ("flag", "ref_id", "start_pos", "end_pos")]).alias(name) for k, name in ((1, "first"), (2, "second"))]
    p = reads.by_read(got.select("qname", n.cast("long").alias("pair_no"), *both))
    return p.select("qname", "pair_no", *[F.col(f"r{k}.{c}").alias(f"{a}{k}") for k in (1, 2) for c, a in (("flag", "flag"), ("start_pos", "start"), ("end_pos", "end"))])


_DOVE = "c1 = c2 AND CASE WHEN f1 & 16 = 0 AND f2 & 16 <> 0 THEN e2 < e1 OR s2 < s1 WHEN f1 & 16 <> 0 AND f2 & 16 = 0 THEN e1 < e2 OR s1 < s2 ELSE FALSE END"


@query(f"{_pairs_sql()} SELECT qname, pair_no, s1 AS start1, e1 AS end1, s2 AS start2, e2 AS end2 FROM p WHERE {_DOVE}")
def dovetail_pairs(spark, sf):
    p = reads.ordered_pairs(frame(spark, sf, "reads")).where(reads.dovetail())
    return p.select("qname", "pair_no", *[F.col(f"r{k}.{c}_pos").alias(f"{c}{k}") for k in (1, 2) for c in ("start", "end")])


@query(f"""{_pairs_sql()}, o AS (SELECT *, greatest(s1, s2) AS a, least(e1, e2) AS b FROM p WHERE {_DOVE})
SELECT qname, pair_no, e1 - s1 - greatest(least(e1, b) - greatest(s1, a), 0) AS masked1, e2 - s2 - greatest(least(e2, b) - greatest(s2, a), 0) AS masked2 FROM o""")
def dovetail_masked_len(spark, sf):
    p = reads.ordered_pairs(frame(spark, sf, "reads")).where(reads.dovetail())
    p = p.withColumn("a", F.greatest("r1.start_pos", "r2.start_pos")).withColumn("b", F.least("r1.end_pos", "r2.end_pos"))

    def masked(r: str) -> Column:
        at = F.sequence(F.col(f"{r}.start_pos"), F.col(f"{r}.end_pos") - 1)
        return F.size(F.filter(reads.mask_outside(F.transform(at, lambda x: F.lit(30)), at, F.col("a"), F.col("b")), lambda q: q == 0)).cast("long")

    return p.select("qname", "pair_no", masked("r1").alias("masked1"), masked("r2").alias("masked2"))


_FRAG = f"""{_pairs_sql()}, q AS (SELECT c1 AS chrom, CASE WHEN f1 & 16 = 0 THEN s1 ELSE s2 END AS start, CASE WHEN f1 & 16 = 0 THEN e2 ELSE e1 END AS "end", CASE WHEN f1 & 16 = 0 THEN '+' ELSE '-' END AS strand
 FROM p WHERE c1 = c2 AND (f1 & 16 = 0) <> (f2 & 16 = 0)), fr AS (SELECT *, "end" - start AS size FROM q WHERE start < "end")"""


@query(f"{_FRAG} SELECT * FROM fr")
def fragments(spark, sf):
    return reads.fragments(frame(spark, sf, "reads"))


@query(f"""{_FRAG} SELECT CAST(r.size AS BIGINT) AS size, count(fr.size) AS "count" FROM (SELECT unnest(range(1, 501)) AS size) r LEFT JOIN fr USING (size) GROUP BY r.size""")
def fragment_histogram(spark, sf):
    return reads.size_histogram(reads.fragments(frame(spark, sf, "reads")))


@query(f"""{_pairs_sql()}, z AS (SELECT greatest(e1, e2) - least(s1, s2) AS n FROM p WHERE c1 = c2), k AS (SELECT CASE WHEN n <= 50 THEN 'small' WHEN n <= 100 THEN 'medium' WHEN n <= 150 THEN 'long' ELSE 'xlarge' END AS size_class, count(*) AS pairs FROM z GROUP BY ALL)
SELECT size_class, pairs, CAST(pairs AS DOUBLE) / CAST(sum(pairs) OVER () AS DOUBLE) * 100 AS pct FROM k""")
def fragment_size_classes(spark, sf):
    return reads.size_classes(frame(spark, sf, "reads"))


@query(f"""{_pairs_sql('flag & 4 = 0')}, k AS (SELECT CASE f1 WHEN 99 THEN 'OT' WHEN 83 THEN 'OB' WHEN 147 THEN 'CTOT' WHEN 163 THEN 'CTOB' END AS strand_group FROM fs) SELECT strand_group, count(*) AS pairs FROM k WHERE strand_group IS NOT NULL GROUP BY ALL""")
def directional_split_counts(spark, sf):
    return reads.directional(frame(spark, sf, "reads")).groupBy("strand_group").agg(F.count("*").alias("pairs"))


@query(f"""{cte('reads')}, k AS (SELECT qname, flag, start_pos, end_pos - start_pos AS n, flag & 64 <> 0 AS a, flag & 128 <> 0 AS b FROM reads)
SELECT qname, flag, start_pos, CAST(CASE WHEN flag & 4 <> 0 THEN 0 WHEN a THEN least(n, 8) WHEN b THEN least(n, 13) ELSE 0 END AS BIGINT) AS masked_count FROM k""")
def quality_mask_head_tail(spark, sf):
    r = frame(spark, sf, "reads").withColumn("quals", F.array_repeat(F.lit(30), (F.col("end_pos") - F.col("start_pos")).cast("int")))
    r = r.withColumn("masked", reads.mask_ends(F.col("quals"), F.col("flag"), (5, 10), (3, 3)))
    return r.select("qname", "flag", "start_pos", (F.size("masked") - F.size(F.array_remove("masked", 0))).cast("long").alias("masked_count"))


@query(f"{cte('fastq')} SELECT split_part(header, ':', -1) AS barcode, count(*) AS reads FROM fastq GROUP BY ALL")
def fastq_barcode_counts(spark, sf):
    return fastq.barcode_counts(frame(spark, sf, "fastq"))


_ID = "regexp_replace(regexp_split_to_array(substr(header, 2), '\\s+')[1], '/[12]$', '')"


# the mates' file: records in another order, some of them missing, some there twice
_MATES = """mates AS (SELECT (rec_no * 7919) % 1000003 AS rec_no, replace(header, ' 1:', ' 2:') AS header FROM fastq WHERE rec_no % 11 <> 3 UNION ALL SELECT 2000000 + rec_no, header FROM fastq WHERE rec_no % 13 = 5)"""


def _mates(spark, sf) -> DataFrame:
    f = frame(spark, sf, "fastq")
    first = f.where("rec_no % 11 <> 3").select(((F.col("rec_no") * 7919) % 1000003).alias("rec_no"), F.replace("header", F.lit(" 1:"), F.lit(" 2:")).alias("header"))
    return first.unionByName(f.where("rec_no % 13 = 5").select((F.col("rec_no") + 2000000).alias("rec_no"), "header"))


@query(f"{cte('fastq')}, {_MATES}, k AS (SELECT {_ID} AS read_id, max(rec_no) AS rank FROM mates GROUP BY 1), f AS (SELECT {_ID} AS read_id, seq FROM fastq) SELECT rank, read_id, seq FROM f LEFT JOIN k USING (read_id)")
def fastq_sync_rank(spark, sf):
    return fastq.reorder(frame(spark, sf, "fastq"), _mates(spark, sf)).select("rank", "read_id", "seq")


@query(f"""{cte('fastq')}, {_MATES}, k AS (SELECT id, count(*) FILTER (WHERE side = 0) AS x, count(*) FILTER (WHERE side = 1) AS y FROM (SELECT {_ID} AS id, 0 AS side FROM fastq UNION ALL SELECT {_ID}, 1 FROM mates) z GROUP BY id)
SELECT count(*) FILTER (WHERE y = 0) AS only_first, count(*) FILTER (WHERE x = 0) AS only_second, count(*) FILTER (WHERE x > 1 OR y > 1) AS repeated FROM k""")
def fastq_same_reads(spark, sf):
    return fastq.same_reads(frame(spark, sf, "fastq"), _mates(spark, sf))


_R2 = "r2 AS (SELECT rec_no, CASE WHEN rec_no % 17 = 0 THEN replace(header, 'INST', 'OTHER') ELSE header END AS header FROM fastq WHERE rec_no % 101 <> 5)"


def _mate(spark, sf) -> DataFrame:
    f = frame(spark, sf, "fastq").where("rec_no % 101 <> 5")
    return f.withColumn("header", F.when(F.col("rec_no") % 17 == 0, F.replace("header", F.lit("INST"), F.lit("OTHER"))).otherwise(F.col("header")))


_MIS = f"{cte('fastq')}, {_R2}, z AS (SELECT 4 * a.rec_no + 1 AS line_num, split_part(a.header, ' ', 1) AS r1_name, split_part(b.header, ' ', 1) AS r2_name FROM fastq a JOIN r2 b USING (rec_no)) SELECT * FROM z WHERE r1_name <> r2_name"


@query(_MIS)
def fastq_mismatches(spark, sf):
    return fastq.mismatches(frame(spark, sf, "fastq"), _mate(spark, sf))


@query(f"{_MIS} ORDER BY line_num LIMIT 10")
def fastq_mismatches_top10(spark, sf):
    return fastq_mismatches(spark, sf).orderBy("line_num").limit(10)


@query(f"{cte('fastq')} SELECT rec_no, header, seq, qual FROM fastq ORDER BY split_part(header, ' ', 1), header")
def fastq_sort_by_header(spark, sf):
    return fastq.sort_by_header(frame(spark, sf, "fastq")).select("rec_no", "header", "seq", "qual")


_TYPES = (("I1", "rec_no % 7 <> 0"), ("I2", "rec_no % 5 <> 0"), ("R1", "rec_no % 3 <> 0"), ("R2", "rec_no >= 0"))


@query(f"""{cte('fastq')}, t AS ({' UNION ALL '.join(f"SELECT '{t}' AS file_type, rec_no, split_part(header, ' ', 1) AS read_name FROM fastq WHERE {w}" for t, w in _TYPES)}),
n AS (SELECT read_name, count(DISTINCT file_type) = 4 AS matched, min(rec_no) FILTER (WHERE file_type = 'I1') AS f FROM t GROUP BY ALL)
SELECT DISTINCT file_type, matched, CASE WHEN matched THEN f END AS ord, read_name FROM t JOIN n USING (read_name)""")
def fastq_four_way_match(spark, sf):
    f = frame(spark, sf, "fastq").select("rec_no", "header")
    parts = [f.where(w).select(F.lit(t).alias("file_type"), "rec_no", "header") for t, w in _TYPES]
    records = parts[0]
    for p in parts[1:]:
        records = records.unionByName(p)
    return fastq.four_way(records)


def _lines(spark, sf) -> DataFrame:
    """Records dealt to six files as lines; some headers and separators are broken, the last file loses a line."""
    f = frame(spark, sf, "fastq").withColumn("file", F.concat(F.lit("f"), (F.col("rec_no") % 6).cast("string")))
    bad = (F.col("rec_no") % 6 == 1) & (F.col("rec_no") % 50 == 7)
    header = F.when(bad, F.substr("header", F.lit(2))).otherwise(F.col("header"))
    plus = F.when((F.col("rec_no") % 6 == 2) & (F.col("rec_no") % 40 == 8), "x").otherwise(F.col("plus"))
    n = F.floor(F.col("rec_no") / 6)
    four = F.posexplode(F.array(header, "seq", plus, "qual")).alias("k", "value")
    out = f.select("file", n.alias("n"), four).select("file", (F.col("n") * 4 + F.col("k")).alias("line_no"), "value")
    return out.where("NOT (file = 'f5' AND line_no = 3)")


_CHECK = f"""{cte('fastq')}, k(k) AS (VALUES (0), (1), (2), (3)),
l AS (SELECT concat('f', CAST(rec_no % 6 AS VARCHAR)) AS file, rec_no // 6 * 4 + k AS line_no,
 CASE k WHEN 0 THEN CASE WHEN rec_no % 6 = 1 AND rec_no % 50 = 7 THEN substr(header, 2) ELSE header END WHEN 1 THEN seq WHEN 2 THEN CASE WHEN rec_no % 6 = 2 AND rec_no % 40 = 8 THEN 'x' ELSE plus END ELSE qual END AS value
 FROM fastq, k),
b AS (SELECT file, line_no, CASE WHEN line_no % 4 = 0 AND NOT starts_with(value, '@') THEN 'bad header' WHEN line_no % 4 = 2 AND NOT starts_with(value, '+') THEN 'bad separator' END AS bad FROM l WHERE NOT (file = 'f5' AND line_no = 3)),
c AS (SELECT file, coalesce(arg_min(bad, line_no) FILTER (WHERE bad IS NOT NULL), CASE WHEN count(*) % 4 <> 0 THEN 'truncated' ELSE 'ok' END) AS status, count(*) AS n FROM b GROUP BY file),
checked AS (SELECT file, status, CASE WHEN status = 'ok' THEN n // 4 ELSE 0 END AS reads FROM c)"""


@query(f"{_CHECK} SELECT * FROM checked")
def fastq_check(spark, sf):
    return fastq.check(_lines(spark, sf))


@query(f"{_CHECK} SELECT count(*) FILTER (WHERE status = 'ok') AS passed, count(*) FILTER (WHERE status <> 'ok') AS failed, CAST(sum(reads) AS BIGINT) AS total_reads, CAST(sum(reads) AS BIGINT) // count(*) FILTER (WHERE status = 'ok') AS average_reads FROM checked")
def fastq_check_summary(spark, sf):
    return fastq.check_summary(fastq.check(_lines(spark, sf)))


_FILES = f"""{cte('files')}, c AS (SELECT dir, name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, '_S\\d+', '', 'g'), '_L\\d+', '', 'g'), '_R[12].*', '', 'g'), '_I[12].*', '', 'g') AS sample,
 CASE WHEN contains(name, '_R1') THEN 'R1' WHEN contains(name, '_R2') THEN 'R2' WHEN contains(name, '_I1') THEN 'I1' WHEN contains(name, '_I2') THEN 'I2' END AS read_type FROM files)"""


@query(f"{_FILES} SELECT * FROM c")
def file_catalog_samples(spark, sf):
    return fastq.catalogue(frame(spark, sf, "files"))


_LISTED = _FILES.replace(cte("files"), cte("listing")).replace("FROM files)", "FROM listing)")


@query(f"""{_LISTED}, n AS (SELECT sample, count(*) FILTER (WHERE read_type = 'R1') AS r1, count(*) FILTER (WHERE read_type = 'R2') AS r2, count(*) FILTER (WHERE read_type = 'I1') AS i1, count(*) FILTER (WHERE read_type = 'I2') AS i2 FROM c GROUP BY sample)
SELECT *, r1 <> r2 OR i1 <> i2 AS uneven FROM n""")
def file_pairing(spark, sf):
    return fastq.pairing(frame(spark, sf, "listing"))


@query(f"{_FILES} SELECT sample, read_type, CAST(row_number() OVER (PARTITION BY sample, read_type ORDER BY dir, name) AS INTEGER) AS part, dir, name FROM c")
def file_concatenation(spark, sf):
    return fastq.concatenation(frame(spark, sf, "files"))


@query(f"{cte('files')}, p AS (SELECT DISTINCT split_part(name, '-', 1) AS prefix FROM files) SELECT prefix, concat('S', lpad(CAST(row_number() OVER (ORDER BY prefix) AS VARCHAR), 2, '0')) AS sample_number FROM p")
def sample_numbers(spark, sf):
    return fastq.sample_numbers(frame(spark, sf, "files"))


@query(f"{cte('files')} SELECT dir, name, (row_number() OVER (ORDER BY dir, name) - 1) // 10 AS batch FROM files")
def file_batches(spark, sf):
    return fastq.batches(frame(spark, sf, "files"))


@query(f"""{cte('listing')}, l AS (SELECT dir, count(DISTINCT nullif(regexp_extract(name, '_L(\\d+)_', 1), '')) AS lanes FROM listing GROUP BY dir),
r AS (SELECT dir, name AS old, regexp_replace(name, '_S\\d+_L\\d+_', '_', 'g') AS new, lanes FROM listing JOIN l USING (dir)),
k AS (SELECT *, row_number() OVER (PARTITION BY dir, new ORDER BY old) AS k FROM r WHERE old <> new)
SELECT dir, old, new, CASE WHEN lanes > 1 THEN 'abort' WHEN k > 1 OR EXISTS (SELECT 1 FROM listing f WHERE f.dir = k.dir AND f.name = k.new) THEN 'skip' ELSE 'rename' END AS action FROM k""")
def rename_plan(spark, sf):
    return fastq.rename_plan(frame(spark, sf, "listing"))


_SHEET = ", ".join(f"('{s}', '{i}')" for s, i in SHEET)


@query(f"""{cte('fastq')}, sheet(sample, idx) AS (VALUES {_SHEET}), b AS (SELECT rec_no, split_part(split_part(header, ':', -1), '+', 1) AS b FROM fastq),
d AS (SELECT b.b, min(sample) AS sample, count(*) AS n FROM (SELECT DISTINCT b FROM b) b JOIN sheet ON length(b.b) = length(idx) AND hamming(b.b, idx) <= 1 GROUP BY b.b)
SELECT coalesce(CASE WHEN n = 1 THEN sample END, 'undetermined') AS sample, count(*) AS reads FROM b LEFT JOIN d USING (b) GROUP BY 1""")
def demux_hamming(spark, sf):
    sheet = spark.createDataFrame(SHEET, "sample string, index string")
    return fastq.demultiplex(frame(spark, sf, "fastq"), sheet).groupBy(F.coalesce("sample", F.lit("undetermined")).alias("sample")).agg(F.count("*").alias("reads"))


_CT = "((ref = 'C' AND alt = 'T') OR (ref = 'G' AND alt = 'A'))"


@query(f"""{cte('variants')} SELECT chrom, pos - 1 AS start, pos - 1 + length(ref) AS "end", id FROM variants WHERE {_CT}""")
def vcf_ct_ga_bed(spark, sf):
    return variants.to_bed(variants.bisulfite_prone(frame(spark, sf, "variants")))


@query(f"{cte('variants', 'cpg_bed')} SELECT * FROM variants v WHERE EXISTS (SELECT 1 FROM cpg_bed c WHERE c.chrom = v.chrom AND c.start_pos < c.end_pos AND v.pos - 1 < c.end_pos AND v.pos - 1 + length(v.ref) > c.start_pos)")
def vcf_in_cpg(spark, sf):
    return variants.in_regions(frame(spark, sf, "variants"), frame(spark, sf, "cpg_bed"))


@query(f"{cte('variants')} SELECT chrom, pos, id FROM variants ORDER BY CAST(substr(chrom, 4) AS INT), pos, id")
def vcf_natural_sort(spark, sf):
    return variants.natural_sort(frame(spark, sf, "variants")).select("chrom", "pos", "id")


@query(f"""{cte('variants')}, c AS (SELECT 'even' AS sample, chrom, pos, ref, alt FROM variants WHERE pos % 2 = 0 UNION ALL SELECT 'third', chrom, pos, ref, CASE WHEN pos % 5 = 0 THEN 'G' ELSE alt END FROM variants WHERE pos % 2 <> 0 OR pos % 3 = 0)
SELECT chrom, pos, ref, string_agg(DISTINCT alt, ',' ORDER BY alt) AS alt, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM c GROUP BY chrom, pos, ref""")
def vcf_merge_samples(spark, sf):
    v = frame(spark, sf, "variants")
    third = v.where("pos % 2 <> 0 OR pos % 3 = 0").withColumn("alt", F.when(F.col("pos") % 5 == 0, "G").otherwise(F.col("alt")))
    return variants.merge_samples(v.where("pos % 2 = 0").withColumn("sample", F.lit("even")).unionByName(third.withColumn("sample", F.lit("third"))))


@query(f"""{cte('spans', 'chains')}, v AS (SELECT row_number() OVER () AS n, * FROM spans),
m AS (SELECT n, chain, score, target_chrom, target_strand, target_size, v.end_pos - v.start_pos AS size, sum(least(v.end_pos, block_end) - greatest(v.start_pos, block_start)) AS bases,
 min(greatest(v.start_pos, block_start) + target_start - block_start) AS a, max(least(v.end_pos, block_end) + target_start - block_start) AS b
 FROM v JOIN chains c ON c.chrom = v.chrom AND v.start_pos < block_end AND v.end_pos > block_start GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, chain) AS place FROM m WHERE bases >= 0.95 * size)
SELECT chrom, start_pos, end_pos, id, target_chrom, CASE WHEN target_strand = '+' THEN a ELSE target_size - b END AS target_from, CASE WHEN target_strand = '+' THEN b ELSE target_size - a END AS target_to FROM v LEFT JOIN t ON t.n = v.n AND place = 1""")
def vcf_lift_over(spark, sf):
    return variants.lift_over(frame(spark, sf, "spans"), frame(spark, sf, "chains"))


@query(f"{cte('spans', 'regions')} SELECT * FROM spans v WHERE EXISTS (SELECT 1 FROM regions c WHERE c.chrom = v.chrom AND c.start_pos < c.end_pos AND v.start_pos < c.end_pos AND v.end_pos > c.start_pos)")
def spans_in_regions(spark, sf):
    return intervals.overlapping(frame(spark, sf, "spans"), frame(spark, sf, "regions"), bin_size=64)


@query(f"{cte('regions')} SELECT gene_name, bin FROM regions")
def select_columns_by_name(spark, sf):
    return sites.select_columns(frame(spark, sf, "regions"), "gene_name", "bin")


@query(f"{cte('variants', 'regions')} SELECT * FROM variants v WHERE EXISTS (SELECT 1 FROM regions c WHERE c.chrom = v.chrom AND c.start_pos < c.end_pos AND v.pos - 1 < c.end_pos AND v.pos - 1 + length(v.ref) > c.start_pos)")
def vcf_in_regions(spark, sf):
    return variants.in_regions(frame(spark, sf, "variants"), frame(spark, sf, "regions"))


@query(f"""WITH q AS ({_region_sql("r.start_pos + 1", _RID)}) SELECT count(*) AS regions, count(*) FILTER (WHERE total_coverage > 0) AS with_data,
 CAST(sum(total_coverage) FILTER (WHERE total_coverage > 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE total_coverage > 0), 0) AS mean_coverage, round(avg(methylation_percentage), 6) AS mean_percentage FROM q""")
def region_summary(spark, sf):
    return me.region_summary(region_methylation_bed0(spark, sf)).withColumn("mean_percentage", F.round("mean_percentage", 6))


@query(f"{cte('listing')} SELECT name, EXISTS (SELECT 1 FROM listing b WHERE b.dir = 'd1' AND b.name = a.name) AS in_second FROM listing a WHERE dir = 'd0'")
def same_name_files(spark, sf):
    return fastq.same_names(frame(spark, sf, "listing"), "d0", "d1")


@query(f"""{cte('listing')} SELECT a.dir, a.name AS i1, b.name AS i2, c.name AS r1, d.name AS r2 FROM listing a LEFT JOIN listing b ON b.dir = a.dir AND b.name = replace(a.name, '_I1', '_I2')
JOIN listing c ON c.dir = a.dir AND c.name = replace(a.name, '_I1', '_R1') JOIN listing d ON d.dir = a.dir AND d.name = replace(a.name, '_I1', '_R2') WHERE contains(a.name, '_I1')""")
def mate_files(spark, sf):
    return fastq.mate_files(frame(spark, sf, "listing"))


@query(f"WITH q AS ({ORACLE_SQL['fastq_four_way_match']}) SELECT file_type, count(*) FILTER (WHERE matched) AS matched_reads, count(*) FILTER (WHERE NOT matched) AS unmatched_reads FROM q GROUP BY file_type")
def fastq_match_counts(spark, sf):
    return fastq.match_counts(fastq_four_way_match(spark, sf))


_PASS = "flag & 1 <> 0 AND flag & 4 = 0 AND flag & 8 = 0"


@query(f"""{_pairs_sql()}, b AS (SELECT count(*) FILTER (WHERE c1 = c2) * 2 AS n, count(*) FILTER (WHERE {_DOVE}) * 2 AS d, CAST(sum(CASE WHEN {_DOVE} THEN greatest(s1, s2) * 2 END) AS BIGINT) AS s FROM p),
c AS (SELECT qname, count(*) % 2 AS odd FROM m GROUP BY qname)
SELECT 0 AS branch, (SELECT count(*) FROM reads WHERE NOT ({_PASS})) AS records, CAST(0 AS BIGINT) AS bounded, CAST(NULL AS BIGINT) AS from_sum UNION ALL SELECT 1, n, d, s FROM b UNION ALL SELECT 2, CAST(sum(odd) AS BIGINT), 0, NULL FROM c""")
def dovetail_mask_plan(spark, sf):
    out = reads.mask_dovetails(frame(spark, sf, "reads"))
    return out.groupBy("branch").agg(F.count("*").alias("records"), F.count("masked_from").alias("bounded"), F.sum("masked_from").alias("from_sum"))


@query(f"{cte('reads')} SELECT qname, flag, start_pos, end_pos FROM reads WHERE ref_id = 1 AND start_pos < 90000 AND end_pos > 49999")
def reads_in_span(spark, sf):
    at = _folder(spark, "reads")
    r = frame(spark, sf, "reads").withColumn("chrom", F.concat(F.lit("chr"), F.col("ref_id").cast("string")))
    tables.write_clustered(r.select("chrom", "qname", "flag", "start_pos", "end_pos"), at, "chrom", "start_pos")
    return reads.in_span(spark.read.parquet(at), F.col("chrom"), "chr1:50000-90000").select("qname", "flag", "start_pos", "end_pos")


@query(f"{cte('variants')} SELECT chrom, pos, id, ref, alt FROM variants WHERE pos % 2 = 0 UNION ALL SELECT chrom, pos, id, ref, alt FROM variants WHERE pos % 2 <> 0 OR pos % 3 = 0")
def vcf_concat(spark, sf):
    v = frame(spark, sf, "variants")
    return variants.concatenate(v.where("pos % 2 = 0"), v.where("pos % 2 <> 0 OR pos % 3 = 0")).select("chrom", "pos", "id", "ref", "alt")


@query(f"""{cte('variants')}, c AS (SELECT chrom, max(pos) AS length FROM variants GROUP BY chrom), w AS (SELECT chrom, length, unnest(range(0, length, 1000)) AS start_pos FROM c)
SELECT chrom, start_pos, least(start_pos + 1000, length) AS end_pos FROM w""")
def contig_windows(spark, sf):
    return variants.windows(frame(spark, sf, "variants").groupBy("chrom").agg(F.max("pos").alias("length")), 1000)


_ALIGN = f"{cte('alignments')}, pl AS (SELECT *, list_transform(range(len(quals)), lambda i: CASE k WHEN 0 THEN start_pos + i WHEN 1 THEN CASE WHEN i < 4 THEN NULL ELSE start_pos + i - 4 END ELSE CASE WHEN i < 10 THEN start_pos + i WHEN i < 12 THEN NULL WHEN i < 17 THEN start_pos + i - 2 ELSE start_pos + i + 1 END END) AS positions FROM alignments)"


def _text(c) -> Column:
    return F.array_join(c, ",", "-")


@query(f"{_ALIGN} SELECT qname, flag, cigar, array_to_string(list_transform(positions, lambda p: coalesce(CAST(p AS VARCHAR), '-')), ',') AS positions FROM pl")
def reference_positions(spark, sf):
    a = frame(spark, sf, "alignments")
    return a.select("qname", "flag", "cigar", _text(reads.reference_positions(F.col("cigar"), F.col("start_pos"))).alias("positions"))


_RECORDS = f"""{_ALIGN}, m AS (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY rec_no) - 1 AS n FROM pl WHERE {{where}}),
fs AS (SELECT a.qname, a.n // 2 AS pair_no, a.flag AS f1, a.ref_id AS c1, a.start_pos AS s1, a.end_pos AS e1, a.rec_no AS o1, b.flag AS f2, b.ref_id AS c2, b.start_pos AS s2, b.end_pos AS e2, b.rec_no AS o2 FROM m a JOIN m b ON b.qname = a.qname AND b.n = a.n + 1 WHERE a.n % 2 = 0),
p AS (SELECT qname, pair_no, CASE WHEN f2 & 64 <> 0 THEN f2 ELSE f1 END AS f1, c1, c2, CASE WHEN f2 & 64 <> 0 THEN s2 ELSE s1 END AS s1, CASE WHEN f2 & 64 <> 0 THEN e2 ELSE e1 END AS e1,
 CASE WHEN f2 & 64 <> 0 THEN f1 ELSE f2 END AS f2, CASE WHEN f2 & 64 <> 0 THEN s1 ELSE s2 END AS s2, CASE WHEN f2 & 64 <> 0 THEN e1 ELSE e2 END AS e2, CASE WHEN f2 & 64 <> 0 THEN o2 ELSE o1 END AS first_mate FROM fs)"""
_MAPPED = _RECORDS.replace("{where}", _PASS)


@query(f"{_MAPPED} SELECT m.qname, flag, start_pos, end_pos, cigar, CASE WHEN rec_no = first_mate THEN 1 ELSE 2 END AS mate FROM m JOIN p ON p.qname = m.qname AND p.pair_no = m.n // 2 WHERE {_DOVE}")
def dovetail_records(spark, sf):
    return reads.dovetail_records(frame(spark, sf, "alignments")).select("qname", "flag", "start_pos", "end_pos", "cigar", "mate")


@query(f"""{_MAPPED}, w AS (SELECT m.*, CASE WHEN {_DOVE} THEN greatest(s1, s2) END AS a, least(e1, e2) AS b FROM m JOIN p ON p.qname = m.qname AND p.pair_no = m.n // 2 WHERE c1 = c2),
o AS (SELECT qname, flag, start_pos, 0 AS branch, quals FROM pl WHERE NOT ({_PASS})
 UNION ALL SELECT qname, flag, start_pos, 1, CASE WHEN a IS NULL THEN quals ELSE list_transform(range(1, len(quals) + 1), lambda i: CASE WHEN positions[i] >= a AND positions[i] < b THEN quals[i] ELSE 0 END) END FROM w
 UNION ALL SELECT qname, flag, start_pos, 2, quals FROM m WHERE n % 2 = 0 AND NOT EXISTS (SELECT 1 FROM fs WHERE fs.qname = m.qname AND fs.pair_no = m.n // 2))
SELECT qname, flag, start_pos, branch, array_to_string(quals, ',') AS quals FROM o""")
def dovetail_masked_records(spark, sf):
    return reads.masked_records(frame(spark, sf, "alignments")).select("qname", "flag", "start_pos", "branch", _text("quals").alias("quals"))


@query(f"""{_MAPPED} SELECT m.qname, flag, start_pos, cigar, CASE WHEN greatest(e1, e2) - least(s1, s2) <= 50 THEN 'small' WHEN greatest(e1, e2) - least(s1, s2) <= 100 THEN 'medium' WHEN greatest(e1, e2) - least(s1, s2) <= 150 THEN 'long' ELSE 'xlarge' END AS output
FROM m JOIN p ON p.qname = m.qname AND p.pair_no = m.n // 2 WHERE c1 = c2""")
def split_by_size_records(spark, sf):
    return reads.split_by_size(frame(spark, sf, "alignments")).select("qname", "flag", "start_pos", "cigar", "output")


@query(f"""{_RECORDS.replace("{where}", "flag & 4 = 0")}, k AS (SELECT qname, pair_no, CASE f1 WHEN 99 THEN 'OT' WHEN 83 THEN 'OB' WHEN 147 THEN 'CTOT' WHEN 163 THEN 'CTOB' END AS output FROM fs)
SELECT m.qname, flag, start_pos, cigar, output FROM m JOIN k ON k.qname = m.qname AND k.pair_no = m.n // 2 WHERE output IS NOT NULL""")
def split_by_strand_records(spark, sf):
    return reads.split_by_strand(frame(spark, sf, "alignments")).select("qname", "flag", "start_pos", "cigar", "output")


@query(f"""{cte('fastq')}, t AS ({' UNION ALL '.join(f"SELECT '{t}' AS file_type, *, split_part(header, ' ', 1) AS read_name FROM fastq WHERE {w}" for t, w in _TYPES)}),
n AS (SELECT read_name, count(DISTINCT file_type) = 4 AS matched, min(rec_no) FILTER (WHERE file_type = 'I1') AS f FROM t GROUP BY ALL)
SELECT file_type, row_number() OVER (PARTITION BY file_type ORDER BY matched DESC, CASE WHEN matched THEN f END, read_name) AS place, header, seq, plus, qual FROM t JOIN n USING (read_name)""")
def fastq_four_way_records(spark, sf):
    f = frame(spark, sf, "fastq")
    parts = [f.where(w).withColumn("file_type", F.lit(t)) for t, w in _TYPES]
    records = parts[0]
    for p in parts[1:]:
        records = records.unionByName(p)
    return fastq.four_way_records(records)


_OF = "SELECT CASE WHEN rec_no % 3 = 0 THEN 'd1' ELSE 'd0' END AS dir, concat('Smp', CAST(rec_no % 4 AS STRING), '_S1_L00', CAST(rec_no % 2 + 1 AS STRING), CASE WHEN rec_no % 5 = 0 THEN '_R2' ELSE '_R1' END, '_001.fastq.gz') AS name, * FROM {fastq}"


@query(f"""{cte('fastq')}, r AS ({_OF.format(fastq='fastq')}), c AS (SELECT DISTINCT dir, name, regexp_replace(name, '_S1_L00.*', '') AS sample, CASE WHEN contains(name, '_R1') THEN 'R1' ELSE 'R2' END AS read_type FROM r),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY sample, read_type ORDER BY dir, name) AS INTEGER) AS part FROM c)
SELECT sample, read_type, part, rec_no, header, seq, plus, qual FROM r JOIN p USING (dir, name)""")
def fastq_concatenated_records(spark, sf):
    r = spark.sql(_OF, fastq=frame(spark, sf, "fastq"))
    return fastq.concatenated_records(r, r.select("dir", "name").distinct())


@query(f"""{cte('genotypes')}, a AS (SELECT *, list_filter([alt1, alt2], lambda x: x IS NOT NULL) AS alts FROM genotypes), s AS (SELECT chrom, pos, ref, list_sort(list_distinct(flatten(list(alts)))) AS every FROM a GROUP BY ALL),
g AS (SELECT a.*, every, CASE WHEN genotype = './.' THEN './.' WHEN genotype = '0|1' THEN concat('0|', CAST(list_position(every, alt1) AS VARCHAR)) WHEN genotype = '1/2' THEN concat(CAST(list_position(every, alt1) AS VARCHAR), '/', CAST(list_position(every, alt2) AS VARCHAR)) ELSE concat(CAST(list_position(every, alt1) AS VARCHAR), '/', CAST(list_position(every, alt1) AS VARCHAR)) END AS g FROM a JOIN s USING (chrom, pos, ref))
SELECT chrom, pos, ref, array_to_string(any_value(every), ',') AS alts, string_agg(concat(sample, '=', g), ',' ORDER BY sample) AS genotypes FROM g GROUP BY chrom, pos, ref""")
def vcf_merge_genotypes(spark, sf):
    calls = frame(spark, sf, "genotypes").withColumn("alts", F.filter(F.array("alt1", "alt2"), lambda x: x.isNotNull()))
    m = variants.merge_genotypes(calls)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("genotypes")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return m.select("chrom", "pos", "ref", _text("alts").alias("alts"), shown.alias("genotypes"))


# Sources and sinks: tables are written as the files that the formats ask for, and read back.


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"{cte('regions')} SELECT chrom, start_pos, end_pos, concat_ws('_', chrom, CAST(start_pos AS VARCHAR), CAST(end_pos AS VARCHAR)) AS region_id FROM regions")
def bed_files(spark, sf):
    at = _folder(spark, "bed")
    tables.write_sites(frame(spark, sf, "regions").select("chrom", "start_pos", "end_pos"), at)
    return tables.read_bed(spark, at).select("chrom", "start_pos", "end_pos", _region_id())


@query(f"{cte('regions')} SELECT base, chrom, start_pos, end_pos, CASE WHEN strand = '+' THEN 'top' ELSE 'bottom' END AS strand_side FROM regions CROSS JOIN (VALUES (0), (1)) v(base)")
def stranded_bed_files(spark, sf):
    """The strand column counted from 1 and from 0."""
    at = _folder(spark, "stranded")
    tables.write_sites(frame(spark, sf, "regions").select("chrom", "start_pos", "end_pos", "bin", "strand"), at, gzip=False)
    one, zero = (tables.read_stranded_bed(spark, at, 4 + base, base).select(F.lit(base).alias("base"), "chrom", "start_pos", "end_pos", "strand_side") for base in (1, 0))
    return one.unionByName(zero)


@query(f"{cte('allc')} SELECT chrom, pos, strand, context, mc, cov, flag FROM allc")
def allc_files(spark, sf):
    at = _folder(spark, "allc")
    tables.write_sites(frame(spark, sf, "allc").select("chrom", "pos", "strand", "context", "mc", "cov", "flag"), at)
    return tables.read_allc(spark, at).select("chrom", "pos", "strand", "context", "mc", "cov", "flag")


@query(f"{cte('beta')} SELECT chrom, start_pos, end_pos, mc, cov FROM beta")
def bed5_files(spark, sf):
    at = _folder(spark, "bed5")
    tables.write_sites(frame(spark, sf, "beta").select("chrom", "start_pos", "end_pos", "mc", "cov"), at)
    return tables.read_bed(spark, at, tables.BED5).select("chrom", "start_pos", "end_pos", "mc", "cov")


@query(f"""WITH q AS ({_OVERALL} SELECT * FROM o) SELECT sample, total_mc, total_cov, CASE WHEN methylation_fraction IS NOT NULL THEN printf('%.6f', methylation_fraction) END AS methylation_fraction, sites_with_data FROM q""")
def overall_methylation_files(spark, sf):
    """Fractions with six decimals, one folder for each sample; a folder that is missing adds no row."""
    at = _folder(spark, "overall")
    tables.write_tsv(overall_methylation(spark, sf), at, 6, partition_by=("sample",))
    fields = "total_mc long, total_cov long, methylation_fraction string, sites_with_data long, sample string"
    return tables.read_results(spark, at, fields).unionByName(tables.read_results(spark, at + "-none", fields))


@query(f"""WITH q AS ({_region_sql("r.start_pos + 1", _RID)}) SELECT region_id, chrom, start, "end", total_coverage, CASE WHEN methylation_percentage IS NOT NULL THEN printf('%.3f', methylation_percentage) END AS methylation_percentage FROM q""")
def region_methylation_files(spark, sf):
    at = _folder(spark, "regions")
    out = region_methylation_bed0(spark, sf).select("region_id", "chrom", "start", "end", "total_coverage", "methylation_percentage")
    tables.write_tsv(out, at, 3)
    return tables.read_results(spark, at, "region_id string, chrom string, start long, end long, total_coverage long, methylation_percentage string")


@query(f"{cte('fastq')} SELECT header, seq, plus, qual FROM fastq")
def fastq_file_copies(spark, sf):
    """Records written compressed and read again."""
    at = _folder(spark, "fastq")
    sequences.write_fastq(frame(spark, sf, "fastq"), at)
    return sequences.read_fastq(spark, at).select("header", "seq", "plus", "qual")


@query(f"{cte('listing')} SELECT dir, name FROM listing")
def discovered_files(spark, sf):
    """Files laid out in folders, found by a pattern; their folders carry the names."""
    at = _folder(spark, "run")
    l = frame(spark, sf, "listing")
    l.repartition("dir", "name").select("dir", "name", F.lit("x").alias("value")).write.partitionBy("dir", "name").text(at)
    found = tables.discover(spark, at, "*.txt").where("size = 2")
    return found.select(F.regexp_extract("dir", "/dir=([^/]*)/", 1).alias("dir"), F.regexp_extract("dir", "/name=([^/]*)$", 1).alias("name"))


@query(f"{cte('cells')} SELECT barcode AS name FROM cells")
def listed_names(spark, sf):
    """A list with blank lines and blanks around the names."""
    at = _folder(spark, "list")
    frame(spark, sf, "cells").select(F.concat(F.lit("  "), "barcode", F.lit(" \n\n ")).alias("value")).write.text(at)
    return tables.read_names(spark, at)


@query(f"{cte('cells')} SELECT barcode AS Sample_ID, grp AS Sample_Name, CASE WHEN grp <> 'grp1' THEN upper(barcode) END AS index FROM cells")
def demux_sheet_rows(spark, sf):
    """The rows under [Data] of a sheet with other sections, blank lines and short rows."""
    at = _folder(spark, "sheet")
    line = F.concat_ws(",", "barcode", F.concat(F.lit(" "), "grp"), F.when(F.col("grp") != "grp1", F.upper("barcode")))
    body = frame(spark, sf, "cells").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n\n").alias("rows"))
    body.select(F.concat(F.lit("[Header]\nx,1\n\n[DATA],,\nSample_ID,Sample_Name,index\n"), "rows").alias("value")).write.text(at)
    return tables.read_demux_sheet(spark, at)


@query(f"{cte('chains')} SELECT chain, CAST(score AS BIGINT) AS score, chrom, block_start, block_end, target_chrom, target_start, target_strand, target_size FROM chains")
def chain_files(spark, sf):
    """Blocks written as chains with their gaps, and read again."""
    at = _folder(spark, "chain")
    b = frame(spark, sf, "chains").groupBy("chain", "score", "chrom", "target_chrom", "target_strand", "target_size").agg(F.array_sort(F.collect_list(F.struct("block_start", "block_end", "target_start"))).alias("b"))
    text = lambda c: c.cast("string")

    def line(x: Column, i: Column) -> Column:
        size, after = x["block_end"] - x["block_start"], F.get("b", i + 1)
        return F.concat_ws(" ", text(size), text(after["block_start"] - x["block_end"]), text(after["target_start"] - x["target_start"] - size))

    first, last = F.col("b")[0], F.element_at("b", -1)
    head = F.concat_ws(" ", F.lit("chain"), text(F.col("score")), "chrom", F.lit("0 +"), text(first["block_start"]), text(last["block_end"]), "target_chrom", text(F.col("target_size")), "target_strand", text(first["target_start"]), text(last["target_start"] + last["block_end"] - last["block_start"]), text(F.col("chain")))
    b.select(F.concat_ws("\n", head, F.array_join(F.transform("b", line), "\n"), F.lit("")).alias("value")).write.text(at)
    return chain.read_chain(spark, at)


@query(ORACLE_SQL["bin100_methylation"].replace("bin_start, CAST(sum(mc)", "bin_start, (pos - 1) // 100 * 100 + 100 AS bin_end, CAST(sum(mc)").replace("SELECT chrom,", "SELECT chrom, bin_start, bin_end, fraction FROM (SELECT chrom,", 1).replace("GROUP BY chrom, bin_start", "GROUP BY chrom, bin_start, bin_end) WHERE fraction IS NOT NULL"))
def bedgraph_file(spark, sf):
    at = _folder(spark, "bedgraph")
    tables.write_bedgraph(bin100_methylation(spark, sf), at)
    return spark.read.schema("chrom string, bin_start long, bin_end long, fraction double").option("sep", "\t").csv(at)


@query(f"{cte('fastq')} SELECT split_part(header, ':', -1) AS barcode, header, seq, plus, qual FROM fastq")
def fastq_files_by_barcode(spark, sf):
    at = _folder(spark, "fastq")
    f = frame(spark, sf, "fastq").withColumn("barcode", names.barcode(F.col("header")))
    sequences.write_fastq(f, at, partition_by=("barcode",))
    got = sequences.read_fastq(spark, at)
    folder = F.replace(F.regexp_extract("file", "barcode=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))
    return got.select(F.url_decode(folder).alias("barcode"), "header", "seq", "plus", "qual")


_BLANK = "(rec_no % 997 = 500)"


@query(f"{cte('fastq')}, r AS (SELECT concat('f', CAST(rec_no % 3 AS VARCHAR)) AS file, rec_no, CASE WHEN {_BLANK} THEN '' ELSE header END AS header FROM fastq), s AS (SELECT file, min(rec_no) AS stop FROM r WHERE header = '' GROUP BY file) SELECT file, rec_no, header FROM r LEFT JOIN s USING (file) WHERE stop IS NULL OR rec_no < stop")
def fastq_until_blank(spark, sf):
    f = frame(spark, sf, "fastq").select(F.concat(F.lit("f"), (F.col("rec_no") % 3).cast("string")).alias("file"), "rec_no", F.when(F.expr(_BLANK), "").otherwise(F.col("header")).alias("header"))
    return fastq.until_blank_header(f)


@query(f"{cte('fasta')} SELECT chrom, seq FROM fasta")
def fasta_files(spark, sf):
    at = _folder(spark, "fasta")
    sequences.write_fasta(frame(spark, sf, "fasta"), at)
    return sequences.whole_sequences(sequences.read_fasta(spark, at, 10_000))


@query(f"{cte('alignments')} SELECT qname, flag, concat('chr', CAST(ref_id AS VARCHAR)) AS ref_name, start_pos, end_pos, cigar, array_to_string(quals, ',') AS quals, concat('chr', CAST(ref_id AS VARCHAR)) AS output FROM alignments")
def sam_files(spark, sf):
    at = _folder(spark, "sam")
    a = frame(spark, sf, "alignments").withColumn("ref_name", F.concat(F.lit("chr"), F.col("ref_id").cast("string")))
    sequences.write_sam(a.withColumn("output", F.col("ref_name")), at, ("@HD\tVN:1.6",), ("output",))
    got = sequences.read_sam(spark, at)
    return got.select("qname", "flag", "ref_name", "start_pos", "end_pos", "cigar", _text("quals").alias("quals"), F.regexp_extract("file", "output=([^/]*)/", 1).alias("output"))


@query(f"{cte('genotypes')} SELECT CASE sample WHEN 'smp1' THEN 'donor' ELSE sample END AS sample, chrom, pos, ref, array_to_string(list_filter([alt1, alt2], lambda x: x IS NOT NULL), ',') AS alts, genotype FROM genotypes")
def vcf_files(spark, sf):
    """A file for each of the three samples; one of them gets a new name as it is read."""
    at = _folder(spark, "vcf")
    g = frame(spark, sf, "genotypes").select("sample", "chrom", "pos", F.lit(None).cast("string").alias("id"), "ref", F.filter(F.array("alt1", "alt2"), lambda x: x.isNotNull()).alias("alt"), F.lit("GT").alias("format"), "genotype")
    for name in ("smp1", "smp2", "smp3"):
        own = g.where(F.col("sample") == name).withColumnRenamed("genotype", name)
        sequences.write_vcf(own, f"{at}/{name}", ["##fileformat=VCFv4.2"], {name: name})
    paths = [f"{at}/smp{i}" for i in (1, 2, 3)]
    calls, known = sequences.read_vcf(spark, paths), sequences.vcf_samples(spark, paths)
    folder = F.regexp_replace("file", "/[^/]*$", "")
    known = known.select(folder.alias("file"), "samples").distinct()  # the header is in one part file of each
    return sequences.genotypes(calls.withColumn("file", folder), known, {"smp1": "donor"}).withColumn("alts", _text("alts"))


@query(f"{cte('transcription')} SELECT gene_name, barcode FROM transcription WHERE status = 'transcribed'")
def matrix_file(spark, sf):
    at = _folder(spark, "matrix")
    wide = frame(spark, sf, "transcription").groupBy(F.col("gene_name").alias("gene")).pivot("barcode", list(CELLS)).agg(F.first("status"))
    wide.write.option("header", True).csv(at)
    return sites.unpivot_matrix(tables.read_matrix(spark, at), "gene_name", "transcribed")


@query(f"""{cte('cells')}, j AS (SELECT *, CASE WHEN barcode LIKE '%1%' THEN NULL ELSE barcode END AS b, CASE grp WHEN 'grp0' THEN 'NCH' END AS c FROM cells)
SELECT concat('/in/', barcode, '.tsv') AS allc_path, '/in/tss.bed' AS bed_path, coalesce(b, 'sample') AS barcode, coalesce(c, 'NCG') AS context, CASE grp WHEN 'grp1' THEN -500 ELSE -3000 END AS range_start, 3000 AS range_end, 5 AS strand_col,
 concat('/out/', coalesce(b, 'sample'), '.', coalesce(c, 'NCG'), '.NA.top.tsv') AS top_path, concat('/out/', coalesce(b, 'sample'), '.', coalesce(c, 'NCG'), '.NA.bottom.tsv') AS bottom_path FROM j""")
def tss_jobs(spark, sf):
    """A sheet with blank cells and without some optional columns."""
    at = _folder(spark, "sheet")
    c = frame(spark, sf, "cells")
    sheet = c.select(
        F.concat(F.lit("/in/"), "barcode", F.lit(".tsv")).alias("allc_path"), F.lit("/in/tss.bed").alias("bed_path"), F.lit("/out").alias("out_dir"), F.when(F.contains("barcode", F.lit("1")), " ").otherwise(F.col("barcode")).alias("barcode"),
        F.when(F.col("grp") == "grp0", "NCH").alias("context"), F.when(F.col("grp") == "grp1", "-500").alias("range_start"),
    )
    sheet.write.option("header", True).csv(at)
    return flagship.tss_jobs(tables.read_sheet(spark, at, ("allc_path", "bed_path", "out_dir")))


@query(_tss_sql("allc").replace("AS strand_side FROM regions)", "AS strand_side FROM regions WHERE start_pos < 0)"))
def tss_profile_empty(spark, sf):
    return me.anchor_profile(frame(spark, sf, "allc"), frame(spark, sf, "regions").where("start_pos < 0"), FIRST, LAST_OFFSET, "all")


@query(f"""{cte('listing')} SELECT name, regexp_replace(name, '_S\\d+.*$', '') AS sample, regexp_replace(name, '_L\\d+.*$', '') AS with_number,
 CASE WHEN contains(name, 'I1') THEN 'I1' WHEN contains(name, 'I2') THEN 'I2' WHEN contains(name, 'R1') THEN 'R1' WHEN contains(name, 'R2') THEN 'R2' END AS read_type,
 list_filter(string_split(regexp_replace(name, '\\..*$', ''), '_'), lambda x: x IN ('R1', 'R2', 'I1', 'I2'))[1] AS read_part, split_part(name, '-', 1) AS prefix FROM listing""")
def read_file_names(spark, sf):
    n = F.col("name")
    return frame(spark, sf, "listing").select("name", names.strip_number(n).alias("sample"), names.strip_number(n, True).alias("with_number"), names.read_type(n, ("I1", "I2", "R1", "R2")).alias("read_type"), names.read_part(n).alias("read_part"), names.sample_prefix(n).alias("prefix"))


_LABELS = ("NCGN-Both", "HCHN-Both")


@query(f"""{cte('cells')}, f AS (SELECT barcode, concat(barcode, CASE grp WHEN 'grp0' THEN '.NCGN-Both' WHEN 'grp1' THEN '.HCHN-Both' ELSE '.other' END, '.allc.tsv', CASE WHEN barcode LIKE '%2%' THEN '' ELSE '.gz' END) AS name, grp FROM cells)
SELECT name, concat(barcode, CASE grp WHEN 'grp0' THEN '.NCGN-Both' WHEN 'grp1' THEN '.HCHN-Both' ELSE '.other' END) AS sample, CASE grp WHEN 'grp0' THEN 'NCGN' WHEN 'grp1' THEN 'HCHN' END AS context, CASE grp WHEN 'grp0' THEN barcode ELSE concat(barcode, CASE grp WHEN 'grp1' THEN '.HCHN-Both' ELSE '.other' END) END AS cell FROM f""")
def methylation_file_names(spark, sf):
    kind = F.when(F.col("grp") == "grp0", ".NCGN-Both").when(F.col("grp") == "grp1", ".HCHN-Both").otherwise(".other")
    f = frame(spark, sf, "cells").select(F.concat("barcode", kind, F.lit(".allc.tsv"), F.when(F.contains("barcode", F.lit("2")), "").otherwise(".gz")).alias("name"))
    return f.select("name", names.file_sample(F.col("name")).alias("sample"), names.first_context(F.col("name"), _LABELS).alias("context"), names.file_barcode(F.col("name"), F.lit("NCGN-Both")).alias("cell"))


@query(f"{cte('fastq')}, b AS (SELECT split_part(header, ':', -1) AS barcode, count(*) AS reads FROM fastq GROUP BY ALL) SELECT barcode, printf('%.3f', CAST(reads AS DOUBLE) / 1000000) AS label FROM b")
def downsample_labels(spark, sf):
    return fastq.barcode_counts(frame(spark, sf, "fastq")).select("barcode", names.million_label(F.col("reads")).alias("label"))


_DEPTHS = tuple(d // 1000 for d in fastq.DEPTHS)
_DEPTH = " ".join(f"WHEN n <= {d} THEN {d}" for d in _DEPTHS)


@query(f"{cte('fastq')}, r AS (SELECT *, row_number() OVER (ORDER BY md5('100:' || {_ID}), rec_no) AS n FROM fastq) SELECT rec_no, header, seq, qual, CAST(CASE {_DEPTH} END AS INTEGER) AS depth FROM r WHERE n <= {max(_DEPTHS)}")
def sampled_reads(spark, sf):
    """Eight nested samples; the depth of a read is the smallest that holds it."""
    return fastq.sample_depths(frame(spark, sf, "fastq"), _DEPTHS).select("rec_no", "header", "seq", "qual", "depth")


FRACTION = 0.4


def _lowess_sql() -> str:
    """The local fit and its three robust steps, a chain of tables for each."""
    sql = f"""WITH p AS ({ORACLE_SQL['cell_bin_profile']}),
v AS (SELECT "group" AS g, bin AS x, methylation_percentage AS y FROM p WHERE methylation_percentage IS NOT NULL),
k AS (SELECT g, least(greatest(CAST(floor({FRACTION} * count(*) + 1e-10) AS BIGINT), 2), count(*)) AS k FROM v GROUP BY g),
d AS (SELECT a.g, a.x AS xi, a.y AS yi, b.x AS xj, b.y AS yj, CAST(abs(a.x - b.x) AS DOUBLE) AS d FROM v a JOIN v b USING (g)),
h AS (SELECT g, xi, d AS h FROM (SELECT d.*, k, row_number() OVER (PARTITION BY g, xi ORDER BY d) AS n FROM d JOIN k USING (g)) WHERE n = k),
t AS (SELECT d.*, CASE WHEN h > 0 THEN pow(greatest(1 - pow(d / h, 3), 0), 3) WHEN d = 0 THEN 1 ELSE 0 END AS tri FROM d JOIN h USING (g, xi)),
r0 AS (SELECT g, x, CAST(1 AS DOUBLE) AS w FROM v)"""
    for s in range(4):
        sql += f""",
w{s} AS (SELECT t.*, tri * r.w AS u FROM t JOIN r{s} r ON r.g = t.g AND r.x = t.xj),
m{s} AS (SELECT g, xi, sum(u * xj) / sum(u) AS mx, sum(u * yj) / sum(u) AS my FROM w{s} GROUP BY ALL),
f{s} AS (SELECT g, xi, yi, my + CASE WHEN sum(u * pow(xj - mx, 2)) > 1e-12 THEN sum(u * (xj - mx) * (yj - my)) / sum(u * pow(xj - mx, 2)) * (xi - mx) ELSE 0 END AS fit FROM w{s} JOIN m{s} USING (g, xi) GROUP BY g, xi, yi, mx, my),
q{s} AS (SELECT g, median(abs(yi - fit)) AS m FROM f{s} GROUP BY g),
r{s + 1} AS (SELECT g, xi AS x, CASE WHEN m > 0 THEN pow(greatest(1 - pow((yi - fit) / (6 * m), 2), 0), 2) ELSE 1 END AS w FROM f{s} JOIN q{s} USING (g))"""
    return sql + ' SELECT g AS "group", xi AS bin, yi AS methylation_percentage, round(fit, 6) AS smoothed FROM f3'


@query(_lowess_sql())
def smoothed_profile(spark, sf):
    """Locally weighted regression with robust steps; smoothed values rounded to six places."""
    return smoothing.smooth(cell_bin_profile(spark, sf), "group", "bin", "methylation_percentage", FRACTION).withColumn("smoothed", F.round("smoothed", 6))


@query(f"""{cte('scored_reads')}, e AS (SELECT file, unnest(range(1, length(seq) + 1)) AS position, seq, qual FROM scored_reads),
b AS (SELECT file, position, substr(seq, position, 1) AS base, ascii(substr(qual, position, 1)) - 33 AS q FROM e)
SELECT file, position, count(*) AS reads, avg(q) AS mean, CAST(quantile_disc(q, 0.25) AS BIGINT) AS q1, CAST(quantile_disc(q, 0.5) AS BIGINT) AS median, CAST(quantile_disc(q, 0.75) AS BIGINT) AS q3,
 {', '.join(f"CAST(count(*) FILTER (WHERE base = '{x}') AS DOUBLE) / count(*) AS {x.lower()}" for x in 'ACGTN')} FROM b GROUP BY file, position""")
def read_position_quality(spark, sf):
    return read_quality.position_quality(frame(spark, sf, "scored_reads"))


@query(f"""{cte('alignments')}, a AS (SELECT ref_id, start_pos, k, unnest(range(len(quals))) AS i, unnest(quals) AS q FROM alignments WHERE flag & 4 = 0),
b AS (SELECT ref_id, start_pos + CASE k WHEN 0 THEN i WHEN 1 THEN i - 4 ELSE CASE WHEN i < 10 THEN i WHEN i < 17 THEN i - 2 ELSE i + 1 END END AS pos FROM a WHERE q >= 30 AND CASE k WHEN 1 THEN i >= 4 WHEN 2 THEN i NOT IN (10, 11) ELSE true END),
d AS (SELECT ref_id, pos, count(*) AS depth FROM b GROUP BY ALL HAVING count(*) >= 2),
s AS (SELECT *, pos - row_number() OVER (PARTITION BY ref_id, depth ORDER BY pos) AS run FROM d)
SELECT ref_id, min(pos) AS start, max(pos) + 1 AS "end", depth FROM s GROUP BY ref_id, depth, run""")
def base_depth(spark, sf):
    return read_quality.base_depth(frame(spark, sf, "alignments"))


@query(f"{cte('regions')} SELECT chrom, start_pos, end_pos, bin, CASE WHEN rid % 4 <> 0 THEN gene_name END AS gene_name FROM regions")
def gene_bin_lines(spark, sf):
    text = F.concat_ws("\t", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.col("bin").cast("string"), F.lit("x"), "strand", F.when(F.col("rid") % 4 != 0, F.col("gene_name")))
    return me.gene_bins(frame(spark, sf, "regions").select(F.split(text, "\t").alias("cols")))


CONFIG_SEGMENTS = ("up", "body", "down")


def _pipeline(spark, sf) -> flagship.Profiles:
    """One methylation file for each cell, one interval file for each segment, a matrix and a metadata table."""
    at = _folder(spark, "pipeline")
    a = frame(spark, sf, "allc").select(F.concat("sample", F.lit(".NCGN-Both.allc.tsv")).alias("f"), "ord", F.concat_ws("\t", "chrom", *[F.col(c).cast("string") for c in ("pos", "strand", "context", "mc", "cov", "flag")]).alias("value"))
    a = a.repartitionByRange("f", "ord").sortWithinPartitions("f", "ord").select("f", "value").write
    with settings(spark, DROP_SHUFFLES):
        a.partitionBy("f").option("compression", "gzip").text(f"{at}/allc")
    r = frame(spark, sf, "regions").withColumn("segment", F.element_at(F.array(*map(F.lit, CONFIG_SEGMENTS)), (F.col("rid") % 3 + 1).cast("int")))
    for name in CONFIG_SEGMENTS:
        tables.write_sites(r.where(F.col("segment") == name).select("chrom", "start_pos", "end_pos", "bin", F.lit("x").alias("x"), "strand", "gene_name"), f"{at}/{name}")
    wide = frame(spark, sf, "transcription").groupBy(F.col("gene_name").alias("gene")).pivot("barcode", list(CELLS)).agg(F.first("status"))
    wide.write.option("header", True).csv(f"{at}/matrix")
    frame(spark, sf, "cells").select(F.col("barcode").alias("index"), F.col("grp").alias("group"), "barcode").write.option("header", True).csv(f"{at}/cells")
    config = PipelineConfig(("NCGN-Both",), {name: Region(f"{at}/{name}", 6, ("+", "-"), 20) for name in CONFIG_SEGMENTS}, MIN_COVERAGE)
    paths = [f"{at}/allc/f={c}.NCGN-Both.allc.tsv" for c in CELLS]
    out = flagship.run(spark, paths, config, f"{at}/matrix", f"{at}/cells", "NCGN")
    removed(spark, f"{at}/allc")  # the results have the pipeline's own table
    return out


@query(f"{cte('allc', 'regions')}, {_CELL} SELECT sample, 'NCGN' AS context, ['up', 'body', 'down'][rid % 3 + 1] AS region, strand_side, concat(chrom, ':', CAST(start_pos AS VARCHAR), '-', CAST(end_pos AS VARCHAR)) AS region_id, bin, total_coverage, total_methylated, sites_with_data FROM cr")
def pipeline_region_tables(spark, sf):
    """The flagship from text files to its region tables."""
    return _pipeline(spark, sf).region_rows


@query(ORACLE_SQL["combined_regions_profile"])
def pipeline_profiles(spark, sf):
    """The flagship from text files to the profiles of groups."""
    return _pipeline(spark, sf).profiles


@query(ORACLE_SQL["pipeline_region_tables"])
def pipeline_region_files(spark, sf):
    """The flagship's region tables as it writes them, by region, context, strand side and cell."""
    at = _folder(spark, "out")
    flagship.write(_pipeline(spark, sf), at)
    return tables.read_results(spark, f"{at}/regions", "region_id string, bin long, total_coverage long, total_methylated long, sites_with_data long, region string, context string, strand_side string, sample string")


@query(f"""SELECT "group", segment, bin, total_coverage, total_methylated, CASE WHEN methylation_percentage IS NOT NULL THEN printf('%.3f', methylation_percentage) END AS methylation_percentage FROM ({ORACLE_SQL['combined_regions_profile']})""")
def pipeline_profile_files(spark, sf):
    """The flagship's profiles as it writes them, by group."""
    at = _folder(spark, "out")
    flagship.write_profiles(_pipeline(spark, sf), at)
    return tables.read_results(spark, f"{at}/profiles", "segment string, bin long, total_coverage long, total_methylated long, methylation_percentage string, group string")
