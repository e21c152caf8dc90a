"""The driver's tables reshaped into sequencing tables.

The same SQL text runs in Spark and in DuckDB. Rows carry their file order as a struct of sort keys in Spark
(`ord`): operators that need "last" or "first seen" order by it, so no global row number is computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDER = ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_ALLC = """SELECT concat('chr', CAST(l_suppkey % 22 + 1 AS STRING)) AS chrom, l_orderkey * 7 + l_linenumber AS pos,
 CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand,
 CASE WHEN l_linestatus = 'F' THEN 'ACGT' WHEN l_returnflag = 'A' THEN 'GCA' ELSE 'CHH' END AS context,
 l_partkey % CAST(l_quantity AS BIGINT) AS mc, CAST(l_quantity AS BIGINT) - 1 AS cov, 1 AS flag,
 concat('cell', CAST(l_partkey % 20 AS STRING)) AS sample, {ord} FROM lineitem"""
_READS = """SELECT {ord}, concat('q', CAST(l_orderkey AS STRING)) AS qname,
 CASE l_partkey % 6 WHEN 0 THEN 99 WHEN 1 THEN 147 WHEN 2 THEN 83 WHEN 3 THEN 163 WHEN 4 THEN 77 ELSE 0 END AS flag,
 CAST(l_suppkey % 2 AS INT) AS ref_id, l_orderkey * 10 + l_suppkey % 60 AS start_pos,
 l_orderkey * 10 + l_suppkey % 60 + 30 + CAST(l_quantity AS BIGINT) AS end_pos,
 CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'GA' ELSE 'CT' END AS xr,
 CASE WHEN l_linestatus = 'F' THEN 'CT' ELSE 'GA' END AS xg FROM lineitem"""
# reads with stored bases: plain, soft-clipped, and with an insertion and a deletion
_ALIGNMENTS = """SELECT qname, flag, ref_id, start_pos, end_pos, k, cigar, {quals} AS quals{more} FROM (
 SELECT *, CASE k WHEN 0 THEN n WHEN 1 THEN n + 4 ELSE n - 1 END AS stored, CASE k WHEN 0 THEN concat(CAST(n AS STRING), 'M') WHEN 1 THEN concat('4S', CAST(n AS STRING), 'M') ELSE concat('10M2I5M3D', CAST(n - 18 AS STRING), 'M') END AS cigar
 FROM (SELECT {ord}, concat('q', CAST(l_orderkey AS STRING)) AS qname, CASE l_partkey % 6 WHEN 0 THEN 99 WHEN 1 THEN 147 WHEN 2 THEN 83 WHEN 3 THEN 163 WHEN 4 THEN 77 ELSE 0 END AS flag,
 CAST(l_suppkey % 2 AS INT) AS ref_id, l_orderkey * 10 + l_suppkey % 60 AS start_pos, l_orderkey * 10 + l_suppkey % 60 + 30 + CAST(l_quantity AS BIGINT) AS end_pos, 30 + CAST(l_quantity AS BIGINT) AS n, l_linenumber % 3 AS k FROM lineitem) x) y"""
_FASTA = """SELECT concat('ctg', CAST(doc_id AS STRING)) AS chrom,
 regexp_replace(translate(text, 'eioursEIOURS', 'ACGTacACGTAC'), '[^ACGTacgt]', 'N'{g}) AS seq FROM documents"""
_PLAIN = {
    "regions": """SELECT o_orderkey AS rid, concat('chr', CAST(o_custkey % 22 + 1 AS STRING)) AS chrom, o_orderkey * 7 AS start_pos,
 o_orderkey * 7 + o_custkey % 500 AS end_pos, CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand,
 o_custkey % 20 AS bin, concat('g', CAST(o_orderkey % 300 AS STRING)) AS gene_name FROM orders""",
    # sites, short and long intervals, and every chromosome whole
    "mixed": """SELECT o_orderkey AS rid, concat('chr', CAST(o_custkey % 22 + 1 AS STRING)) AS chrom, o_orderkey * 7 AS start_pos,
 o_orderkey * 7 + CASE o_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN o_custkey % 500 WHEN 2 THEN 20000 ELSE 300 + o_custkey % 40 END AS end_pos FROM orders
 UNION ALL SELECT DISTINCT -1 - o_custkey % 22 AS rid, concat('chr', CAST(o_custkey % 22 + 1 AS STRING)) AS chrom, CAST(1 AS BIGINT) AS start_pos, CAST(250000000 AS BIGINT) AS end_pos FROM orders""",
    "cpg_bed": """SELECT DISTINCT concat('chr', CAST(o_custkey % 22 + 1 AS STRING)) AS chrom, o_orderkey * 7 + 1 AS start_pos, o_orderkey * 7 + 3 AS end_pos FROM orders""",
    "cells": """SELECT DISTINCT concat('cell', CAST(p_partkey % 20 AS STRING)) AS barcode, concat('grp', CAST(p_partkey % 20 % 3 AS STRING)) AS grp FROM part""",
    "transcription": """SELECT g.gene_name, c.barcode, CASE WHEN (g.k + c.j) % 3 = 0 THEN 'silent' ELSE 'transcribed' END AS status
 FROM (SELECT DISTINCT concat('g', CAST(o_orderkey % 300 AS STRING)) AS gene_name, o_orderkey % 300 AS k FROM orders) g
 CROSS JOIN (SELECT DISTINCT concat('cell', CAST(p_partkey % 20 AS STRING)) AS barcode, p_partkey % 20 AS j FROM part) c""",
    "fastq": """SELECT event_id AS rec_no, concat('@INST:1:FC:1:', CAST(user_id AS STRING), ':', CAST(event_id AS STRING), ' 1:N:0:',
 translate(substr(event_type, 1, 4), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '+', 'GTAG') AS header,
 translate(event_type, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq, '+' AS plus, repeat('I', length(event_type)) AS qual FROM events""",
    # reads of three files whose qualities differ from read to read
    "scored_reads": """SELECT concat('f', CAST(event_id % 3 AS STRING)) AS file, event_id AS rec_no, translate(event_type, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGNACGTACGTACGTAC') AS seq,
 substr(translate(md5(CAST(event_id AS STRING)), '0123456789abcdef', '!&+05:?BDFGHIJKL'), 1, length(event_type)) AS qual FROM events""",
    "variants": """SELECT concat('chr', CAST(p_size % 22 + 1 AS STRING)) AS chrom, p_partkey * 7 + 1 AS pos, concat('rs', CAST(p_partkey AS STRING)) AS id,
 CASE p_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'G' WHEN 2 THEN 'C' ELSE 'ATG' END AS ref,
 CASE p_size % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'A' ELSE 'G' END AS alt FROM part""",
    # a run's folders: d3 holds two lanes; some files have their short names already, some would take one name
    "listing": """SELECT DISTINCT CASE WHEN user_id % 37 % 4 = 2 THEN 'd0' ELSE concat('d', CAST(user_id % 4 AS STRING)) END AS dir, concat('Smp', CAST(user_id % 37 AS STRING), '-x_',
 CASE WHEN user_id % 37 % 5 = 0 AND event_id % 3 = 0 THEN '' ELSE concat('S', CAST(CASE WHEN user_id % 37 % 3 = 0 THEN event_id % 2 + 1 ELSE 1 END AS STRING), '_L00', CAST(CASE WHEN user_id % 37 % 4 <> 2 AND user_id % 4 = 3 THEN event_id % 2 + 1 ELSE 1 END AS STRING), '_') END,
 CASE event_id % 4 WHEN 0 THEN 'R1' WHEN 1 THEN CASE WHEN user_id % 37 % 6 = 1 THEN 'R1' ELSE 'R2' END WHEN 2 THEN 'I1' ELSE CASE WHEN user_id % 37 % 7 = 3 THEN 'I1' ELSE 'I2' END END, '_001.fastq.gz') AS name FROM events""",
    # two chains over every CpG's neighbourhood; the first has a gap of three bases, one of them in the target
    "chains": """SELECT (start_pos * 64 + CAST(substr(chrom, 4) AS BIGINT)) * 2 + w AS chain, CASE WHEN start_pos % 3 = w THEN 900 ELSE 100 END AS score, chrom, start_pos + lo AS block_start, start_pos + hi AS block_end,
 concat('new', chrom) AS target_chrom, start_pos + 1000 * (w + 1) + lo - skip AS target_start, CASE WHEN (start_pos + w) % 2 = 0 THEN '+' ELSE '-' END AS target_strand, CAST(100000000 AS BIGINT) AS target_size
 FROM (SELECT DISTINCT concat('chr', CAST(o_custkey % 22 + 1 AS STRING)) AS chrom, o_orderkey * 7 + 1 AS start_pos FROM orders) c
 CROSS JOIN (SELECT 0 AS w, -20 AS lo, 1 AS hi, 0 AS skip UNION ALL SELECT 0, 4, 30, 2 UNION ALL SELECT 1, -5, 12, 0) b""",
    "spans": """SELECT chrom, start_pos, start_pos + n AS end_pos, id FROM (SELECT concat('chr', CAST(p_size % 22 + 1 AS STRING)) AS chrom, p_partkey * 7 AS start_pos, 1 + p_size % 30 AS n, concat('s', CAST(p_partkey % 900 AS STRING)) AS id FROM part
 UNION ALL SELECT concat('chr', CAST(p_size % 22 + 1 AS STRING)), p_partkey * 7, 1 + p_size % 30, concat('s', CAST(p_partkey % 900 AS STRING)) FROM part WHERE p_partkey % 5 = 0) x""",
    # calls of three samples: alleles and phases differ
    "genotypes": """SELECT concat('smp', CAST(s AS STRING)) AS sample, chrom, pos, ref, alt1, alt2, CASE WHEN (pos + s) % 7 = 0 THEN './.' WHEN (pos + s) % 3 = 0 THEN '0|1' WHEN alt2 IS NOT NULL THEN '1/2' ELSE '1/1' END AS genotype
 FROM (SELECT concat('chr', CAST(p_size % 22 + 1 AS STRING)) AS chrom, p_partkey * 7 + 1 AS pos, CASE p_partkey % 2 WHEN 0 THEN 'C' ELSE 'G' END AS ref, s, CASE WHEN (p_partkey + s) % 2 = 0 THEN 'T' ELSE 'A' END AS alt1, CASE WHEN (p_partkey + s) % 4 = 1 THEN 'TT' END AS alt2, (p_partkey + s) % 5 AS kept
 FROM part CROSS JOIN (SELECT 1 AS s UNION ALL SELECT 2 UNION ALL SELECT 3) n) x WHERE kept <> 0""",
    # methylation of the CpGs as headerless five-column intervals, some rows without a count
    "beta": """SELECT chrom, pos - 1 AS start_pos, pos + 1 AS end_pos, CASE WHEN pos % 11 = 0 THEN NULL ELSE mc END AS mc, cov FROM ({allc})""",
    # packed names with two, three or four parts
    "packed": """SELECT chrom, pos - 1 AS start_pos, pos AS end_pos, strand, CASE pos % 5 WHEN 0 THEN concat(context, '_', CAST(mc AS STRING))
 WHEN 1 THEN concat(context, '_', CAST(mc AS STRING), '_', CAST(cov AS STRING), '_x') ELSE concat(context, '_', CAST(mc AS STRING), '_', CAST(cov AS STRING)) END AS name FROM ({allc})""",
    # file names of a sequencing run
    "files": """SELECT DISTINCT concat('d', CAST(user_id % 2 AS STRING)) AS dir, concat('Smp', CAST(user_id % 37 AS STRING), '-x_S', CAST(user_id % 37 + 1 AS STRING), '_L00', CAST(event_id % 3 + 1 AS STRING), '_',
 CASE event_id % 5 WHEN 0 THEN 'R1' WHEN 1 THEN 'R2' WHEN 2 THEN 'I1' WHEN 3 THEN 'I2' ELSE 'R1' END, '_001.fastq.gz') AS name FROM events""",
}
_TABLES = {"allc": "lineitem", "reads": "lineitem", "beta": "lineitem", "packed": "lineitem", "regions": "orders", "mixed": "orders", "cpg_bed": "orders", "cells": "part", "variants": "part", "fastq": "events", "scored_reads": "events", "files": "events", "fasta": "documents", "alignments": "lineitem", "listing": "events", "chains": "orders", "spans": "part", "genotypes": "part"}


def _number() -> str:
    return f"CAST(ROW_NUMBER() OVER (ORDER BY {', '.join(ORDER)}) AS BIGINT) AS rec_no"


def duck(name: str) -> str:
    """The view as DuckDB SQL; file order is the column rec_no."""
    if name in ("allc", "reads"):
        return {"allc": _ALLC, "reads": _READS}[name].format(ord=_number())
    if name == "alignments":
        return _ALIGNMENTS.format(ord=_number(), more=", rec_no", quals="list_transform(range(stored), lambda i: CAST(20 + i % 20 AS INTEGER))")
    if name == "fasta":
        return _FASTA.format(g=", 'g'")
    return _PLAIN[name].replace("{allc}", _ALLC.format(ord="0 AS z"))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame; file order is the struct column ord."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    ord_ = f"named_struct({', '.join(f"'{c}', {c}" for c in ORDER)}) AS ord"
    if name in ("allc", "reads"):
        text = {"allc": _ALLC, "reads": _READS}[name].format(ord=ord_)
    elif name == "alignments":
        text = _ALIGNMENTS.format(ord=ord_, more=", ord", quals="transform(sequence(0, CAST(stored AS INT) - 1), i -> 20 + i % 20)")
    elif name == "fasta":
        text = _FASTA.format(g="")
    else:
        text = _PLAIN[name].replace("{allc}", _ALLC.format(ord="0 AS z"))
    tables = ("orders", "part") if name == "transcription" else (_TABLES[name],)
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(text, **{t: read(t) for t in tables})


def cte(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({duck(n)})" for n in names)
