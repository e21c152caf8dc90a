"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from cytoframe.plans import catalog

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
#: Queries that SQL cannot express.
NO_SQL: set[str] = set()
#: Result columns of one value: by the format (flag, plus, strand and context of converted files), by the sheet's
#: defaults, for want of data, or as these tables have it.
CONSTANT = {
    "allc_files": {"flag"}, "bed_to_allc_lenient": {"flag"}, "bed_to_allc_strict": {"flag"}, "beta_to_allc": {"context", "flag", "strand"}, "overlap_semi_filter": {"flag"},
    "fastq_concatenated_records": {"plus"}, "fastq_files_by_barcode": {"plus"}, "fastq_four_way_records": {"plus"}, "tss_jobs": {"bed_path", "range_end", "strand_col"},
    "tss_profile_empty": {"methylation_percentage", "sites_with_data", "total_coverage", "total_methylated"}, "pipeline_region_tables": {"context"},
    "pipeline_region_files": {"context"}, "chain_files": {"target_size"}, "fastq_file_copies": {"plus"},
    "vcf_in_cpg": {"ref"}, "downsample_labels": {"label"}, "fastq_match_counts": {"matched_reads"},
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, columns):
    text = lambda v: "-" if v is None or v != v else f"{v:.10g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    got = plain([r.asDict() for r in df.collect()], columns)
    assert got == plain([dict(zip(want.columns, r)) for r in want.fetchall()], columns)
    if len(got) > 3:  # a column of one value proves little
        assert {c for i, c in enumerate(columns) if len({r[i] for r in got}) == 1} <= CONSTANT.get(name, set())


def test_all_have_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) | NO_SQL


def test_plans_have_every_outcome(spark):
    assert {r["action"] for r in catalog.QUERIES["rename_plan"](spark, SF).collect()} == {"abort", "skip", "rename"}
    lifted = catalog.QUERIES["vcf_lift_over"](spark, SF)
    assert lifted.where("target_chrom IS NULL").count() and lifted.where("target_from < start_pos + 50000").count() and lifted.where("target_from > 50000000").count()
