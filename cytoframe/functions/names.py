"""Names: read ids, barcodes, samples, read types, natural order, Hamming distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def barcode(header: Column) -> Column:
    """Text after the last colon."""
    return F.substring_index(header, ":", -1)


def first_token(header: Column) -> Column:
    """The first token of the header with its @."""
    return F.split(F.trim(header), r"\s+")[0]


def read_id(header: Column) -> Column:
    """The first token without @ and without /1 or /2."""
    return F.regexp_replace(F.split(F.substr(F.trim(header), F.lit(2)), r"\s+")[0], "/[12]$", "")


def sample_id(name: Column) -> Column:
    """A file name without lane, sample number, read type and what follows."""
    out = F.regexp_replace(name, r"_S\d+", "")
    out = F.regexp_replace(out, r"_L\d+", "")
    return F.regexp_replace(F.regexp_replace(out, r"_R[12].*", ""), r"_I[12].*", "")


def read_type(name: Column, precedence: tuple[str, ...] = ("_R1", "_R2", "_I1", "_I2")) -> Column:
    """The first of the given marks that the name contains, without its underscore; null if none."""
    out = F.when(F.lit(False), "")
    for mark in precedence:
        out = out.when(F.contains(name, F.lit(mark)), mark.lstrip("_"))
    return out


def read_part(name: Column) -> Column:
    """The read type that is exactly one of the parts between underscores."""
    return F.get(F.filter(F.split(F.regexp_replace(name, r"\..*$", ""), "_"), lambda p: p.isin("R1", "R2", "I1", "I2")), 0)


def sample_prefix(name: Column) -> Column:
    """Text before the first hyphen; null without one."""
    return F.when(F.instr(name, "-") > 0, F.substring_index(name, "-", 1))


def natural_key(name: Column) -> list[Column]:
    """Sort keys for chr2 before chr10: text before the first number, that number, the name."""
    return [F.regexp_extract(name, r"^(\D*)", 1), F.regexp_extract(name, r"^\D*(\d+)", 1).try_cast("long").asc_nulls_first(), name]


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two texts of one length; null for different lengths."""
    count = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d))
    return F.when(F.length(a) == F.length(b), count)


def million_label(reads: Column) -> Column:
    """Read count in millions, three decimals."""
    return F.format_string("%.3f", reads / F.lit(1e6))


def file_sample(name: Column) -> Column:
    """The sample of a methylation file name."""
    return F.regexp_replace(name, r"\.allc\.tsv(\.gz)?$", "")


def file_barcode(name: Column, context: Column) -> Column:
    """The cell of a methylation file name `cell.context.allc.tsv.gz`."""
    return F.replace(file_sample(name), F.concat(F.lit("."), context), F.lit(""))


def strip_number(name: Column, keep_number: bool = False) -> Column:
    """A file name up to its sample number, or up to its lane."""
    return F.regexp_replace(name, r"_L\d+.*$" if keep_number else r"_S\d+.*$", "")


def first_context(name: Column, contexts: tuple[str, ...]) -> Column:
    """Text before '-' of the first listed context that the name contains; null if none."""
    out = F.when(F.lit(False), "")
    for c in contexts:
        out = out.when(F.contains(name, F.lit(c)), c.split("-")[0])
    return out
