"""FASTQ, FASTA, alignment and variant files.

Text formats are read as lines by Spark itself: plain files are cut into splits, gzip files are one split that is
inflated as a stream. Lines are numbered by file and split without a sort, and records are put together by a
shuffle, whatever the size of a file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.names import natural_key

READ = "file string, rec_no long, qname string, flag int, ref_id int, ref_name string, start_pos long, end_pos long, cigar string, seq string, quals array<int>, tags map<string,string>, mapq int, mate_ref_name string, mate_pos long, template_length long"
BGZF_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
RUN = 4096  # lines whose offsets are added up together
OPS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "content")


def inflated(raw: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, piece by piece; zlib.error where it is damaged, EOFError
    where it is cut off."""
    at, z = 0, zlib.decompressobj(31)
    while at < len(raw):
        yield z.decompress(raw[at : at + step])
        at += step
        while z.eof and (z.unused_data or at < len(raw)):
            rest = z.unused_data
            z = zlib.decompressobj(31)
            if rest:
                yield z.decompress(rest)
            else:
                break
    if not z.eof:
        raise EOFError("the file ends inside a member")


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line_no from 0, value) of the lines of text files; nothing is sorted or shuffled but one row for each block.

    A block is a split of a file, or a whole gzip file. Its lines are read in order by one task and their running
    ids follow each other, so a line's number is its id less the block's smallest, plus the lines of the file's earlier
    blocks. That table is broadcast: some 40 bytes for each split (128 MB by Spark's default) of the input.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("m"), F.min("_id").alias("first"))
    shifts = blocks.select(F.xxhash64("file", "block").alias("_key"), (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first")).alias("_shift"))
    rows = lines.withColumn("_key", F.xxhash64("file", "block")).join(F.broadcast(shifts), "_key")
    return rows.select("file", (F.col("_id") + F.col("_shift")).alias("line_no"), "value")


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row for each four-line record with its number in the file; a truncated last record is kept as it is."""
    lines = numbered_lines(spark, paths).withColumn("rec_no", F.floor(F.col("line_no") / 4)).withColumn("k", F.col("line_no") % 4)
    part = lambda k, name: F.max(F.when(F.col("k") == k, F.col("value"))).alias(name)
    return lines.groupBy("file", "rec_no").agg(part(0, "header"), part(1, "seq"), part(2, "plus"), part(3, "qual"))


def write_fastq(fastq: DataFrame, path: str, compress: bool = True, partition_by: tuple[str, ...] = ()) -> None:
    """Four lines a record, in the frame's order; one folder for each value of `partition_by`."""
    text = fastq.select(*partition_by, F.concat_ws("\n", "header", "seq", "plus", "qual").alias("value"))
    writer = text.write.option("compression", "gzip" if compress else "none")
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def read_fasta(spark: SparkSession, paths: str | list[str], chunk: int = 1 << 20, flank: int = 64) -> DataFrame:
    """Sequences in chunks: (file, no, chrom, start, length, lead, seq); the name is the first token after '>'.

    A chunk owns `length` letters from `start` (0-based) on, `chunk` of them but in the last; `seq` holds them with up to
    `flank` letters (`lead` of them on the left) of its neighbours, so that motifs over its ends are seen whole. `no` counts
    the file's sequences. A sequence without letters is one chunk without any; lines before the first header are passed over.

    Lines get their offset by `in_sections`. They go to the chunks that they touch, so that no row is longer than a chunk with
    its flanks, or a line of the file.
    """
    head = F.startswith("value", F.lit(">"))
    name = F.coalesce(F.get(F.split(F.trim(F.substr("value", F.lit(2))), r"\s+"), F.lit(0)), F.lit(""))
    lines = numbered_lines(spark, paths).select("file", "line_no", F.when(head, name).alias("chrom"), F.when(head, "").otherwise(F.regexp_replace("value", r"\s+", "")).alias("s"))
    return _chunked(in_sections(lines, "chrom", {"at": F.length("s")}), ["file", "no", "chrom"], chunk, flank)


def in_sections(lines: DataFrame, head: str, sums: dict[str, Column]) -> DataFrame:
    """The lines (file, line_no, ...) of sections, each of which begins at a line whose column `head` is not null: with the
    file's number of the section (no, from 1), its head, and for each of `sums` the sum over the section's lines before.

    This takes two steps: within runs of RUN lines, and over one row for each run, which tells what the runs before it
    carry into its lines before its first head. Lines before a file's first head are left out.
    """
    rows = lines.withColumn("run", F.floor(F.col("line_no") / RUN))
    upto = Window.partitionBy("file", "run").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("heads", F.count(head).over(upto)).withColumn(head, F.last(head, True).over(upto))
    within = Window.partitionBy("file", "run", "heads").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", *[c.alias(f"_of_{k}") for k, c in sums.items()], *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(k) for k, c in sums.items()])
    ends = [(F.col(k) + F.coalesce(F.col(f"_of_{k}"), F.lit(0))).alias(k) for k in sums]
    runs = rows.groupBy("file", "run").agg(F.max_by(F.struct("heads", head, *ends), "line_no").alias("l")).select("file", "run", "l.*")
    in_file = Window.partitionBy("file").orderBy("run")
    runs = runs.withColumn("no", F.sum("heads").over(in_file))
    runs = runs.select("file", "run", "no", head, *[F.sum(k).over(Window.partitionBy("file", "no").orderBy("run")).alias(k) for k in sums])
    carried = [F.lag(c).over(in_file).alias(f"_{c}") for c in ("no", *sums)]
    runs = runs.select("file", "run", *carried, F.last(head, True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_head"))
    sofar = lambda k: F.col(k) + F.when(F.col("heads") == 0, F.coalesce(f"_{k}", F.lit(0))).otherwise(0)
    rest = [c for c in lines.columns if c not in ("file", head)]
    out = rows.join(runs, ["file", "run"]).select("file", (F.coalesce("_no", F.lit(0)) + F.col("heads")).alias("no"), F.coalesce(head, "_head").alias(head), *rest, *[sofar(k).alias(k) for k in sums])
    return out.where("no > 0")


def _chunked(pieces: DataFrame, by: list[str], chunk: int, flank: int) -> DataFrame:
    """Pieces of sequences (by, at, s) put together by chunk. A piece goes to every chunk whose letters or flanks it has."""
    end = F.col("at") + F.length("s")
    low = F.greatest(F.floor((F.col("at") - flank) / chunk), F.lit(0))
    owner = F.explode(F.sequence(low, F.greatest(F.floor((end - 1 + flank) / chunk), low))).alias("k")
    own = pieces.select(*by, "at", "s", owner).withColumn("start", F.col("k") * chunk)
    first = F.greatest(F.col("start") - flank - F.col("at"), F.lit(0))
    past = F.least(F.col("start") + chunk + flank - F.col("at"), F.length("s").cast("long"))
    own = own.withColumn("from", F.col("at") + first).withColumn("part", F.substr("s", (first + 1).cast("int"), F.greatest(past - first, F.lit(0)).cast("int")))
    owned = F.least(F.col("from") + F.length("part"), F.col("start") + chunk) - F.greatest("from", "start")
    g = own.groupBy(*by, "k", "start").agg(
        F.array_sort(F.collect_list(F.when(F.length("part") > 0, F.struct("from", "part")))).alias("parts"), F.sum(F.greatest(owned, F.lit(0))).alias("length"),
    )
    lead = F.coalesce(F.col("start") - F.get("parts", F.lit(0))["from"], F.lit(0))
    g = g.where("length > 0 OR k = 0").select(*by, "start", "length", F.greatest(lead, F.lit(0)).alias("lead"), F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("seq"))
    return g


def chunked(sequences: DataFrame, chunk: int = 1 << 20, flank: int = 64) -> DataFrame:
    """Chunks, as `read_fasta` gives them but for the file, of sequences that are rows (chrom, seq); null sequences have none."""
    return _chunked(sequences.where("seq IS NOT NULL").select(F.monotonically_increasing_id().alias("no"), "chrom", F.lit(0).cast("long").alias("at"), F.col("seq").alias("s")), ["no", "chrom"], chunk, flank)


def whole_sequences(chunks: DataFrame, by: tuple[str, ...] = ("file", "no", "chrom")) -> DataFrame:
    """(chrom, seq): chunks put together again, a sequence a row; for sequences that fit one."""
    own = F.struct("start", F.substr("seq", (F.col("lead") + 1).cast("int"), F.col("length").cast("int")).alias("s"))
    g = chunks.groupBy(*by).agg(F.array_sort(F.collect_list(own)).alias("parts"))
    return g.select("chrom", F.array_join(F.transform("parts", lambda p: p["s"]), "").alias("seq"))


def write_fasta(fasta: DataFrame, path: str, width: int = 60) -> None:
    """Sequences as lines of `width` letters under their names."""
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    fasta.select(F.concat_ws("\n", F.concat(F.lit(">"), "chrom"), F.when(F.length("seq") > 0, wrapped)).alias("value")).write.text(path)


def reference_length(cigar: list[tuple[int, int]]) -> int:
    return sum(n for n, op in cigar if op in (0, 2, 3, 7, 8))


def decode_tags(raw: bytes) -> dict[str, str]:
    """Auxiliary fields as text; arrays are passed over."""
    out, at = {}, 0
    sizes = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
    while at + 3 <= len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(0, at)
            out[name], at = raw[at:end].decode(), end + 1
        elif kind == "B":
            sub, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            at += 5 + n * struct.calcsize(sizes[sub])
        else:
            value = struct.unpack_from("<" + sizes[kind], raw, at)[0]
            out[name] = value.decode() if kind == "A" else str(value)
            at += struct.calcsize(sizes[kind])
    return out


def decode_bam(path: str, pieces: Iterator[bytes]) -> Iterator[tuple]:
    """Records of a BAM file in file order (see READ), from its inflated pieces; one record is held at a time."""
    held = bytearray()

    def take(n: int) -> bytes:
        while len(held) < n:
            held.extend(next(pieces))
        out = bytes(held[:n])
        del held[:n]
        return out

    number = lambda: struct.unpack("<i", take(4))[0]
    if take(4) != b"BAM\x01":
        raise ValueError(f"{path}: no BAM file")
    take(number())
    refs = []
    for _ in range(number()):
        refs.append(take(number())[:-1].decode())
        number()
    rec = 0
    while True:
        try:
            data = take(number())
        except StopIteration:
            return
        ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, mate, mate_pos, span = struct.unpack_from("<iiBBHHHiiii", data)
        p = 32
        name = data[p : p + l_name - 1].decode()
        p += l_name
        cigar = [(x >> 4, x & 15) for x in struct.unpack_from(f"<{n_cigar}I", data, p)]
        p += 4 * n_cigar
        packed = data[p : p + (l_seq + 1) // 2]
        seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:l_seq]
        p += (l_seq + 1) // 2
        quals = list(data[p : p + l_seq])
        own = lambda i: refs[i] if i >= 0 else None
        yield (path, rec, name, flag, ref, own(ref), pos, pos + reference_length(cigar) if ref >= 0 else None, "".join(f"{n}{OPS[o]}" for n, o in cigar) or None, seq, quals, decode_tags(data[p + l_seq :]), mapq, own(mate), mate_pos, span)
        rec += 1


def read_bam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Alignments of BAM files, a file a task; positions are 0-based half-open. A file's compressed bytes come as one
    row, so it is below 2 GiB; larger ones are to be converted to SAM text, which `read_sam` reads in splits."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in READ.split(", ")]
        for batch in batches:
            for path, raw in zip(batch["path"], batch["content"]):
                rows = []
                for row in decode_bam(path, inflated(raw)):
                    rows.append(row)
                    if len(rows) == 5000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return _files(spark, paths).mapInPandas(parse, READ)


def quality_text(quals: pa.Array) -> pa.Array:
    """Phred values as text, a character of the value plus 33 (its low byte) each; null and lower values give none."""
    n = pc.fill_null(pc.list_value_length(quals), 0).to_numpy(zero_copy_only=False)
    flat = quals.flatten()
    code = pc.fill_null(flat, -34).to_numpy(zero_copy_only=False).astype(np.int64) + 33
    kept, low = code >= 0, code.astype(np.uint8)
    ends = np.concatenate(([0], np.cumsum(np.where(kept, 1 + (low > 127), 0))))[np.concatenate(([0], np.cumsum(n)))]
    text = low[kept].tobytes().decode("latin-1").encode()
    out = pa.LargeStringArray.from_buffers(len(quals), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text))
    return pc.if_else(quals.is_valid(), out, None).cast(pa.string())


def quality_values(text: pa.Array) -> pa.Array:
    """The code points of texts less 33; a null text is null."""
    raw = pc.fill_null(text, "").cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    code = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    ends = at - at[0]
    if (code > 127).any():
        texts = [t.decode("utf-8", "replace") for t in raw.to_pylist()]
        code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        ends = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code.astype(np.int32) - 33), mask=pc.is_null(text))


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The columns of READ from SAM text, by DataFrame functions, qualities by array arithmetic; rec_no counts the file's
    alignment lines."""
    lines = numbered_lines(spark, paths).where("value != '' AND NOT startswith(value, '@')")
    rows = lines.select("file", "line_no", F.split("value", "\t").alias("c")).where(F.size("c") >= 11)
    c = lambda i: F.nullif(F.col("c")[i], F.lit("*"))
    length = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.select(
        "file", "line_no", F.col("c")[0].alias("qname"), F.col("c")[1].cast("int").alias("flag"), c(2).alias("ref_name"), (F.col("c")[3].cast("long") - 1).alias("start_pos"), F.col("c")[4].cast("int").alias("mapq"),
        c(5).alias("cigar"), F.when(F.col("c")[6] == "=", c(2)).otherwise(c(6)).alias("mate_ref_name"), (F.col("c")[7].cast("long") - 1).alias("mate_pos"), F.col("c")[8].cast("long").alias("template_length"),
        c(9).alias("seq"), F.arrow_udf(quality_values, "array<int>")(c(10)).alias("quals"),
        F.map_from_entries(F.transform(F.filter(F.slice("c", 12, 10_000), lambda t: ~F.contains(t, F.lit(":B:"))), lambda t: F.struct(F.substr(t, F.lit(1), F.lit(2)), F.substr(t, F.lit(6))))).alias("tags"),
    )
    ends = F.when(F.col("ref_name").isNotNull() & F.col("cigar").isNotNull(), F.col("start_pos") + length)
    return rows.withColumn("end_pos", ends).withColumn("rec_no", F.col("line_no")).drop("line_no")


def integrity(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, gzip_ok, bam_ok): the whole file inflates, piece by piece; a BAM file has its magic and its end marker.
    Files are below 2 GiB, as Spark gives their bytes as one row."""

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, raw in zip(batch["path"], batch["content"]):
                first, ok = b"", True
                try:
                    for piece in inflated(raw):
                        first = first if len(first) > 3 else first + piece[:4]
                except (EOFError, zlib.error):
                    ok = False
                ok = ok and len(raw) > 0
                rows.append((path, ok, ok and first[:4] == b"BAM\x01" and raw.endswith(BGZF_END)))
            yield pd.DataFrame(rows, columns=["path", "gzip_ok", "bam_ok"])

    return _files(spark, paths).mapInPandas(test, "path string, gzip_ok boolean, bam_ok boolean")


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """chrom, pos, id, ref, alt, qual, filter, info (map), file, format and the sample columns (array) of the records;
    see `vcf_samples` and `genotypes`."""
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value").where("value != '' AND NOT startswith(value, '#')")
    rows = rows.select("file", F.split("value", "\t").alias("c")).where(F.size("c") >= 8)
    at = lambda i: F.nullif(F.col("c")[i], F.lit("."))
    return rows.select(
        F.col("c")[0].alias("chrom"), F.col("c")[1].cast("long").alias("pos"), at(2).alias("id"), F.col("c")[3].alias("ref"), F.split(F.col("c")[4], ",").alias("alt"),
        at(5).try_cast("double").alias("qual"), at(6).alias("filter"), F.str_to_map(F.coalesce(at(7), F.lit("")), F.lit(";"), F.lit("=")).alias("info"),
        "file", F.get("c", F.lit(8)).alias("format"), F.slice("c", 10, 1 << 20).alias("sample_values"),
    )


def vcf_samples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, samples): the sample names of each file's header line."""
    head = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value").where("startswith(value, '#CHROM')")
    return head.select("file", F.slice(F.split("value", "\t"), 10, 1 << 20).alias("samples"))


def genotypes(variants: DataFrame, samples: DataFrame | list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """(sample, chrom, pos, ref, alts, genotype): a row for each record and sample, for `variants.merge_genotypes`.

    samples: the names of each file (see `vcf_samples`), or those of all files. `rename` gives samples new names.
    """
    if isinstance(samples, DataFrame):
        rows = variants.join(samples, "file")
    else:
        rows = variants.withColumn("samples", F.array(*map(F.lit, samples)))
    each = F.explode(F.arrays_zip(F.col("samples").alias("s"), F.col("sample_values").alias("v"))).alias("e")
    at = F.array_position(F.split("format", ":"), "GT").cast("int")
    out = rows.select("chrom", "pos", "ref", F.col("alt").alias("alts"), at.alias("at"), each).where("at > 0")
    name = F.col("e.s")
    for old, new in (rename or {}).items():
        name = F.when(F.col("e.s") == old, F.lit(new)).otherwise(name)
    return out.select(name.alias("sample"), "chrom", "pos", "ref", "alts", F.coalesce(F.get(F.split("e.v", ":"), F.col("at") - 1), F.lit("./.")).alias("genotype"))


def write_vcf(variants: DataFrame, path: str, header: list[str], samples: dict[str, str] | None = None) -> None:
    """Records (chrom, pos, id, ref, alt; qual, filter, info, format and sample columns where present) as VCF text in natural order.

    `header` holds the ## lines. samples: new names by sample column. The header sorts before all records, so
    the part files, in the order of their names, are one VCF file.
    """
    have, samples = dict(variants.dtypes), samples or {}

    def cell(name: str):
        if name not in have:
            return F.lit(".")
        c = F.col(name)
        if have[name].startswith("map"):
            c = F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
        elif have[name].startswith("array"):
            c = F.array_join(c, ",")
        return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("."))

    fixed = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"]
    more = ["format", *samples] if samples else []
    title = "#" + "\t".join([*(c.upper() for c in fixed), *(["FORMAT", *samples.values()] if samples else [])])
    rows = variants.select(F.lit(len(header) + 1).alias("line"), "chrom", "pos", F.concat_ws("\t", *map(cell, fixed + more)).alias("value"))
    head = variants.sparkSession.createDataFrame(list(enumerate([*header, title])), "line int, value string")
    every = rows.unionByName(head, allowMissingColumns=True)
    every.orderBy("line", *natural_key(F.col("chrom")), "pos", "value").select("value").write.text(path)


def write_sam(reads: DataFrame, path: str, header: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> None:
    """Alignments as SAM text after the header's lines, sorted by reference and start; one folder, with the header
    in each, for each value of `partition_by`. Columns of READ that are absent take their neutral values."""
    have = set(reads.columns)
    col = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit(other)) if c in have else F.lit(other)
    plus = lambda c: (F.coalesce(F.col(c), F.lit(-1)) + 1).cast("string") if c in have else F.lit("0")
    quals = F.arrow_udf(quality_text, "string")("quals")
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda t: F.concat(t["key"], F.lit(":Z:"), t["value"])), "\t") if "tags" in have else F.lit(None).cast("string")
    line = F.concat_ws(
        "\t", "qname", F.col("flag").cast("string"), col("ref_name", "*"), plus("start_pos"), col("mapq", "255"), col("cigar", "*"), col("mate_ref_name", "*"), plus("mate_pos"),
        col("template_length", "0"), col("seq", "*"), F.coalesce(F.nullif(quals, F.lit("")), F.lit("*")), F.nullif(tags, F.lit("")),
    )
    rows = reads.select(*partition_by, F.lit(len(header)).alias("_h"), "ref_id", "start_pos", *[c for c in ("rec_no",) if c in have], line.alias("value"))
    if header:
        top = reads.sparkSession.createDataFrame(list(enumerate(header)), "_h int, value string")
        if partition_by:
            top = rows.select(*partition_by).distinct().join(top, F.lit(True))  # one row for each output and header line
        rows = rows.unionByName(top, allowMissingColumns=True)
    order = rows.orderBy(*partition_by, "_h", "ref_id", "start_pos", *[c for c in ("rec_no",) if c in have], "value").select(*partition_by, "value")
    (order.write.partitionBy(*partition_by) if partition_by else order.write).text(path)
