"""Qualities of reads by position, and depth of aligned bases by segment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.folders import written

BASES = "ACGTN"
OPERATIONS, ALIGNED, ON_REFERENCE, ON_READ = ([ord(x) for x in letters] for letters in ("MIDNSHP=X", "M=X", "MDN=X", "MIS=X"))
BIN = 1 << 14  # positions whose depths are summed up together


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, the row of each byte and its place in the row."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    return data, np.repeat(np.arange(len(texts)), size), np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], size)


def position_counts(fastq: DataFrame, offset: int = 33) -> DataFrame:
    """(file, position from 1, kind, value, n): how often each quality (kind q) and base (kind b, a place in BASES, other
    letters as N) stands at a position of a file's reads. Rows need file, seq and qual; a null one has no positions.

    Tasks count whole batches by array arithmetic and give one row for each value met, so that what is shuffled grows with
    positions and values, not with bases.
    """
    letter = np.full(256, len(BASES) - 1)
    for k, b in enumerate(BASES):
        letter[[ord(b), ord(b.lower())]] = k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(0).dictionary_encode()
            of = files.indices.to_numpy(zero_copy_only=False)
            parts = []
            for kind, column, value in ((0, 1, lambda x: letter[x]), (1, 2, lambda x: x.astype(int) - offset)):
                data, row, place = _bytes(batch.column(column).fill_null(""))
                if not len(data):
                    continue
                key = np.stack([of[row], place, np.full(len(data), kind), value(data)])
                span = key.max(axis=1) + 1 - (low := key.min(axis=1))
                met, n = np.unique(np.ravel_multi_index(key - low[:, None], span), return_counts=True)
                parts.append((*(x + k for x, k in zip(np.unravel_index(met, span), low)), n))
            if parts:
                f, place, kind, value, n = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([files.dictionary.take(pa.array(f)), pa.array(place + 1), pa.array(np.where(kind == 0, "b", "q")), pa.array(value), pa.array(n)], names=["file", "position", "kind", "value", "n"])

    rows = fastq.where("file IS NOT NULL").select("file", "seq", "qual").mapInArrow(run, "file string, position long, kind string, value long, n long")
    return rows.groupBy("file", "position", "kind", "value").agg(F.sum("n").alias("n"))


def position_quality(fastq: DataFrame, offset: int = 33) -> DataFrame:
    """(file, position, reads, mean, q1, median, q3, a, c, g, t, n): of the reads of each file, by position from 1, the
    mean and the quartiles of the qualities and the shares of the bases.

    A quartile is the smallest quality that a quarter (half, three quarters) of the reads do not exceed, read from
    the counts of `position_counts`. Shares are null where no base stands, qualities where there are none.
    """
    counts = position_counts(fastq, offset)
    upto = Window.partitionBy("file", "position", "kind").orderBy("value")
    counts = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("file", "position", "kind")))
    q, b = F.col("kind") == "q", F.col("kind") == "b"
    quartile = lambda part: F.min(F.when(q & (F.col("upto") >= part * F.col("all")), F.col("value")))
    base = lambda k: F.try_divide(F.coalesce(F.sum(F.when(b & (F.col("value") == k), F.col("n"))), F.lit(0)), F.sum(F.when(b, F.col("n"))))
    return counts.groupBy("file", "position").agg(
        F.greatest(F.max(F.when(b, F.col("all"))), F.max(F.when(q, F.col("all")))).alias("reads"), F.try_divide(F.sum(F.when(q, F.col("value") * F.col("n"))), F.sum(F.when(q, F.col("n")))).alias("mean"),
        quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"), *[base(k).alias(x.lower()) for k, x in enumerate(BASES)],
    )


def _operations(cigars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length and letter of all operations of all CIGAR texts, in order; other characters are passed over."""
    text = np.frombuffer("".join(f"{c}\n" for c in cigars.to_pylist()).encode(), np.uint8)
    other = np.flatnonzero((text < ord("0")) | (text > ord("9")))
    digit = np.flatnonzero((text >= ord("0")) & (text <= ord("9")))
    ends = np.searchsorted(other, digit)  # what ends each digit's number
    n = np.zeros(len(other), np.int64)
    np.add.at(n, ends, (text[digit] - ord("0")).astype(np.int64) * 10 ** (other[ends] - digit - 1))
    letter = text[other]
    row = np.cumsum(letter == ord("\n"))
    known = np.isin(letter, OPERATIONS)
    return row[known], n[known], letter[known]


def _starts(n: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The sum of the row's earlier `n`, for each place; rows come in order."""
    upto = np.cumsum(n) - n
    return upto - upto[np.searchsorted(row, row)]


def covered_runs(start: np.ndarray, cigars: pa.Array, quals: pa.ListArray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to): the runs [from, to) of reference positions where an aligned base of a row's read has a quality of
    `least` or more, by array arithmetic over all rows."""
    row, n, op = _operations(cigars)
    at = start[row] + _starts(np.where(np.isin(op, ON_REFERENCE), n, 0), row)
    q = _starts(np.where(np.isin(op, ON_READ), n, 0), row)
    offsets = quals.offsets.to_numpy().astype(np.int64)
    size = np.where(quals.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
    aligned = np.isin(op, ALIGNED)
    row, at, q = row[aligned], at[aligned], q[aligned]
    n = np.clip(size[row] - q, 0, n[aligned])  # bases without a quality don't count
    first = np.cumsum(n + 1) - (n + 1)  # a bad base after each operation keeps their runs apart
    good = np.zeros(int((n + 1).sum()) + 1, np.int8)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    values = quals.values.fill_null(-(1 << 31)).to_numpy(zero_copy_only=False)
    good[np.repeat(first + 1, n) + place] = values[np.repeat(offsets[row] + q, n) + place] >= least
    edge = np.flatnonzero(np.diff(good))
    of = np.searchsorted(first, edge[::2], "right") - 1
    return row[of], at[of] + edge[::2] - first[of], at[of] + edge[1::2] - first[of]


def base_depth(alignments: DataFrame, least_quality: int = 30, least_depth: int = 2, bin_size: int = BIN) -> DataFrame:
    """(ref_id, start, end, depth): segments (0-based half-open) of one depth of at least `least_depth`, where the depth
    is the number of mapped reads with an aligned base of `least_quality` or more.

    A read gives +1 and -1 at the ends of its runs of such bases, so no base becomes a row. Tasks add them up by position
    in each batch, then by bin; depths are running sums within bins, written once, to which each bin adds what the bins
    before it leave open, a window over one row for each bin with an event. Reads need ref_id, flag, start_pos, cigar and
    quals; those without a cigar or place give nothing.
    """
    kind = alignments.schema["ref_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs = batch.column(0).dictionary_encode()
            row, low, high = covered_runs(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(2), batch.column(3), least_quality)
            if not len(row):
                continue
            ref, pos = np.tile(refs.indices.to_numpy(zero_copy_only=False)[row], 2), np.concatenate([low, high])
            order = np.lexsort((pos, ref))
            ref, pos, step = ref[order], pos[order], np.repeat([1, -1], len(row))[order]
            new = np.flatnonzero(np.concatenate([[True], (ref[1:] != ref[:-1]) | (pos[1:] != pos[:-1])]))
            step = np.add.reduceat(step, new)
            new, step = new[step != 0], step[step != 0]
            yield pa.RecordBatch.from_arrays([refs.dictionary.take(pa.array(ref[new])), pa.array(pos[new]), pa.array(step)], names=["ref_id", "pos", "step"])

    mapped = alignments.where("flag & 4 = 0 AND start_pos IS NOT NULL AND cigar IS NOT NULL AND ref_id IS NOT NULL")
    events = mapped.select("ref_id", "start_pos", "cigar", "quals").mapInArrow(run, f"ref_id {kind}, pos long, step long")
    events = events.withColumn("bin", F.floor(F.col("pos") / bin_size)).repartition("ref_id", "bin")
    events = events.groupBy("ref_id", "bin", "pos").agg(F.sum("step").alias("step")).where("step <> 0")
    in_bin = Window.partitionBy("ref_id", "bin").orderBy("pos")
    rows = written(events.withColumn("own", F.sum("step").over(in_bin)).withColumn("end", F.lead("pos").over(in_bin)), "depth")
    by_bin = Window.partitionBy("ref_id").orderBy("bin")
    bins = rows.groupBy("ref_id", "bin").agg(F.sum("step").alias("total"), F.min("pos").alias("first"))
    bins = bins.select("ref_id", "bin", F.coalesce(F.sum("total").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("open"), F.lead("first").over(by_bin).alias("next"))
    out = rows.join(bins, ["ref_id", "bin"])
    return out.select("ref_id", F.col("pos").alias("start"), F.coalesce("end", "next").alias("end"), (F.col("own") + F.col("open")).alias("depth")).where(F.col("depth") >= least_depth)
