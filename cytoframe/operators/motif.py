"""Sequence motifs and isolation, over chunks of sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

MOTIF = 4  # letters of WCGW


def _letters(seq: str | None) -> np.ndarray:
    return np.frombuffer((seq or "").upper().encode("ascii", "replace"), np.uint8)


def scan(seq: str | None, start: int, length: int, lead: int, distance: int) -> tuple[list, list, list]:
    """Of a chunk's own letters: the starts of WCGW in the sequence, overlapping ones too; their places in chains of
    matches that share a letter, from 0; whether another CpG is within `distance`."""
    s = _letters(seq)
    cg = np.flatnonzero((s[:-1] == 67) & (s[1:] == 71)) if len(s) > 1 else np.zeros(0, int)
    weak = (s == 65) | (s == 84)
    inside = cg[(cg > 0) & (cg + 2 < len(s))]
    at = inside[weak[inside - 1] & weak[inside + 2]]
    near = np.diff(cg) <= distance
    crowd = np.r_[False, near] | np.r_[near, False] if len(cg) else np.zeros(0, bool)
    at = at[(at - 1 >= lead) & (at - 1 < lead + length)]
    alone = ~crowd[np.searchsorted(cg, at)]
    first = at - 1 - lead + start
    new = np.r_[True, np.diff(first) != MOTIF - 1] if len(first) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    turn = np.arange(len(first)) - np.repeat(begin, np.diff(np.append(begin, len(first))))
    return first.tolist(), turn.tolist(), alone.tolist()


def cpgs(chunks: DataFrame, distance: int = 35) -> DataFrame:
    """(chrom, start, end, solo) of the CpGs inside non-overlapping WCGW matches, left to right.

    chunks: rows of `sequences.read_fasta` or `sequences.chunked`, of any length, whose flanks are longer than
    `distance` and hold a motif. solo: no other CpG within `distance` bases. The soft mask (lower case) is ignored.

    A chunk's matches are those that begin in its own letters, so each is found once. Matches overlap only where
    they share their last letter with the next one's first; in such a chain every second one counts, also where it runs
    on over chunks: each chunk gets the length of the chain that reaches it from a window over one row for each chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                found = [scan(seq.as_py(), *(v.as_py() for v in rest), distance) for seq, *rest in zip(*(part.column(c) for c in ("seq", "start", "length", "lead")))]
                cols = [part.column("chrom"), part.column("no"), part.column("start"), *(pa.array(x, kind) for x, kind in zip(zip(*found), (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()))))]
                yield pa.RecordBatch.from_arrays(cols, names=["chrom", "no", "start", "at", "turn", "alone"])

    own = chunks.withColumn("no", F.xxhash64(*[c for c in ("file", "no") if c in chunks.columns], "chrom"))
    found = own.select("chrom", "no", "start", "length", "lead", "seq").mapInArrow(run, "chrom string, no long, start long, at array<long>, turn array<long>, alone array<boolean>").where("size(at) > 0")
    order = Window.partitionBy("no").orderBy("start")
    solid = F.element_at("turn", -1) == F.size("turn") - 1  # all in one chain
    r = found.withColumn("on", F.coalesce(F.get("at", F.lit(0)) - F.lag(F.element_at("at", -1)).over(order) == MOTIF - 1, F.lit(False)))
    r = r.withColumn("group", F.sum(F.when(F.col("on") & solid, 0).otherwise(1)).over(order))
    chain = F.when(F.col("on") & solid, F.size("turn")).otherwise(F.element_at("turn", -1) + 1)
    r = r.withColumn("chain", F.sum(chain).over(Window.partitionBy("no", "group").orderBy("start")))
    r = r.withColumn("before", F.when(F.col("on"), F.lag("chain").over(order)).otherwise(0))
    each = r.select("chrom", "before", F.posexplode(F.arrays_zip("at", "turn", "alone")).alias("i", "m"))
    # a match of the chunk's first chain has its turn equal to its place
    turn = F.col("m.turn") + F.when(F.col("m.turn") == F.col("i"), F.col("before")).otherwise(0)
    return each.where(turn % 2 == 0).select("chrom", (F.col("m.at") + 1).alias("start"), (F.col("m.at") + 3).alias("end"), F.col("m.alone").alias("solo"))


def statistics(chunks: DataFrame, distance: int = 35) -> DataFrame:
    """Per chromosome with a motif, and for 'total': WCGW sites, solo ones and their percentage."""
    g = cpgs(chunks, distance).rollup("chrom").agg(F.count("*").alias("wcgw"), F.count_if("solo").alias("solo"))
    return g.select(F.coalesce("chrom", F.lit("total")).alias("chrom"), "wcgw", "solo", (F.try_divide("solo", "wcgw") * 100).alias("pct"))
