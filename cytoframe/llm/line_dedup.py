"""Lines that many documents repeat: found in sorted ranges of their hashes, dropped by bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, StringType

from .common import Scratch

BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
DROP, OPEN, EDGE = 0, 1, 2
REMEMBERED = 100_000  # rows that a task knows again


def long_lines(text: bytes, least: int) -> tuple[int, dict[bytes, list[int]]]:
    """The number of lines, and the places of each key of `least` code points or more, by its 128-bit hash."""
    lines, places = text.split(b"\n"), {}
    for k, line in enumerate(lines):
        if len(line) >= least:
            key = line.strip(BLANK)
            if len(key) >= least and (key.isascii() or len(key.decode()) >= least):
                places.setdefault(xxhash.xxh3_128_digest(key.translate(LOWER)), []).append(k)
    return len(lines), places


def _keys(docs: DataFrame, least: int, kind: str) -> DataFrame:
    """A row for each (document, key): the hash in two halves, the document, its lines and the places among them."""
    names = ["h1", "h2", "id", "mark", "lines", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, hashes, lines, places = [], [], [], []
                for k, (key, mark, text) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())):
                    if (key, mark) in known:  # the same row again
                        continue
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known.add((key, mark))
                    n, found = long_lines(text, least)
                    row += [k] * len(found)
                    hashes += found
                    lines += [n] * len(found)
                    places += found.values()
                h = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), part.column(0).take(take), part.column(2).take(take), pa.array(lines, pa.int32()), pa.array(places, pa.list_(pa.int32()))], names=names)

    return docs.select("id", "text", "mark").mapInArrow(run, f"h1 long, h2 long, id {kind}, mark long, lines int, places array<int>")


def _differs(a: pa.Array) -> np.ndarray:
    """Whether each value but the first is another than the one before it; nulls are equal."""
    null = np.asarray(a.is_null())
    unlike = np.asarray(pc.fill_null(pc.not_equal(a[1:], a[:-1]), False))
    return unlike | (null[1:] != null[:-1])


def _stream(least_docs: int):
    """Over a partition sorted by key and falling document: the first document of a key keeps its lines, those after it
    lose them once `least_docs` documents are met. What the partition's first and last key decide only together
    with the partitions beside it comes out as open, with a count and the first document of each of these two."""
    names = ["kind", "h1", "h2", "id", "mark", "lines", "places", "n"]

    def rows(t: pa.Table, kind: int) -> pa.Table:
        return pa.table([pa.array(np.full(len(t), kind, np.int32)), *t.columns, pa.nulls(len(t), pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before this batch
        number = 0  # of its document among those of its key
        first_run, head, held = True, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            with_last = pa.concat_tables([last, t]) if last is not None else t
            h1, h2 = (with_last.column(c).to_numpy() for c in ("h1", "h2"))
            ids, marks = with_last.column("id").combine_chunks(), with_last.column("mark").to_numpy()
            other = np.concatenate([[True] * (last is None), (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]).astype(bool)
            turn = other | np.concatenate([[True] * (last is None), _differs(ids)]).astype(bool)  # another document
            again = ~turn & ~np.concatenate([[True] * (last is None), marks[1:] != marks[:-1]]).astype(bool)  # the same row
            run_of, total = np.cumsum(other), np.cumsum(turn)  # run 0 goes on from the batch before
            base = np.concatenate([[-number], total[other] - 1])
            nth = total - base[run_of]
            most = np.zeros(len(base), np.int64)
            most[0] = number
            np.maximum.at(most, run_of, nth)
            fresh = ~again
            opened = first_run & (run_of == (1 if last is None else 0))
            surely = ~opened & fresh & (nth >= 2) & (most[run_of] >= least_docs)
            ended = run_of < run_of[-1]
            if held and (most[0] >= least_docs or len(base) > 1):
                if most[0] >= least_docs:
                    yield from (rows(x, DROP) for x in held)
                held = []
            if surely.any():
                yield rows(t.filter(pa.array(surely)), DROP)
            if (opened & fresh).any():
                yield rows(t.filter(pa.array(opened & fresh)), OPEN)
            waits = ~opened & fresh & (nth >= 2) & ~surely & ~ended
            if waits.any():
                held.append(t.filter(pa.array(waits)))
            starts = np.flatnonzero(other)
            if first_run and (len(starts) > 1 or last is not None and len(starts)):  # the partition's first key has ended
                top = head if last is not None else t.slice(0, 1)
                yield edge(top, int(most[0] if last is not None else most[1]))
                first_run = False
            if len(starts):
                head = t.slice(int(starts[-1]), 1)
            last, number = t.slice(len(t) - 1, 1), int(nth[-1])
        if last is not None:
            yield edge(head, number)
            yield from (rows(x, OPEN) for x in held)

    def edge(row: pa.Table, n: int) -> pa.Table:
        return pa.table([pa.array([EDGE], pa.int32()), *row.columns, pa.array([n], pa.int64())], names=names)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in run(parts):
            yield from t.combine_chunks().to_batches()

    return batches


@arrow_udf(BinaryType())
def keep_bitmap(places: pa.Array, lines: pa.Array) -> pa.Array:
    """A bit for each line, first line first, 1 where it stays; deflated."""
    out = []
    for drop, n in zip(places.to_pylist(), lines.to_pylist()):
        bits = np.ones(n, np.uint8)
        bits[drop] = 0
        out.append(zlib.compress(np.packbits(bits).tobytes(), 6))
    return pa.array(out, pa.binary())


@arrow_udf(StringType())
def _kept(text: pa.Array, keep: pa.Array) -> pa.Array:
    out = []
    for t, k in zip(text.cast(pa.binary()).to_pylist(), keep.to_pylist()):
        if t is None or k is None:
            out.append(None)
            continue
        lines = t.split(b"\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(k), np.uint8), count=len(lines))
        out.append(b"\n".join([line for line, bit in zip(lines, bits.tolist()) if bit]))
    return pa.array(out, pa.binary()).cast(pa.string())


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that `keep` leaves of a text; without a bitmap all. Whole texts do not go to Python."""
    return F.when(keep.isNull(), text).otherwise(_kept(F.when(keep.isNotNull(), text), keep))


def repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, carry: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_lines, n_dropped and `keep`, a deflated bitmap of the lines that stay (null: all), and the columns of `carry`.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least `least_chars` code points
    found in at least `least_docs` documents lose their lines everywhere but in the largest id. Null and empty texts
    are one empty line. Rows that share an id are one document, and null ids together are the smallest document; each row
    keeps a bitmap of its own, repeated rows the same one. Texts of any length are read whole; an empty table gives none.

    Hashes of keys (128 bits) are range-partitioned together with the document, so that a key that a third of all documents
    hold is cut into many ranges. A range is streamed in order. Only its first and last key may go on in the ranges beside
    it: these are decided by the two counts that each range gives, the only thing that is broadcast.
    """
    spark = docs.sparkSession
    parts, kind = int(spark.conf.get("spark.sql.shuffle.partitions")), docs.schema[id_col].dataType.simpleString()
    taken = F.struct(*[docs[c].alias(c) for c in carry]) if carry else F.lit(None).cast("int")
    base = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), taken.alias("carry")).withColumn("mark", F.xxhash64("text"))
    scratch = Scratch(spark, "lines")
    keys = scratch.write(_keys(base, least_chars, kind), "keys")
    order = ("h1", "h2", F.desc_nulls_last("id"))
    ranged = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order, "mark")
    marks = scratch.write(ranged.mapInArrow(_stream(least_docs), f"kind int, h1 long, h2 long, id {kind}, mark long, lines int, places array<int>, n long"), "marks")
    edges = marks.where(f"kind = {EDGE}").groupBy("h1", "h2").agg(F.sum("n").alias("met"), F.max("id").alias("top")).where(F.col("met") >= least_docs)
    opened = marks.where(f"kind = {OPEN}").drop("n").join(F.broadcast(edges), ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("top")))
    drops = marks.where(f"kind = {DROP}").select("id", "mark", "lines", "places").unionByName(opened.select("id", "mark", "lines", "places"))
    found = drops.groupBy("id", "mark").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"), F.first("lines").alias("lines"))
    maps = scratch.write(found.select("id", "mark", F.size("places").cast("long").alias("n_dropped"), keep_bitmap("places", "lines").alias("keep")), "maps")
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    rows = base.select("id", "mark", n_lines.cast("long").alias("n_lines"), "carry")
    joined = rows.alias("d").join(maps.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.mark") == F.col("m.mark")), "left")
    return joined.select(
        F.col("d.id").alias(id_col), "n_lines", F.coalesce("m.n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.col("m.keep").alias("keep"),
        *[F.col("d.carry").getField(c).alias(c) for c in carry],
    )
