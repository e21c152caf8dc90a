"""Document fingerprints: threshold-scaled sketches of word shingles. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch

SPACE = r"[\x20\x09-\x0D]+"
BUCKETS = 1024
COPIES = 64  # parts of a row's copies
SCALE = 4  # a sketch keeps every hash in this part of the hash space


def with_sketch(df: DataFrame, text: str, name: str, width: int = 5, scale: int = SCALE) -> DataFrame:
    """`df` with a sketch of the column `text`: every distinct shingle hash in the lowest 1/scale of the hash space, sorted.

    A shingle is a run of `width` words; a text with fewer words is one shingle, one without words has none. The same
    fraction holds for texts of every length, so sketches merge by union; a text of 1,000 words keeps some 250 hashes at
    a scale of 4, and one of few words may keep none.
    Each step is a column of its own: an array that a lambda function reads is then made once a row.
    """
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_words") - (width - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(F.col("_words"), i, F.lit(width))))
    out = df.withColumn("_words", F.filter(F.split(F.lower(text), SPACE), lambda w: w != ""))
    out = out.withColumn("_hashes", F.when(F.size("_words") > 0, runs).otherwise(F.array().cast("array<bigint>")))
    return out.withColumn(name, F.sort_array(F.array_distinct(F.filter("_hashes", lambda h: h < F.lit(top(scale)))))).drop("_words", "_hashes")


def top(scale: int) -> int:
    """Every hash below this one is kept."""
    return -(1 << 63) + (1 << 64) // scale


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.sort_array(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard resemblance, 0 to 1; equal sketches are alike, two empty ones too. Its standard error is near
    sqrt(J (1 - J) scale / n) for texts that have n shingles together."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the first text's shingles that the second holds; 1 for an empty first sketch."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def hex_sketch(sketch: Column) -> Column:
    """16 lower-case hex digits for each hash, unsigned, in the sketch's order."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _slices(ids: DataFrame, n: int) -> tuple[list, list]:
    """At most n - 1 ascending bounds that cut the ids into even parts, and those of them that fill several parts."""
    points = [i / n for i in range(1, n)]
    got = ids.select(F.percentile_approx("k", F.array(*map(F.lit, points)), F.lit(max(10_000, 20 * n))).alias("q")).first()["q"] or []
    return sorted(set(got)), sorted({x for x in got if got.count(x) > 1})


def with_next(docs: DataFrame, key: str, values: list[str], parts: int, text: str, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """`docs` with next_<value> for each value: that of the row after it by descending key; for the last row that of
    the first. Equal keys stand in the order of a hash of `text`, then of the text; null keys come last. `derive` adds
    columns to the rows and to the few sentinels alike, after these were picked.

    A window over the whole table would be one task. Keys are cut at sampled quantiles into `parts` slices, and a key
    that fills several of them (or the null keys) into BUCKETS ranges of the text's hash. Copies of one row that are still
    too many for one slice are dealt to COPIES parts by their input partition: they are equal, so any order is theirs. Each
    part is a window of its own, and gets as sentinel the first row of the part that follows, found by a join with one
    row for each part: `parts`, and BUCKETS + COPIES for each of the fewer than `parts` such keys and copies, at most.
    """
    bounds, often = _slices(docs.select(F.col(key).alias("k")).where("k is not null"), parts)
    step = max(1, int(len(bounds) ** 0.5))
    if bounds:
        fine, coarse = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[step - 1 :: step]))
        jump = F.size(F.filter(coarse, lambda b: b <= F.col(key))) * step
        slot = jump + F.size(F.filter(F.slice(fine, jump + 1, F.lit(step)), lambda b: b <= F.col(key)))
    else:
        slot = F.lit(0)
    bucket = F.shiftright("_hash", 54).cast("int") + 1 + BUCKETS // 2
    shared = F.col(key).isNull() | (F.col(key).isin(often) if often else F.lit(False))
    # numbers ascend as keys descend; the keys above a shared one in its slice come before it
    slot = F.when(shared, bucket).otherwise(0) - F.when(F.col(key).isNull(), F.lit(-1)).otherwise(slot) * (BUCKETS + 1)
    rows = docs.withColumn("_hash", F.xxhash64(text))
    # hashes that too many rows of a shared key have, in order: what lies between two of them is a part, and each is COPIES
    counts = rows.where(shared).groupBy(F.col(key).alias("_key"), F.col("_hash").alias("_h")).agg(F.count("*").alias("_n"))
    most = docs.agg(F.ceil(F.count("*") / parts)).scalar()
    hot = counts.withColumn("_most", most).where("_n > _most").groupBy("_key").agg(F.array_sort(F.collect_list("_h")).alias("_hot"))
    rows = rows.join(F.broadcast(hot), rows[key].eqNullSafe(hot["_key"]), "left").withColumn("_hot", F.coalesce("_hot", F.array().cast("array<bigint>")))
    copy = F.array_contains("_hot", F.col("_hash"))
    part = 2 * F.size(F.filter("_hot", lambda h: h < F.col("_hash"))) + copy.cast("int")
    rows = rows.withColumn("_slot", F.struct(slot.alias("s"), part.alias("p"), F.when(copy, F.spark_partition_id() % COPIES).otherwise(0).alias("c")))
    rows = rows.select(*docs.columns, "_hash", "_slot", F.lit(0).alias("_sentinel"))
    if hot.limit(1).count():  # parts by input partition hold for one reading only
        rows = Scratch(docs.sparkSession, "copies").write(rows, "rows")
    first = F.max(F.struct(F.col(key).isNotNull().alias("has"), F.col(key).alias("top"), F.bitwise_not("_hash").alias("h")))
    tops = rows.groupBy(F.col("_slot").alias("of")).agg(first.alias("t"))
    order = Window.orderBy(F.desc("of"))
    tops = tops.select("of", "t.top", F.bitwise_not("t.h").alias("h"), F.coalesce(F.lead("of").over(order), F.first("of").over(order)).alias("to"))
    heads = rows.join(F.broadcast(tops), rows[key].eqNullSafe(tops["top"]) & (rows["_hash"] == tops["h"]) & (rows["_slot"] == tops["of"])).select(
        *[rows[c] for c in docs.columns], rows["_hash"], F.col("to").alias("_slot"), F.lit(1).alias("_sentinel")
    )
    # a part of copies has one row for each as its first: one is enough
    heads = heads.dropDuplicates(["_slot"])
    w = Window.partitionBy("_slot").orderBy("_sentinel", F.desc_nulls_last(key), "_hash", text)
    out = derive(rows.unionByName(heads)).select("*", *[F.lead(v).over(w).alias(f"next_{v}") for v in values])
    return out.where("_sentinel = 0").drop("_slot", "_sentinel", "_hash")


def fingerprint_documents(docs: DataFrame, width: int = 5, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, contained_in_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the
    next document's by descending id. Null text counts as empty; among equal ids (and null ones, which come last) the
    order is that of a hash of the texts, then of the texts; a table of one document is its own next, an empty table
    gives nothing. Repeated rows are kept. Every whole text is read, shuffled and sketched once, the edited text once
    more. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = with_next(base, "id", ["text", "sketch"], min(parts, 4096), "text", lambda rows: with_sketch(rows, "text", "sketch", width, scale))
    d = d.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next_text", F.lit(1), half)))
    d = d.select("id", "n_chars", "sketch", "next_sketch", "edited", F.sha2("edited", 256).alias("edited_sha256"))
    d = with_sketch(d, "edited", "edited_sketch", width, scale)
    return d.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        hex_sketch(F.col("sketch")).alias("fingerprint"), hex_sketch(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("contained_in_next"),
    )
