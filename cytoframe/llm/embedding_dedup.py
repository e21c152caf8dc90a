"""Near-duplicate embeddings by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from .common import Scratch, link
from .graph import components, same_ids, with_components
from .minhash_dedup import blocks, runs


def stacked(batch: pd.DataFrame, kind: str) -> np.ndarray:
    """The vectors as rows; doubles are scaled by powers of two, which is exact, so that no norm overflows."""
    x = np.stack(batch["embedding"].to_numpy()).astype(kind)
    return x if kind == "float32" else np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def moments(dim: int, kind: str) -> Callable:
    """The sum of outer products of a partition's unit vectors, a row of the matrix each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = stacked(batch, kind).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pd.DataFrame({"i": range(dim), "s": [r.tobytes() for r in total]})

    return run


def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each i: the sum of its rows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, s in zip(batch["i"], batch["s"]):
            total[i] = total.get(i, 0) + np.frombuffer(s)
    yield pd.DataFrame({"i": list(total), "s": [r.tobytes() for r in total.values()]}).astype({"i": "int32"})


def principal_axes(vectors: DataFrame, dim: int, kind: str) -> np.ndarray:
    """Columns: the axes of the second moments of all unit vectors, by falling share. The driver gets `dim` rows of them."""
    parts = vectors.mapInPandas(moments(dim, kind), "i int, s binary").repartition("i")
    m = np.zeros((dim, dim))
    for r in parts.mapInPandas(summed, "i int, s binary").collect():
        m[r["i"]] = np.frombuffer(r["s"])
    return np.ascontiguousarray(np.linalg.eigh(m)[1][:, ::-1])


def place(axes: np.ndarray, kind: str) -> Callable:
    """The leading principal coordinate of each unit vector; linked ones lie no further apart in it than in space."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = stacked(batch, kind)
            x = raw.astype(np.float64)
            yield pd.DataFrame({"cid": batch["cid"], "copies": batch["copies"], "at": x @ axes[:, 0] / np.linalg.norm(x, axis=1), "vec": [r.tobytes() for r in raw]})

    return run


def links_between(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool, steps: tuple[int, ...] = (8, 16, 32)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with cosine >= threshold, in blocks of rows of `a`; for one tile with itself only i < j.

    Products are summed over the leading principal axes first. What the others can still add is at most the
    product of the vectors' norms over them, so a pair is given up once that cannot reach the threshold. Pairs
    that stay are confirmed on the vectors as given, in double precision.
    """
    da, db = a.astype(np.float64), b.astype(np.float64)
    na, nb = np.linalg.norm(da, axis=1), np.linalg.norm(db, axis=1)
    ra, rb = (da / na[:, None] @ axes), (db / nb[:, None] @ axes)
    cuts = [s for s in steps if s < ra.shape[1]]
    rest = {s: (np.sqrt(np.maximum((ra[:, s:] ** 2).sum(1), 0)), np.sqrt(np.maximum((rb[:, s:] ** 2).sum(1), 0))) for s in cuts}
    least = threshold - 1e-9
    fa, fb = ra.astype(np.float32), rb.astype(np.float32)
    for lo in range(0, len(a), 256):
        hi = min(lo + 256, len(a))
        base = lo if same else 0
        i = j = None
        if cuts:
            s = cuts[0]
            reach = fa[lo:hi, :s] @ fb[base:, :s].T
            reach += rest[s][0][lo:hi, None].astype(np.float32) * rest[s][1][None, base:].astype(np.float32)
            i, j = np.nonzero(reach >= least - 1e-4)
            i, j = i + lo, j + base
            if same:
                i, j = i[i < j], j[i < j]
            if len(i) <= 0.05 * (hi - lo) * (len(b) - base):
                done, part = s, np.einsum("ij,ij->i", ra[i, :s], rb[j, :s])
                for s in cuts[1:]:
                    part = part + np.einsum("ij,ij->i", ra[i, done:s], rb[j, done:s])
                    stay = part + rest[s][0][i] * rest[s][1][j] >= least
                    i, j, part, done = i[stay], j[stay], part[stay], s
                cos = np.einsum("ij,ij->i", da[i], db[j]) / (na[i] * nb[j])
                yield i[cos >= threshold], j[cos >= threshold]
                continue
        cos = (da[lo:hi] @ db[base:].T) / (na[lo:hi, None] * nb[None, base:])
        i, j = np.nonzero(cos >= threshold)
        i, j = i + lo, j + base
        yield (i[i < j], j[i < j]) if same else (i, j)


def compare_tiles(axes: np.ndarray, threshold: float, kind: str) -> Callable:
    """Rows (u, v, links): `links` more links of class u where v is null, else a link u - v of a spanning forest."""
    dim = len(axes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(batches, "meet", 1 << 14):
            for meet in blocks(frame, "meet"):
                ids, copies = meet["cid"].to_numpy(np.int64), meet["copies"].to_numpy(float)
                x = np.frombuffer(b"".join(meet["vec"]), kind).reshape(-1, dim)
                n = int((meet["side"] == 0).sum())
                same = n == len(x)
                a, b, shift = (x, x, 0) if same else (x[:n], x[n:], n)
                count, parent = np.zeros(len(ids)), np.arange(len(ids))
                for i, j in links_between(a, b, axes, threshold, same):
                    if len(i):
                        count += np.bincount(i, copies[j + shift], len(ids)) + np.bincount(j + shift, copies[i], len(ids))
                        open_ = parent[i] != parent[j + shift]
                        parent = link(parent, i[open_], j[open_] + shift)
                at, tied = np.flatnonzero(count), np.flatnonzero(parent != np.arange(len(ids)))
                if len(at):
                    v = pd.array(np.r_[np.zeros(len(at), np.int64), ids[parent[tied]]], "Int64")
                    v[: len(at)] = pd.NA
                    yield pd.DataFrame({"u": np.r_[ids[at], ids[tied]], "v": v, "links": np.r_[count[at], np.zeros(len(tied))].astype(np.int64)})

    return run


def meetings(placed: DataFrame, width: float, tile: int, scratch: Scratch, name: str) -> DataFrame:
    """(meet, side, cid, copies, vec): classes in slices of about `tile` along the leading coordinate, each of which
    meets itself and every slice within `width` once. Slices that ties make too large are divided by a hash."""
    n = placed.count()
    points = [k / -(-n // tile) for k in range(1, -(-n // tile))]
    bounds = sorted(set(placed.agg(F.percentile_approx("at", F.array(*map(F.lit, points)), F.lit(max(10_000, 20 * len(points)))).alias("q")).first()["q"])) if points else []
    below = lambda x: F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= x)) if bounds else F.lit(0)
    cut = placed.withColumn("slice", below(F.col("at")))
    ends = cut.groupBy("slice").agg(F.max("at").alias("hi"), F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    ends = scratch.write(ends.select("slice", "parts", below(F.col("hi") + width).alias("last")), f"slices{name}")
    numbered = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    mine = ends.select(F.col("slice").alias("a"), "parts", F.explode(F.sequence("slice", "last")).alias("b")).select("a", numbered.alias("ka"), "b")
    other = ends.select(F.col("slice").alias("b"), numbered.alias("kb"))
    pairs = mine.join(other, "b").where("a < b or ka <= kb").select("a", "ka", "b", "kb", F.xxhash64("a", "ka", "b", "kb").alias("meet"))
    sides = pairs.select("meet", F.lit(0).alias("side"), F.col("a").alias("slice"), F.col("ka").alias("k"))
    sides = sides.unionByName(pairs.where("a != b or ka != kb").select("meet", F.lit(1).alias("side"), F.col("b").alias("slice"), F.col("kb").alias("k")))
    dealt = cut.join(ends.select("slice", "parts"), "slice").withColumn("k", F.pmod(F.xxhash64("cid"), "parts").cast("int"))
    return dealt.join(sides, ["slice", "k"]).select("meet", "side", "cid", "copies", "vec")


def embedding_duplicates(vectors: DataFrame, threshold: float = 0.95, tile: int = 16384, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Equal vectors are one class with a key of its own, whatever their ids. Classes are ordered by their leading
    principal coordinate and cut into slices of about `tile` (fewer for long vectors, so that a pair of slices
    fits in a task); a slice meets itself and those within the reach of a link once. A meeting returns counts and
    a spanning forest, never its pairs. So a vector is shuffled once for each slice within reach: where the leading
    coordinate spreads little, that is every slice. `dim` rows of the second moments, the slices' bounds and the
    vectors' lengths reach the driver; vectors of different lengths are never linked.
    n_links counts the other rows whose vector is linked with this row's, equal ones included, whatever their ids;
    components follow links and ids: rows that share an id are one vertex. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing, and belong to their id; rows with a null id are on their own
    (component_id null). Floats are kept as floats, other numbers are compared as doubles. Other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    kind, number = ("float32", "float") if isinstance(vectors.schema[vec_col].dataType.elementType, FloatType) else ("float64", "double")
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{number}>").alias("embedding"))
    fine = (
        F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("id").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
        & F.exists("embedding", lambda x: F.coalesce(x != 0, F.lit(False)))
    )
    base = base.withColumn("fine", F.coalesce(fine, F.lit(False)))
    good = base.where("fine").select("id", F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0).cast(number)).otherwise(x)).alias("embedding"))
    good = good.select("*", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit("2"), "embedding").alias("k2"))
    classes = good.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = scratch.write(classes.withColumn("dim", F.size("embedding")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    width = (2 - 2 * threshold) ** 0.5 + 1e-6
    narrow = good.select("id", "k1", "k2")
    edges, counts = same_ids(narrow, classes), spark.createDataFrame([], "u long, links long")
    for dim in sorted(r["dim"] for r in classes.select("dim").distinct().collect()):
        own = classes.where(F.col("dim") == dim).select("cid", "copies", "embedding")
        axes = principal_axes(own.select("embedding"), dim, kind)
        placed = scratch.write(own.mapInPandas(place(axes, kind), "cid long, copies long, at double, vec binary"), f"placed{dim}")
        met = meetings(placed, width, min(tile, max(256, (1 << 22) // dim)), scratch, str(dim))
        met = met.repartition("meet").sortWithinPartitions("meet", "side", "cid")
        out = scratch.write(met.mapInPandas(compare_tiles(axes, threshold, kind), "u long, v long, links long"), f"met{dim}")
        scratch.drop(f"placed{dim}", f"slices{dim}")
        counts = counts.unionByName(out.where("v is null").groupBy("u").agg(F.sum("links").alias("links")))
        edges = edges.unionByName(out.where("v is not null").select("u", "v"))
    found = components(edges, scratch, "linked")
    links = classes.join(counts.withColumnRenamed("u", "cid"), "cid", "left").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    none = base.where("not fine").select("id", F.lit(0).cast("long").alias("n_links"))
    out = with_components(narrow.join(links, ["k1", "k2"]), none, classes, found, scratch)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
