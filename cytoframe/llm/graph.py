"""Connected components of an edge table, by contraction; nothing comes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, root): the smallest node that edges (u, v) lead to, for every node that has an edge.

    Each round hooks every node to its smallest neighbour, follows these links to their end by pointer
    jumping, and replaces the nodes of every edge by their roots. At least half of the nodes of a component
    vanish in a round, so the rounds grow with the logarithm of the nodes. Hubs meet in partial
    aggregations and in joins that adaptive execution can split. What ends a loop is observed while its table is
    written: every execution costs the driver memory.
    """
    made: list[str] = []

    def named(name: str) -> str:
        made.append(f"{tag}-{name}")
        return made[-1]

    rows = F.count("*")
    live, n = scratch.observed(edges.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), named("e0"), rows)
    found: DataFrame | None = None
    k = 0
    while n:
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root"))
        up = scratch.write(up, named(f"p{k}"))
        step = 0
        while True:  # pointer jumping: the paths halve each time
            nxt = up.select(F.col("node").alias("root"), F.col("root").alias("far"))
            jumped, moved = scratch.observed(
                up.join(nxt, "root", "left").select("node", F.coalesce("far", "root").alias("root"), (F.coalesce("far", "root") != F.col("root")).alias("moved")),
                named(f"p{k}-{step}"),
                F.count_if("moved"),
            )
            step += 1
            up = jumped.select("node", "root")
            if not moved:
                break
        if found is None:
            found = up
        else:
            found = scratch.write(
                found.join(up.select(F.col("node").alias("root"), F.col("root").alias("far")), "root", "left")
                .select("node", F.coalesce("far", "root").alias("root")),
                named(f"f{k}"),
            )
        a, b = up.select(F.col("node").alias("u"), F.col("root").alias("ru")), up.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        live, n = scratch.observed(
            live.join(a, "u").join(b, "v").where("ru != rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(),
            named(f"e{k + 1}"),
            rows,
        )
        k += 1
    if found is None:
        found = live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = scratch.write(found, f"{tag}-components")
    scratch.drop(*made)
    return out


def same_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (u, v) between the classes (k1, k2, cid) of ids that have several, from rows (id, k1, k2)."""
    keys = rows.groupBy("id").agg(*[f(c).alias(f"{n}{c}") for c in ("k1", "k2") for n, f in (("lo", F.min), ("hi", F.max))])
    ids = keys.where("lok1 != hik1 or lok2 != hik2").select("id")
    own = rows.join(ids, "id", "left_semi").select("id", "k1", "k2").distinct().join(classes.select("k1", "k2", "cid"), ["k1", "k2"])
    return own.join(own.groupBy("id").agg(F.min("cid").alias("u")), "id").where("u != cid").select("u", F.col("cid").alias("v"))


def with_components(some: DataFrame, none: DataFrame, classes: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """`some` (id, k1, k2, ...) and `none` (id, ...), rows without a class, with component_id: the smallest id that a
    row's class leads to. A row without a class belongs to its id; a null id has no component."""
    root = classes.select("cid", "k1", "k2", "rep").join(found.withColumnRenamed("node", "cid"), "cid", "left").select("k1", "k2", "rep", F.coalesce("root", "cid").alias("root"))
    root = scratch.write(root, "roots")
    info = root.join(root.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("k1", "k2", "component_id")
    some = scratch.write(some.join(info, ["k1", "k2"]).drop("k1", "k2"), "some")
    by_id = some.select(F.col("id").alias("_id"), F.col("component_id").alias("_c")).join(none.select(F.col("id").alias("_id")), "_id", "left_semi").distinct()
    none = none.join(by_id, F.col("id") == F.col("_id"), "left").withColumn("component_id", F.coalesce("_c", "id")).drop("_id", "_c")
    return some.unionByName(none)
