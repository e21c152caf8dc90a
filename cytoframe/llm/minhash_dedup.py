"""MinHash near-duplicates by a chosen-path similarity join.

Chosen path: documents branch by the value of selected minwise tokens, node by node; a node small enough is
compared exhaustively on its signatures, a crowded one branches again by tokens that its own key selects; several
independent trees bring the recall to its target (Christiani, Pagh and Sivertsen, 2018). The trees only gather
documents into candidate groups; every link is then confirmed on full shingle sets, and only confirmed links are
followed to components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, link
from .graph import components, same_ids, with_components
from .words import mix

TOKENS = 64  # minwise tokens of a signature
CACHE = 150_000
_R = np.random.default_rng(20)
SEEDS = _R.integers(0, 1 << 64, TOKENS, np.uint64)
ODD = _R.integers(0, 1 << 64, TOKENS, np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, width: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words; fewer words are one run, none give an empty set.

    Words are what white space (ASCII) leaves of the text with A-Z lower-cased.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(cache) > CACHE:
        cache.clear()
    for w in set(words).difference(cache):
        cache[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    run = min(width, len(h))
    with np.errstate(over="ignore"):
        acc = np.full(len(h) - run + 1, run, np.uint64)
        for i in range(run):
            acc = acc * BASE + h[i : i + len(acc)]
            acc ^= acc >> np.uint64(29)
        return np.unique(mix(acc))


def signature(s: np.ndarray) -> np.ndarray:
    """The upper halves of the minima of `TOKENS` hash functions over a non-empty set."""
    if len(s) * TOKENS > 1 << 19:
        low = np.array([((s ^ x) * a).min() for x, a in zip(SEEDS, ODD)])
    else:
        low = ((s[None, :] ^ SEEDS[:, None]) * ODD[:, None]).min(axis=1)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the whole set."""
    a = mix(s + np.uint64(1))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(a ^ BASE)).view(np.int64))


def runs(batches: Iterator[pd.DataFrame], key: str, most: int = 4096) -> Iterator[pd.DataFrame]:
    """Frames of whole runs of equal keys, from batches that are sorted by the key; several runs share a frame."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        for lo in range(0, len(batch), most):
            part = batch.iloc[lo : lo + most]
            k = part[key].to_numpy()
            last = np.flatnonzero(k != k[-1])
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield pd.concat([*rest, part.iloc[:cut]], ignore_index=True)
                rest = []
            elif rest and rest[-1][key].iloc[-1] != k[-1]:
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(part.iloc[cut:])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def blocks(frame: pd.DataFrame, key: str) -> Iterator[pd.DataFrame]:
    k = frame[key].to_numpy()
    cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1), len(k)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield frame.iloc[lo:hi]


def compare_nodes(least_equal: int) -> Callable:
    """(node, sub, cid): the sets of two or more classes of a node that pairs lead to whose signatures agree in at
    least `least_equal` tokens; `sub` is the smallest class of the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(batches, "node"):
            out = []
            for node in blocks(frame, "node"):
                if len(node) < 2:
                    continue
                ids = node["cid"].to_numpy()
                sig = np.frombuffer(b"".join(node["sig"]), np.int32).reshape(len(ids), TOKENS)
                parent = np.arange(len(ids))
                for i in range(len(ids) - 1):
                    j = i + 1 + np.flatnonzero(parent[i + 1 :] != parent[i])
                    j = j[(sig[j] == sig[i]).sum(axis=1) >= least_equal]
                    if len(j):
                        parent = link(parent, np.full(len(j), i), j)
                many = np.flatnonzero(np.bincount(parent, minlength=len(ids))[parent] > 1)
                out.append((np.full(len(many), node["node"].iloc[0]), ids[parent[many]], ids[many]))
            if out:
                yield pd.DataFrame({name: np.concatenate(x) for name, x in zip(("node", "sub", "cid"), zip(*out))})

    return run


def confirm_tiles(percent: int) -> Callable:
    """Edges that span what the linked pairs of a tile connect: 100 * intersection >= percent * union, on full sets. They
    lead to a set's first class, so that paths are short.

    Pairs of one `comp` are known to be connected and not compared again, nor are pairs that became connected in the
    tile; where a tile has two sides, only pairs across them are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(batches, "tile", 512):
            us, vs = [], []
            for tile in blocks(frame, "tile"):
                if len(tile) < 2:
                    continue
                ids, side = tile["cid"].to_numpy(), tile["side"].to_numpy()
                sets = [np.frombuffer(b, np.uint64) for b in tile["set"]]
                size = np.array([len(s) for s in sets])
                token = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
                start = np.cumsum(size) - size
                known = np.unique(tile["comp"].to_numpy(), return_index=True, return_inverse=True)
                parent = known[1][known[2].ravel()]
                first = parent.copy()
                mark = np.zeros(int(token.max()) + 1, bool)
                two = bool((side != side[0]).any())
                for i in range(len(ids) - 1):
                    if two and side[i] != side[0]:
                        break  # rows are sorted by side: what follows was all compared
                    apart = (parent[i + 1 :] != parent[i]) & (100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i]))
                    if two:
                        apart &= side[i + 1 :] != side[i]
                    j = i + 1 + np.flatnonzero(apart)
                    if not len(j):
                        continue
                    own = token[start[i] : start[i] + size[i]]
                    mark[own] = True
                    ends = np.cumsum(size[j])
                    at = np.repeat(start[j] - ends + size[j], size[j]) + np.arange(ends[-1])
                    both = np.add.reduceat(mark[token[at]].astype(np.int64), ends - size[j])
                    mark[own] = False
                    j = j[100 * both >= percent * (size[i] + size[j] - both)]
                    if len(j):
                        parent = link(parent, np.full(len(j), i), j)
                joined = np.flatnonzero((first == np.arange(len(ids))) & (parent != first))
                if len(joined):
                    us.append(ids[parent[joined]])
                    vs.append(ids[joined])
            if us:
                yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return run


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, trees: int = 10, leaf: int = 512, depth: int = 4, tile: int = 256, most_broadcast: int = 400_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: the component of documents linked at percent / 100 or more.

    Equal sets are one class with a key of its own, whatever the ids of its rows. In each of `trees` trees a class
    starts with one token; a node of more than `leaf` classes branches by one more token that the node selects, in
    a quarter of the nodes by two (1.25 children on average, the reciprocal of the threshold). Small nodes are
    compared on signatures with four standard errors of slack, which leaves sets of classes that may be linked.
    A pair at the threshold shares its first node in one tree of ten with probability 1 - 0.2^10, a pair that
    stays crowded to the end in at least 0.99 of cases. Every link is then confirmed on full sets:
    - Sets that signatures connect over all nodes, up to `tile` classes, are compared as one, each class once.
    - Larger ones are compared by node, so a class goes to at most as many tasks as it has nodes.
    - A node that is still crowded after `depth` tokens is cut into chunks of `tile`, each with the node's first class
      as pivot. If that leaves several components in it, all pairs across them are compared, chunk by chunk; pairs
      within a component need not be. Its cost is the classes apart from the largest component times all of them.
    Nothing is capped. Where up to `most_broadcast` classes have to be compared, their keys (two numbers each) are broadcast
    to pick their texts before these are shuffled. Components follow confirmed links, and ids: rows that share an id are one document, so their
    classes belong together. Texts without words have no set and link with nothing but rows of their id; rows
    with a null id are kept on their own (component_id null). Repeated rows are returned as often; texts are read whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for part in (b.iloc[lo : lo + 1024] for b in batches for lo in range(0, len(b), 1024)):
            rows = []
            for key, text, h in zip(part["doc_id"], part["text"], part["h"]):
                s = shingle_set(text or "", width, cache)
                rows.append((key, h, len(s), *(set_key(s) if len(s) else (0, 0)), signature(s).tobytes() if len(s) else None))
            yield pd.DataFrame(rows, columns=["doc_id", "h", "n", "k1", "k2", "sig"]).astype({"doc_id": "Int64"})

    known = scratch.write(base.mapInPandas(sketch, "doc_id long, h long, n long, k1 long, k2 long, sig binary"), "known")
    full = known.where("n > 0 and doc_id is not null")
    # a class's text is that of its smallest id, found again by its hash; the keys are fixed by the written table
    classes = full.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "h")).alias("r"), F.min("sig").alias("sig"))
    classes = classes.select("k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.h").alias("h"), "sig").withColumn("cid", F.monotonically_increasing_id())
    classes = scratch.write(classes, "classes")

    weak, crowded = candidates(classes, scratch, percent, trees, leaf, depth)
    groups = components(weak.where("sub != cid").select(F.col("sub").alias("u"), F.col("cid").alias("v")), scratch, "coarse")
    sizes = groups.groupBy("root").agg(F.count("*").alias("m"))
    groups = scratch.write(groups.withColumnRenamed("node", "cid").join(sizes, "root"), "groups")
    wide = groups.where(F.col("m") > tile).select("cid")
    member = groups.where(F.col("m") <= tile).select("cid", F.xxhash64(F.lit(0), "root").alias("tile")).unionByName(
        weak.where("not crowded").join(wide, "cid", "left_semi").select("cid", F.xxhash64(F.lit(1), "node", "sub").alias("tile"))
    )
    n_big = 0
    if crowded is not None:
        big, n_big = scratch.observed(crowded.join(wide, "cid", "left_semi"), "big", F.count("*"))
    if n_big:
        chunks = big.groupBy("node").agg(F.ceil(F.count("*") / tile).cast("int").alias("nc"))
        dealt = big.join(chunks, "node").withColumn("c", F.pmod(F.xxhash64("cid"), "nc").cast("int"))
        pivots = dealt.where("cid = sub").select("node", "sub", "cid", F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("c"))
        member = member.unionByName(dealt.select("node", "sub", "cid", "c").unionByName(pivots).select("cid", F.xxhash64(F.lit(2), "node", "c").alias("tile")).distinct())
    member = member.select("cid", F.struct("tile", F.lit(0).alias("side"), F.lit(None).cast("long").alias("comp")).alias("t"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for part in (b.iloc[lo : lo + 1024] for b in batches for lo in range(0, len(b), 1024)):
            found = [shingle_set(t or "", width, cache) for t in part["text"]]
            own = np.array([len(s) > 0 and set_key(s) == (a, b) for s, a, b in zip(found, part["k1"], part["k2"])], bool)
            yield part[["cid", "tiles"]].assign(set=[s.tobytes() for s in found])[own]

    # one text of each class that has to be compared, found by its id and hash; all their sets are written once
    held, n_held = scratch.observed(member.groupBy("cid").agg(F.array_sort(F.collect_list("t")).alias("tiles")), "held", F.count("*"))
    held = held.join(classes.select("cid", "k1", "k2", F.col("rep").alias("doc_id"), "h"), "cid")
    texts = base.where("doc_id is not null and text is not null")
    if n_held <= most_broadcast:  # else all texts are shuffled to the classes
        texts = texts.join(F.broadcast(held.select("doc_id", "h")), ["doc_id", "h"], "left_semi")
    # repeated rows meet where the join has put them: its keys are among those of `distinct`, so texts are shuffled once
    texts = texts.join(held, ["doc_id", "h"]).select("doc_id", "h", "cid", "k1", "k2", "tiles", "text").distinct()
    whole = scratch.write(texts.mapInPandas(sets, "cid long, tiles array<struct<tile:bigint,side:int,comp:bigint>>, set binary"), "sets", compression="uncompressed")

    def confirm(placed: DataFrame) -> DataFrame:
        """Edges from the tiles of (cid, tiles, set)."""
        spread = placed.select("cid", "set", F.explode("tiles").alias("t")).select("t.tile", "t.side", F.coalesce("t.comp", "cid").alias("comp"), "cid", "set")
        return spread.repartition("tile").sortWithinPartitions("tile", "side", "cid").mapInPandas(confirm_tiles(percent), "u long, v long")

    linked = scratch.write(confirm(whole).unionByName(same_ids(full.withColumnRenamed("doc_id", "id"), classes)), "links")
    found = components(linked, scratch, "linked")
    apart = across(big, found, scratch, tile) if n_big else None
    if apart is not None:
        again = whole.select("cid", "set").join(apart.groupBy("cid").agg(F.collect_list("t").alias("tiles")), "cid")
        found = components(linked.unionByName(confirm(again)), scratch, "relinked")
    scratch.drop("held", "sets", "groups", "coarse-components", "big", "weak", "crowded")

    narrow = known.select(F.col("doc_id").alias("id"), "n", "k1", "k2")
    out = with_components(narrow.where("n > 0 and id is not null"), narrow.where("n = 0 or id is null").drop("k1", "k2"), classes, found, scratch)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def candidates(classes: DataFrame, scratch: Scratch, percent: int, trees: int, leaf: int, depth: int) -> tuple[DataFrame, DataFrame | None]:
    """The trees. (node, sub, cid, crowded): sets of classes that may be linked, of small and of crowded nodes; and
    those of the crowded nodes alone, of which every class counts. None where no node is crowded in the end."""
    sigs = classes.select("cid", "sig")

    def token(at):
        return F.substring("sig", at * 4 + 1, 4) if isinstance(at, int) else F.expr(f"substring(sig, ({at}) * 4 + 1, 4)")

    first = F.array(*[F.xxhash64(F.lit(r), token(r)) for r in range(trees)])
    cand = sigs.select(F.explode(first).alias("node"), "cid")
    leaves, crowded, level = [], None, 1
    while True:
        if level > 1:  # the first are hashes of what `classes` has
            cand = scratch.write(cand, f"cand{level}")
        counts, most = scratch.observed(cand.groupBy("node").agg(F.count("*").alias("m")).where("m > 1"), f"counts{level}", F.max("m"))
        shared = scratch.write(cand.join(counts, "node"), f"shared{level}")
        scratch.drop(f"cand{level}", f"counts{level}")
        leaves.append(shared.where(F.col("m") <= leaf).select("node", "cid"))
        crowded = shared.where(F.col("m") > leaf).select("node", "cid")
        if level == depth or most <= leaf:
            break
        at = f"{trees} + pmod(xxhash64(node, b, {level}), {TOKENS - trees})"
        cand = (
            crowded.join(sigs, "cid")
            .select("cid", "sig", "node", F.explode(F.when(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(4)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("b"))
            .select(F.xxhash64("node", "b", token(f"cast({at} as int)")).alias("node"), "cid")
        )
        level += 1
    small = leaves[0]
    for more in leaves[1:]:
        small = small.unionByName(more)
    slack = percent / 100 - 4 * (percent / 100 * (1 - percent / 100) / TOKENS) ** 0.5
    nodes = small.join(sigs, "cid").repartition("node").sortWithinPartitions("node", "cid")
    weak = nodes.mapInPandas(compare_nodes(int(slack * TOKENS)), "node long, sub long, cid long").withColumn("crowded", F.lit(False))
    levels = [f"shared{k}" for k in range(1, level + 1)]
    if most <= leaf:
        weak = scratch.write(weak, "weak")
        scratch.drop(*levels)
        return weak, None
    full = crowded.join(crowded.groupBy("node").agg(F.min("cid").alias("sub")), "node").select("node", "sub", "cid")
    full = scratch.write(full, "crowded")
    weak = scratch.write(weak.unionByName(full.withColumn("crowded", F.lit(True))), "weak")
    scratch.drop(*levels)
    return weak, full


def across(big: DataFrame, found: DataFrame, scratch: Scratch, tile: int) -> DataFrame | None:
    """Tiles (cid, t) of all pairs across the components of crowded nodes; None where each is one component.

    In each node the classes outside its largest component meet one another and that component, in chunks.
    """
    own = big.join(found.withColumnRenamed("node", "cid"), "cid", "left").select("node", "cid", F.coalesce("root", "cid").alias("comp"))
    own = scratch.write(own, "own")
    parts = own.groupBy("node", "comp").agg(F.count("*").alias("m"))
    top = parts.groupBy("node").agg(F.max(F.struct("m", "comp"))["comp"].alias("main"), F.max("m").alias("nm"), F.sum("m").alias("all")).where("nm < all")
    if not top.limit(1).count():
        return None
    top = top.select("node", "main", F.ceil(F.col("nm") / (8 * tile)).cast("int").alias("nd"), F.ceil((F.col("all") - F.col("nm")) / (tile // 2)).cast("int").alias("nr"))
    at = own.join(top, "node")
    rest = at.where("comp != main").withColumn("c", F.pmod(F.xxhash64("cid"), "nr").cast("int"))
    main = at.where("comp = main").withColumn("c", F.pmod(F.xxhash64("cid"), "nd").cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("j")
    key = lambda *c: F.xxhash64(*c).alias("tile")
    among = rest.select("cid", "comp", "node", "c", every("nr")).select("cid", "comp", F.col("c").alias("side"), key(F.lit(3), "node", F.least("c", "j"), F.greatest("c", "j")))
    left = rest.select("cid", "comp", "node", "c", every("nd")).select("cid", "comp", F.lit(0).alias("side"), key(F.lit(4), "node", "c", "j"))
    right = main.select("cid", "comp", "node", "c", every("nr")).select("cid", "comp", F.lit(1).alias("side"), key(F.lit(4), "node", "j", "c"))
    tiles = among.unionByName(left).unionByName(right).select("cid", F.struct("tile", "side", "comp").alias("t"))
    return scratch.write(tiles, "across")
