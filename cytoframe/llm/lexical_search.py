"""Ranked lexical search: the postings of each term as a treap, all terms of an item traversed together."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import Scratch

#: ASCII letters and digits, lower-cased, and every byte of other characters; all else separates terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SHARD, SHARD_BYTES = 8192, 64 << 20  # documents, and bytes of their terms, whose treaps a task holds at once
FRONTIER = 1_000_000  # postings of the items that are traversed at once
BLOCK = 200_000  # pairs of item and term that go to the tasks at once
NONE = -1


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs), written to the shared folder: of each text the number of its terms with repeats, its
    distinct terms joined by blanks, and their counts in the same order. Whole texts are read, null texts have none."""
    scratch = Scratch(docs.sparkSession, "lexical")
    kind = docs.schema[id_col].dataType.simpleString()
    return scratch.write(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(_count_terms, f"id {kind}, n long, terms string, tfs array<int>"), "terms")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            n, terms, tfs = [], [], []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                found = (text or b"").translate(TERM_BYTES).split()
                count = Counter(found)
                n.append(len(found))
                terms.append(b" ".join(count))
                tfs.append(np.fromiter(count.values(), np.int32, len(count)))
            offsets = np.cumsum([0, *map(len, tfs)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(tfs), pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()), lists], names=["id", "n", "terms", "tfs"])


def _asked(terms: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms among `words`: their rows, their places in the flattened lists, and their numbers in `words`."""
    lists = pc.split_pattern(terms, " ")
    number = pc.index_in(lists.flatten(), value_set=words)
    at = np.flatnonzero(np.asarray(number.is_valid()))
    row = np.repeat(np.arange(len(terms)), np.diff(lists.offsets.to_numpy()))
    return row[at], at, np.asarray(pc.fill_null(number, NONE))[at]


def larger_before(rank: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it, in its list, that is larger; -1 where there is none.

    All entries walk at once: what lies between an entry and the one it points at is smaller than it, so it may go on
    to where that one points. A list begins where `first` is set; no two entries are equal.
    """
    up = np.arange(len(rank)) - 1
    up[first] = NONE
    walking = np.flatnonzero(~first)
    while len(walking := walking[(up[walking] >= 0) & (rank[up[walking]] < rank[walking])]):
        up[walking] = up[up[walking]]
    return up


class Treaps:
    """The postings of some documents as one treap for each term: in search order the documents ascend, and no posting
    gains more than its parent. Flat arrays; a node is the place of its posting."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, gain: np.ndarray, n_terms: int):
        order = np.lexsort((doc, term))
        term, self.doc, self.gain = term[order], doc[order], gain[order]
        place = np.arange(len(term))
        # equal gains in a mixed order, so that they make no chains
        rank = (self.gain << 32) | ((place * 0x9E3779B1) & 0xFFFFFFFF)
        new = np.ones(len(term), bool)
        new[1:] = term[1:] != term[:-1]
        last = np.ones(len(term), bool)
        last[:-1] = new[1:]
        before = larger_before(rank, new)
        back = larger_before(rank[::-1], last[::-1])[::-1]
        after = np.where(back >= 0, len(term) - 1 - back, NONE)
        most = np.iinfo(np.int64).max
        of_before, of_after = np.where(before >= 0, rank[before], most), np.where(after >= 0, rank[after], most)
        self.left, self.right, self.root = np.full(len(term), NONE), np.full(len(term), NONE), np.full(n_terms, NONE)
        is_left, is_right = of_after < of_before, of_before < of_after
        self.left[after[is_left]] = place[is_left]
        self.right[before[is_right]] = place[is_right]
        top = (before < 0) & (after < 0)
        self.root[term[top]] = place[top]
        self.size = np.bincount(term, minlength=n_terms)

    def split(self, node: np.ndarray, lo: np.ndarray, pivot: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each node, the root of a treap's part in (lo, hi): the roots of its parts in (lo, pivot) and in
        (pivot, hi), and the posting of the pivot; -1 where there is none. All descend towards their pivot at once."""
        left, right, hit = (np.full(len(node), NONE) for _ in range(3))
        at, y = np.arange(len(node)), node
        while len(at):
            d, p = self.doc[y], pivot[at]
            below, above = d < p, d > p
            here = below & (left[at] < 0) & (d > lo[at])
            left[at[here]] = y[here]
            here = above & (right[at] < 0) & (d < hi[at])
            right[at[here]] = y[here]
            same = ~below & ~above
            hit[at[same]] = y[same]
            y = np.where(below, self.right[y], self.left[y])
            on = ~same & (y >= 0)
            at, y = at[on], y[on]
        for side, child, onward, inside in ((left, self.left, self.right, lambda d, i: d > lo[i]), (right, self.right, self.left, lambda d, i: d < hi[i])):
            at = np.flatnonzero((side < 0) & (hit >= 0))
            y = child[hit[at]]
            at, y = at[y >= 0], y[y >= 0]
            while len(at):
                fits = inside(self.doc[y], at)
                side[at[fits]] = y[fits]
                y = onward[y]
                on = ~fits & (y >= 0)
                at, y = at[on], y[on]
        return left, right, hit


def _first_k(item: np.ndarray, score: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each item: the highest scores, of equal ones the lowest documents."""
    order = np.lexsort((doc, -score, item))
    sorted_item = item[order]
    new = np.flatnonzero(np.concatenate([[True], sorted_item[1:] != sorted_item[:-1]])) if len(item) else np.zeros(0, int)
    nth = np.arange(len(item)) - np.repeat(new, np.diff(np.append(new, len(item))))
    return order[nth < k]


def top_k(treaps: Treaps, item: np.ndarray, term: np.ndarray, weight: np.ndarray, floor: np.ndarray, k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(item, document, score) of the k best of each item with a score of floor[item] at least, and the number of
    documents that were scored. Pairs of item and term come sorted by item.

    An interval of documents is looked at with one subtree of each term. Its roots' gains bound every document in
    it; if their sum cannot enter the item's k best, the subtrees are left unseen. Otherwise the document of the best root
    is scored and the interval is cut there. All intervals of all items advance together, level by level.
    """
    ks, kd = floor - 1, np.zeros(len(floor), np.int64)  # enters: a score above ks, or ks itself with a document below kd
    best = [np.zeros(0, np.int64)] * 3
    node = treaps.root[term]
    there = node >= 0
    node, w, row = node[there], weight[there], item[there]
    owner = np.unique(row)
    row = np.searchsorted(owner, row)
    lo, hi = np.full(len(owner), -1), np.full(len(owner), n_docs)
    seen = 0
    while len(owner):
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        part = w * treaps.gain[node]
        bound = np.add.reduceat(part, start)
        stays = (bound > ks[owner]) | ((bound == ks[owner]) & (lo + 1 < kd[owner]))
        if not stays.any():
            break
        if not stays.all():
            kept = stays[row]
            row, node, w, part = (np.cumsum(stays) - 1)[row[kept]], node[kept], w[kept], part[kept]
            owner, lo, hi = owner[stays], lo[stays], hi[stays]
            start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        doc = treaps.doc[node]
        pivot = np.minimum.reduceat(np.where(part == np.maximum.reduceat(part, start)[row], doc, n_docs), start)
        left, right, hit = treaps.split(node, lo[row], pivot[row], hi[row])
        score = np.add.reduceat(np.where(hit >= 0, w * treaps.gain[hit], 0), start)
        seen += len(owner)
        new = (score > ks[owner]) | ((score == ks[owner]) & (pivot < kd[owner]))
        if new.any():
            best = [np.concatenate(x) for x in zip(best, (owner[new], pivot[new], score[new]))]
            order = _first_k(best[0], best[2], best[1], k)
            best = [x[order] for x in best]
            full = np.flatnonzero(np.bincount(best[0], minlength=len(floor)) >= k)
            kth = np.searchsorted(best[0], full, "right") - 1
            ks[full], kd[full] = best[2][kth], best[1][kth]
        # the left and the right part of each interval
        sides = []
        for side, low, high in ((left, lo, pivot), (right, pivot, hi)):
            some = side >= 0
            has = np.zeros(len(owner), bool)
            has[row[some]] = True
            sides.append(((np.cumsum(has) - 1)[row[some]], side[some], w[some], owner[has], low[has], high[has]))
        a, b = sides
        row = np.concatenate([a[0], b[0] + len(a[3])])
        node, w, owner, lo, hi = (np.concatenate([a[i], b[i]]) for i in range(1, 6))
    return best[0], best[1], best[2], seen


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows, size = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            held.append(part)
            rows, size = rows + part.num_rows, size + part.nbytes
            if rows >= SHARD or size >= SHARD_BYTES:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


class Searcher:
    """One block of items against shards of documents, each with treaps of its own. The k-th score of what was met
    so far is the least that later shards return."""

    def __init__(self, words: list[str], owner: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int, n_docs: int, length: int, k: int):
        self.words, self.owner, self.term, self.weight = pa.array(words, pa.string()), owner, term, weight
        self.n_docs, self.length, self.k = n_docs, length, k
        self.floor = np.ones(n_items, np.int64)
        self.met = np.zeros((n_items, k), np.int64)  # the best scores, ascending
        self.scored = 0

    def search(self, shard: pa.Table) -> pa.RecordBatch | None:
        shard = shard.take(pc.sort_indices(shard.column("id"), null_placement="at_end"))
        row, at, term = _asked(shard.column("terms").combine_chunks(), self.words)
        if not len(row):
            return None
        tf = shard.column("tfs").combine_chunks().flatten().to_numpy()[at].astype(np.int64)
        m = np.array([50 + 50 * n * self.n_docs // self.length for n in shard.column("n").to_pylist()], np.int64)
        treaps = Treaps(term, row, 1_000_000_000 * tf // (1000 * tf + 20 * m[row]), len(self.words))
        found = []
        # items in runs that hold no more than FRONTIER postings here
        load = np.cumsum(np.bincount(self.owner, weights=treaps.size[self.term], minlength=len(self.floor)))
        start = 0
        while start < len(load):
            end = max(start + 1, int(np.searchsorted(load, (load[start - 1] if start else 0) + FRONTIER, "right")))
            a, b = np.searchsorted(self.owner, [start, end])
            item, doc, score, seen = top_k(treaps, self.owner[a:b] - start, self.term[a:b], self.weight[a:b], self.floor[start:end], self.k, len(shard))
            self.scored += seen
            found.append((item + start, doc, score))
            start = end
        item, doc, score = (np.concatenate(x) for x in zip(*found))
        for i in np.unique(item):  # item is sorted
            own = np.sort(np.concatenate([self.met[i], score[np.searchsorted(item, i) : np.searchsorted(item, i, "right")]]))
            self.met[i] = own[-self.k :]
        self.floor = np.maximum(self.met[:, 0], 1)
        return pa.RecordBatch.from_arrays([pa.array(item), shard.column("id").combine_chunks().take(pa.array(doc)), pa.array(score)], names=["item", "id", "score"])


def search(index: DataFrame, items: DataFrame, k: int = 50, item_col: str = "item_id", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(item, rank, id, score): the k documents of `index` (see index_documents) with the highest scores above 0 for
    each row of `items`, equal scores by ascending id, null ids last.

    A score sums, over the item's distinct terms, w * (10^9 tf div (1000 tf + 20 m)); w = floor(1000 ln((2 N + 2) / (2 df + 1)))
    and m = 50 + 50 n N div L, over the N documents that have terms (n of a document, L of all). Every document
    can be found by every item. Items without terms, null ones included, find nothing; rows of `items` that repeat are
    ranked each for itself, and so are documents that share an id; without documents or items the result is empty.

    Items are taken in blocks of some BLOCK pairs of item and term, which travel with the tasks. A task builds the
    treaps of the block's terms for some thousand documents at a time; the documents themselves are never shuffled.
    Tasks return k rows for each item at most, which are ranked in two steps.
    """
    spark = index.sparkSession
    scratch = Scratch(spark, "search")
    kind, item_kind = index.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    asked = items.select(items[item_col].alias("id"), items[text_col].alias("text")).mapInArrow(_count_terms, f"id {item_kind}, n long, terms string, tfs array<int>")
    asked = scratch.write(asked.where("n > 0").select(F.monotonically_increasing_id().alias("row"), "id", "terms", F.size("tfs").alias("size")), "items")
    held = index.where("n > 0")
    n_docs, length = held.agg(F.count("*"), F.sum("n")).first()
    blocks = -(-(asked.agg(F.sum("size")).first()[0] or 0) // BLOCK) if n_docs else 0
    found = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "terms").toPandas()
        if len(rows):
            found.append(scratch.write(_search_block(held, rows["row"].tolist(), [t.split() for t in rows["terms"]], n_docs, length, k, kind), f"found-{block}"))
    if not found:
        found = [spark.createDataFrame([], f"row long, id {kind}, score long, part int")]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = (F.desc("score"), F.asc_nulls_last("id"))
    for spread in (("row", F.pmod("part", F.lit(64))), ("row",)):
        every = every.withColumn("rank", F.row_number().over(Window.partitionBy(*spread).orderBy(*best))).where(F.col("rank") <= k)
    names = asked.select("row", F.col("id").alias("item"))
    return every.join(names, "row").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(held: DataFrame, rows: list[int], terms: list[list[str]], n_docs: int, length: int, k: int, kind: str) -> DataFrame:
    words = sorted({t for ts in terms for t in ts})
    number = {t: i for i, t in enumerate(words)}

    def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = pa.array(words, pa.string()), np.zeros(len(words), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                count += np.bincount(_asked(batch.column(0).slice(at, 512), known)[2], minlength=len(words))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["term", "df"])

    df = held.select("terms").mapInArrow(document_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # one row a word
    frequency = dict(zip(df["term"].tolist(), df["df"].tolist()))
    weigh = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency.get(i, 0) + 1))) for i in range(len(words))], np.int64)
    owner = np.repeat(np.arange(len(rows)), list(map(len, terms)))
    term = np.array([number[t] for ts in terms for t in ts], np.int64)
    useful = weigh[term] > 0
    owner, term = owner[useful], term[useful]
    row_of = np.array(rows, np.int64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(words, owner, term, weigh[term], len(row_of), n_docs, length, k)
        for shard in _shards(batches):
            if (got := searcher.search(shard)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(row_of[got.column(0).to_numpy()]), got.column(1), got.column(2)], names=["row", "id", "score"])

    return held.mapInArrow(find, f"row long, id {kind}, score long").withColumn("part", F.spark_partition_id())
