"""Toxicity by the nearest labelled examples: exact cosine of label-weighted TF-IDF over a block-max inverted index."""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, held_out, labelled_sample, unpacked_row, whole_row
from .words import WordTable

BATCH = 256  # texts that are cut and searched at once

Counts = tuple[np.ndarray, np.ndarray]  # terms in ascending order, occurrences of each


def counted(table: WordTable, texts: list[str] | pa.Array, none: int) -> Iterator[Counts]:
    """Terms (all numbers but `none`) of whole texts with their occurrences."""
    for slots in table.slots(texts):
        t = table.rows[slots].ravel()
        t = t[t != none]
        t.sort()
        ends = np.empty(len(t), bool)
        ends[-1:] = True
        np.not_equal(t[1:], t[:-1], out=ends[:-1])
        last = np.flatnonzero(ends)
        n = last.astype(np.int32)
        n[1:] -= n[:-1].copy()
        n[:1] += 1
        yield t[last], n


def in_vocabulary(codes: np.ndarray):
    """Term numbers for hashes: places in the sorted vocabulary, -1 for what is not in it."""

    def resolve(hashes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.full(hashes.shape, -1, np.int32)
        flat = hashes.ravel()
        by = np.argsort(flat)  # in order, as the search then stays in the cache
        at = np.empty(len(flat), np.int64)
        at[by] = np.minimum(np.searchsorted(codes, flat[by]), len(codes) - 1)
        return np.where(codes[at] == flat, at, -1).astype(np.int32).reshape(hashes.shape)

    return resolve


class BlockMaxIndex:
    """Unit vectors of examples (TF-IDF under the given weights of terms) in an inverted index whose postings are
    cut into blocks of examples with their largest weight.

    Examples of like common terms, of one label and of like length lie side by side, so that blocks differ in what
    they can reach. Postings of rare terms are sparse and always added up. Terms that more than one example in
    `often` holds are kept as dense runs by block, and read only for blocks that can still win: a block's bound is its
    best sum of rare terms plus the largest weights of its common ones, and blocks that cannot beat the k-th best
    cosine are passed over. Texts are searched many at a time, so that a run is read once for all that need it.
    No term is left out: the result is exact (in single precision).
    """

    def __init__(self, rows: list[Counts], labels: np.ndarray, idf: np.ndarray, block: int = 64, often: int = 24):
        self.idf, self.block, self.often, self.size = np.asarray(idf, float), block, often, len(rows)
        self.blocks = -(-len(rows) // block) or 1
        length = np.array([len(t) for t, _ in rows], int)
        term = np.concatenate([np.empty(0, np.int32), *(t for t, _ in rows)])
        n = np.concatenate([np.empty(0, np.int32), *(c for _, c in rows)])
        example = np.repeat(np.arange(self.size, dtype=np.int32), length)
        self.held = np.bincount(term, minlength=len(self.idf)).astype(np.int32)
        column, common = self._common()
        dense, use = np.zeros((self.size, common), np.float32), column[term] >= 0
        dense[example[use], column[term[use]]] = ((1 + np.log(n[use])) * self.idf[term[use]])
        dense /= np.maximum(np.sqrt(np.bincount(example, ((1 + np.log(n)) * self.idf[term]) ** 2, self.size)), 1e-300)[:, None]
        self.ids = np.lexsort((length, labels, clusters(dense)))
        self.labels = np.asarray(labels)[self.ids]
        place = np.empty(self.size, np.int32)
        place[self.ids] = np.arange(self.size)
        by = np.lexsort((place[example], term))
        self.place, self.n = narrow(place[example[by]]), narrow(n[by])
        self.runs = None

    def _common(self) -> tuple[np.ndarray, int]:
        """The column of each common term among the dense runs (-1: rare), and their number."""
        common = np.flatnonzero(self.held > self.size / self.often)
        column = np.full(len(self.held), -1, np.int32)
        column[common] = np.arange(len(common))
        return column, len(common)

    def _ready(self) -> None:
        """Weights, sparse postings, dense runs and their peaks, made from the counts where a search first needs them."""
        if self.runs is not None:
            return
        self.column, common = self._common()
        ends = np.cumsum(self.held, dtype=np.int64)
        step = max(1, len(self.held) // 16)  # terms at once, so that little is held twice

        def parts():
            for lo in range(0, len(self.held), step):
                begin, end = (ends[lo - 1] if lo else 0), ends[min(lo + step, len(ends)) - 1]
                term = np.repeat(np.arange(lo, min(lo + step, len(ends))), self.held[lo : lo + step])
                yield term, self.place[begin:end].astype(np.int64), (1 + np.log(self.n[begin:end].astype(np.float32))) * self.idf[term]

        norm = np.zeros(self.size)
        for _, place, w in parts():
            norm += np.bincount(place, w * w, self.size)
        norm = np.sqrt(norm)
        entries, postings = [], [np.empty(0, np.int64)]
        for term, place, w in parts():
            w, c = (w / norm[place]).astype(np.float32), self.column[term]
            entries.append((place[c >= 0].astype(np.int32), c[c >= 0], w[c >= 0]))
            # place and weight of a posting side by side, so that one read gets both
            postings.append(np.stack([place[c < 0].astype(np.int32), w[c < 0].view(np.int32)], axis=1).view(np.int64).ravel())
        self.posting = np.concatenate(postings)
        self.begin = np.r_[0, np.cumsum(np.where(self.column < 0, self.held, 0), dtype=np.int64)]
        place, column, weight = (np.concatenate(x) for x in zip(*entries)) if entries else (np.empty(0, int),) * 3
        by = np.argsort(place, kind="stable")
        place, column, weight = place[by], column[by], weight[by]
        cuts = np.searchsorted(place, np.arange(self.blocks + 1) * self.block)
        self.peak, self.runs = np.zeros((common, self.blocks), np.float32), []
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):  # a block keeps the columns that its examples have
            own, at = np.unique(column[lo:hi], return_inverse=True)
            dense = np.zeros((len(own), self.block), np.float32)
            dense[at.ravel(), place[lo:hi] - b * self.block] = weight[lo:hi]
            self.peak[own, b] = dense.max(axis=1, initial=0)
            self.runs.append((own, dense))

    def __getstate__(self) -> dict:
        """Only counts travel, three bytes or so for a posting."""
        return {k: v for k, v in self.__dict__.items() if k not in ("posting", "begin", "column", "peak")} | {"runs": None}

    def weigh(self, terms: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(n)) * self.idf[terms]
        norm = math.sqrt(float(w @ w))
        return (terms, w / norm) if norm else (terms[:0], w[:0])

    def search(self, queries: list[Counts], k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and places of the k nearest examples, a row for each query (ties: the lower place); 0 and -1 stand
        where no more examples share a term. `skip` names an example for each query that does not count."""
        if not self.size or not queries:
            return np.zeros((len(queries), k)), np.full((len(queries), k), -1)
        self._ready()
        n, width, slack = len(queries), self.blocks * self.block, 1e-4
        score, q = np.empty((n, width), np.float32), np.zeros((n, len(self.peak)), np.float32)
        steps = np.arange(1 << 17)
        for i, counts in enumerate(queries):
            t, w = self.weigh(*counts)
            column = self.column[t]
            q[i, column[column >= 0]] = w[column >= 0]
            lo = self.begin[t]
            size = self.begin[t + 1] - lo
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            if total > len(steps):
                steps = np.arange(2 * total)
            at = np.repeat(lo - ends + size, size)
            at += steps[:total]
            both = self.posting[at].view(np.int32).reshape(-1, 2)
            score[i] = np.bincount(both[:, 0], np.repeat(w.astype(np.float32), size) * both.view(np.float32)[:, 1], width)
        if skip is not None:
            where = np.empty(self.size, int)
            where[self.ids] = np.arange(self.size)
            score[np.arange(n), where[skip]] = -np.inf
        bound = score.reshape(n, self.blocks, self.block).max(axis=2) + q @ self.peak + slack
        order = np.argsort(-bound, axis=1, kind="stable")
        rank = np.argsort(order, axis=1)
        known, least = np.zeros((n, self.blocks), bool), np.zeros(n, np.float32)
        exact = np.full((n, self.blocks, self.block), -np.inf, np.float32)
        parts = score.reshape(exact.shape)
        for reach in (2, 8, 24, self.blocks):
            need = (rank < reach) & ~known & (bound > slack) & (bound >= least[:, None])
            for b in np.flatnonzero(need.any(axis=0)):
                who = np.flatnonzero(need[:, b])
                own, dense = self.runs[b]
                exact[who, b] = parts[who, b] + np.take(q[who], own, axis=1) @ dense
            known |= need
            if k < reach * self.block and reach < self.blocks:  # the k-th best of the blocks read so far
                best = np.take_along_axis(exact, order[:, :reach, None], axis=1).reshape(n, -1)
                least = np.maximum(np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k], 0)
        exact = exact.reshape(n, width)
        i, p = np.nonzero((exact >= least[:, None]) & (exact > 0))
        cos = exact[i, p]
        by = np.argsort(i * 4.0 - cos, kind="stable")  # by query, then by falling cosine; places ascend already
        i, p, cos = i[by], p[by], cos[by]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        i, p, cos, nth = i[nth < k], p[nth < k], cos[nth < k], nth[nth < k]
        cosine, place = np.zeros((n, k)), np.full((n, k), -1)
        cosine[i, nth], place[i, nth] = cos, p
        return cosine, place


def narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers, 0 or more, in as few bytes as the largest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def clusters(rows: np.ndarray, k: int = 8, rounds: int = 6) -> np.ndarray:
    """A number 0..k-1 for each row: spherical k-means from evenly spaced rows."""
    if len(rows) <= k or not rows.shape[1]:
        return np.zeros(len(rows), int)
    centre = rows[np.linspace(0, len(rows) - 1, k).astype(int)]
    for _ in range(rounds):
        own = np.argmax(rows @ centre.T, axis=1)
        centre = np.stack([rows[own == j].sum(axis=0) for j in range(k)])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
    return own


class ToxicityModel:
    """What a task needs to score texts: vocabulary, index, calibration and the keys of the examples."""

    def __init__(self, codes: np.ndarray, rows: list[Counts], labels: list[int], keys: list, df: np.ndarray, n_docs: int, weights: tuple[float, float] = (1.0, 1.0), k: int = 15):
        self.codes, self.k, self.keys = codes, k, keys
        y = np.asarray(labels, float)
        self.weights = np.array(weights)  # of an example of either class: how many labelled rows it stands for
        rate = self.weights[y.astype(int)]
        idf = np.log((n_docs + 1) / (df + 1)) + 1
        self.prior = ((rate * y).sum() + 1) / (rate.sum() + 2)
        empty = np.array([not len(r[0]) for r in rows], bool)
        self.silent = ((rate * y)[empty].sum() + self.prior) / (rate[empty].sum() + 1)  # texts without any known term
        keep = np.flatnonzero(~empty)
        self.index = BlockMaxIndex([rows[e] for e in keep], y[keep], idf * np.sqrt(1 + label_strength(rows, y, len(codes))))
        self.keep = keep
        self.a, self.b = 1.0, 0.0
        if len(keep) > k:  # calibration on votes that leave the example itself out
            votes = []
            for lo in range(0, len(keep), BATCH):
                own = np.arange(lo, min(lo + BATCH, len(keep)))
                votes.append(self.votes(*self.index.search([rows[e] for e in keep[own]], k, skip=own)))
            self.a, self.b = platt(logit(np.concatenate(votes)), y[keep], rate[keep])

    def table(self) -> WordTable:
        """One for each task: the words that its texts have in common are looked up once."""
        return WordTable(in_vocabulary(self.codes))

    def votes(self, cosine: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Votes weighted by the reciprocal square of the distance, and one vote for the prior, for each row."""
        label = np.where(place >= 0, self.index.labels[place], 0) if self.index.size else np.zeros(place.shape)
        w = np.where(place >= 0, self.weights[label.astype(int)] / (1.05 - np.minimum(cosine, 1)) ** 2, 0)
        return (self.prior + (w * label).sum(axis=1)) / (1 + w.sum(axis=1))

    def score_counts(self, counts: list[Counts]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The scores of texts, and their nearest examples: cosines and places, a row for each text."""
        cosine, place = self.index.search(counts, self.k)
        score = 1 / (1 + np.exp(-(self.a * logit(self.votes(cosine, place)) + self.b)))
        return np.where(np.fromiter((len(terms) > 0 for terms, _ in counts), bool, len(counts)), score, self.silent), cosine, place

    def score_packed(self, terms: list, n: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of written vectors, a batch at a time."""
        got = [self.score_counts([(unpacked(t), planes(m)) for t, m in zip(terms[lo : lo + BATCH], n[lo : lo + BATCH])]) for lo in range(0, max(len(terms), 1), BATCH)]
        return tuple(np.concatenate(x) for x in zip(*got))

    def example(self, place: np.ndarray) -> np.ndarray:
        """Numbers of examples (into `keys`) at places of the index."""
        return self.keep[self.index.ids[place]]

    def score(self, texts: list[str]) -> list[tuple[float, list[tuple]]]:
        """The score of each text, and its three nearest examples (key, cosine, label)."""
        score, cosine, place = self.score_counts(list(counted(self.table(), texts, -1)))
        near = [[(self.keys[self.example(p)], float(c), int(self.index.labels[p])) for c, p in zip(*row) if p >= 0] for row in zip(cosine[:, :3], place[:, :3])]
        return list(zip(score.tolist(), near))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (0.1 at least) and intercept of a weighted logistic fit with a ridge around (1, 0), by damped Newton steps."""

    def loss(t: np.ndarray) -> float:
        z = t[0] * x + t[1]
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * ((t[0] - 1) ** 2 + t[1] ** 2))

    t = np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(t[0] * x + t[1], -30, 30)))
        g = np.array([(weight * (q - y) * x).sum() + t[0] - 1, (weight * (q - y)).sum() + t[1]])
        w = weight * q * (1 - q)
        step = np.linalg.solve(np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]]), g)
        size = 1.0
        while loss(t - size * step) > loss(t) and size > 1e-6:
            size /= 2
        t = t - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(float(t[0]), 0.1), float(t[1])


def label_strength(rows: list, y: np.ndarray, n_terms: int) -> np.ndarray:
    """How much each term's presence tells about the label: the likelihood ratio G2 over the examples, 0 or more."""

    def holding(of: list) -> np.ndarray:
        return sum((np.bincount(r[0], minlength=n_terms) for r in of), np.zeros(n_terms))

    pos, neg = holding([r for r, v in zip(rows, y) if v]), holding([r for r, v in zip(rows, y) if not v])
    n_pos, n = float((y > 0).sum()), len(rows)
    if not 0 < n_pos < n:
        return np.zeros(n_terms)

    def part(observed: np.ndarray, total: float) -> np.ndarray:
        expected = (pos + neg) * (total / n)
        terms = ((observed, expected), (total - observed, total - expected))
        return sum(o * np.log(np.where(o > 0, o, 1) / np.where(o > 0, e, 1)) for o, e in terms)

    return np.maximum(2 * (part(pos, n_pos) + part(neg, n - n_pos)), 0)


def packed(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as planes of bytes, as many as the largest number needs."""
    need = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([need]) + np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4)[:, :need].T.tobytes()


def planes(b: bytes) -> np.ndarray:
    x = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    out = np.zeros((x.shape[1], 4), np.uint8)
    out[:, : b[0]] = x.T
    return out.view("<u4").ravel()


def unpacked(terms: bytes) -> np.ndarray:
    return np.cumsum(planes(terms), dtype=np.int64).astype(np.int32)


def vectorise(docs: DataFrame, codes, carry: tuple[str, ...]) -> DataFrame:
    """(row, terms, n): the columns `carry` as one struct, and the known terms of every whole text (steps between them)
    with their occurrences."""

    @F.arrow_udf("struct<t:binary,n:binary>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = WordTable(in_vocabulary(codes.value))
        for texts in batches:
            terms, n = [], []
            for lo in range(0, len(texts), BATCH):
                for t, c in counted(table, pc.fill_null(texts.slice(lo, BATCH), ""), -1):
                    terms.append(packed(np.diff(t, prepend=0)))
                    n.append(packed(c))
            yield pa.StructArray.from_arrays([pa.array(terms, pa.binary()), pa.array(n, pa.binary())], ["t", "n"])

    return docs.select(whole_row(docs, carry).alias("row"), cut("text").alias("v")).select("row", F.col("v.t").alias("terms"), F.col("v.n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 4000, k: int = 15, carry: tuple[str, ...] = ("doc_id",)) -> tuple[ToxicityModel, DataFrame]:
    """A model, and all rows (their columns `carry` as the struct `row`) with their sparse vectors, a written table that it scores.

    Learns from a sample of at most `per_class` labelled training rows of each class (chosen by a hash of the id).
    Every term of the sample is indexed. Document frequencies are counted over all documents. A term's weight is
    its TF-IDF times the root of 1 + G2, so that terms which tell about the label count for more and none is lost.
    One task builds the index from the 2 * `per_class` sparse vectors; the driver gets the finished model and one count
    for each term. Every text is cut into words once: frequencies and scores come from the written vectors.
    Rows of one text and label are one example, an id is one row of the sample; null texts are empty. With an empty
    table or sample every score is the prior of 0.5 under no evidence. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    sample = labelled_sample(docs, labels, label, per_class).dropDuplicates(["text", "y"])
    train = labels.where(~held_out(F.col("doc_id"))).groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).where("y in (0, 1)")
    stands = {r["y"]: r["n"] for r in train.collect()}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = WordTable(lambda hashes: hashes)
        for batch in batches:
            found = list(counted(table, list(batch["text"]), 0))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "t": [f[0].astype("<u8").tobytes() for f in found], "n": [f[1].astype("<i4").tobytes() for f in found]})

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.unique(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(t, "<u8") for t in batch["t"])]))
            yield pd.DataFrame({"code": found.view(np.int64)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    examples = scratch.write(sample.mapInPandas(cut, f"doc_id {kind}, y int, t binary, n binary"), "examples")
    codes = np.sort(examples.select("t").mapInPandas(distinct, "code long").distinct().toArrow()["code"].to_numpy().view(np.uint64))
    known = spark.sparkContext.broadcast(codes)
    vectors = scratch.write(vectorise(docs, known, carry), "vectors", compression="zstd")

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            n += len(batch)
            for terms in batch["terms"]:
                df[unpacked(terms.as_buffer())] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, held].astype(np.int32)), pa.array(np.r_[n, df[held]])], ["t", "n"])

    n_terms = len(codes)
    counts = vectors.select("terms").mapInArrow(frequency, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(codes) + 1)  # the last: all documents
    df[counts["t"].to_numpy()] = counts["n"].to_numpy()
    del counts

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The whole (bounded) sample in one task, so that the driver need not hold it."""
        rows, y, keys = [], [], []
        for batch in batches:
            y += batch["y"].tolist()
            keys += batch["doc_id"].tolist()
            rows += [(np.searchsorted(known.value, np.frombuffer(t, "<u8")).astype(np.int32), np.frombuffer(n, "<i4").copy()) for t, n in zip(batch["t"], batch["n"])]
        have = Counter(y)
        weights = tuple(max(1.0, stands.get(v, 0) / max(have[v], 1)) for v in (0, 1))
        whole = pickle.dumps(ToxicityModel(known.value, rows, y, keys, df[:-1], int(df[-1]), weights, k), protocol=5)
        for lo in range(0, len(whole), 1 << 24):
            yield pd.DataFrame({"lo": [lo], "part": [whole[lo : lo + (1 << 24)]]})

    made = examples.repartition(1).sortWithinPartitions("doc_id", "y", "t", "n").mapInPandas(build, "lo long, part binary").toArrow().sort_by("lo")
    if not made.num_rows:  # an empty sample gives its task no rows
        return ToxicityModel(codes, [], [], [], df[:-1], int(df[-1]), (1.0, 1.0), k), vectors
    return pickle.loads(b"".join(x.as_buffer() for x in made["part"])), vectors


def score_toxicity(vectors: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every row of a table of vectors (see `fit`).

    evidence: the three nearest labelled examples (doc_id, cosine, label); of equal cosines the earlier example in the
    index's order. A null, empty or term-free text has no neighbour and gets the rate of such examples. Repeated rows
    are scored each; an empty table gives none; other columns are not read. The model has a bounded size and is broadcast.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    id_type = vectors.schema["row"].dataType["doc_id"].dataType
    kind, batch_type = id_type.simpleString(), to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        keys = pa.array(model.keys, batch_type)
        for batch in batches:
            score, cosine, place = model.score_packed([x.as_buffer() for x in batch["terms"]], [x.as_buffer() for x in batch["n"]])
            cosine, place = cosine[:, :3], place[:, :3]
            found = place >= 0
            p = place[found]
            example = pa.array(model.example(p) if len(p) else np.empty(0, int), pa.int64())
            near = [keys.take(example), pa.array(cosine[found]), pa.array(model.index.labels[p].astype(np.int32) if len(p) else np.empty(0, np.int32))]
            ends = np.r_[0, np.cumsum(found.sum(axis=1))].astype(np.int32)
            evidence = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(near, ["doc_id", "cosine", "label"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score), evidence], ["doc_id", "score", "evidence"])

    out = vectors.select("row.doc_id", "terms", "n").mapInArrow(run, f"doc_id {kind}, score double, evidence array<struct<doc_id:{kind},cosine:double,label:int>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def keep_clean(vectors: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of a table of vectors (see `fit`), with its carried columns, whose score is below the threshold.

    Every row is judged by its own text: repeated rows stay or go together, null and empty texts are scored as such.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(terms: pa.Array, n: pa.Array) -> pa.Array:
        return pa.array(shared.value.score_packed([x.as_buffer() for x in terms], [x.as_buffer() for x in n])[0])

    return vectors.where(score("terms", "n") < threshold).select(*unpacked_row(vectors, "row"))
