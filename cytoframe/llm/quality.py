"""Quality classifier: attention-based multiple-instance learning over a document's passages."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import held_out, labelled_sample

PASSAGE = 48  # words
SLICE = 2048  # passages that are encoded at once
N_BYTES, N_MORE, N_HASH = 97, 8, 512
N_PLAIN = N_BYTES + N_MORE
EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

Bag = tuple[np.ndarray, np.ndarray]  # plain features (float32) and hashed words (uint8 counts) of passages, one row each


class Buckets:
    """The hash buckets of a word: of the whole word, lower-cased and without punctuation at its ends, and of its first four bytes."""

    def __init__(self, most: int = 100_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.most:
            self.known.clear()
        for w in set(words).difference(self.known):
            plain = w.strip(EDGE).lower()
            self.known[w] = xxhash.xxh32_intdigest(plain, 1) % N_HASH * N_HASH + xxhash.xxh32_intdigest(plain[:4], 2) % N_HASH
        return np.divmod(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)), N_HASH)


@functools.cache
def buckets() -> Buckets:
    """One for each worker process."""
    return Buckets()


def passages(text: str) -> Iterator[Bag]:
    """The passages (48 words) of a whole text, up to SLICE at a time: shares of the printable bytes, word statistics
    and hashed words. A text without words is one passage of zeros."""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    if not n:
        yield np.zeros((1, N_PLAIN), np.float32), np.zeros((1, N_HASH), np.uint8)
        return
    for lo in range(0, n, SLICE * PASSAGE):
        yield encode(words[lo : lo + SLICE * PASSAGE], n, words[lo + SLICE * PASSAGE] if lo + SLICE * PASSAGE < n else None)


def encode(words: list[bytes], n_words: int, following: bytes | None = None) -> Bag:
    """Features of successive passages of words that stand in a text of `n_words`, before the word `following`."""
    n = len(words)
    count = -(-n // PASSAGE)
    owner = np.arange(n) // PASSAGE
    length = np.fromiter(map(len, words), np.int64, n)
    a = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    cls = np.where(a > 126, 96, np.maximum(a, 31) - 31).astype(np.int64)
    hist = np.bincount(np.repeat(owner, length + 1) * N_BYTES + cls, minlength=count * N_BYTES).reshape(count, N_BYTES).astype(np.float32)
    hist[:, 0] = 0  # control characters
    out = np.empty((count, N_PLAIN), np.float32)
    out[:, :N_BYTES] = np.sqrt(hist / np.maximum(hist.sum(axis=1, keepdims=True), 1))
    same = np.fromiter((x == y for x, y in zip(words, words[1:])), np.float32, n - 1) if n > 1 else np.zeros(0, np.float32)
    upper = np.fromiter(map(bytes.isupper, words), np.float32, n)
    lo = np.arange(0, n, PASSAGE)
    size = np.diff(np.r_[lo, n]).astype(np.float32)
    add = lambda x: np.add.reduceat(x.astype(np.float32), lo) / size
    more = out[:, N_BYTES:]
    more[:, 0] = add(upper)
    more[:, 1] = add(np.r_[same, words[-1] == following])
    more[:, 2] = add(length) / 10
    more[:, 3] = np.sqrt(np.maximum(add(length**2) - add(length) ** 2, 0)) / 10
    more[:, 4] = [len(set(words[i : i + PASSAGE])) / min(PASSAGE, n - i) for i in lo]
    more[:, 5] = add(length == 1)
    more[:, 6] = np.log1p(size) / 4
    more[:, 7] = np.minimum(np.log1p(n_words) / 8, 2)
    whole, stem = buckets().of(words)
    hashed = np.bincount(np.r_[owner * N_HASH + whole, owner * N_HASH + stem], minlength=count * N_HASH)
    return out, hashed.reshape(count, N_HASH).astype(np.uint8)


def features(bag: Bag) -> np.ndarray:
    plain, hashed = bag
    share = np.sqrt(hashed / np.maximum(hashed.sum(axis=1, keepdims=True, dtype=np.float32), 1))
    return np.concatenate([plain, share.astype(np.float32)], axis=1)


class AttentionMIL:
    """h = tanh(E x); attention softmax over passages of w . (tanh(V h) * sigmoid(U h)); score = sigmoid(c . sum a h + b).

    Gated attention of Ilse, Tomczak and Welling (2018), trained with Adam on bags of passages, in NumPy. E projects
    the hashed words and the plain features of a passage together.
    """

    def __init__(self, d: int, hidden: int = 24, gate: int = 12, seed: int = 5):
        r = np.random.default_rng(seed)
        s = lambda m, n: r.normal(0, 1 / np.sqrt(m), (m, n))
        self.p = {"E": s(d, hidden), "e": np.zeros(hidden), "V": s(hidden, gate), "U": s(hidden, gate), "w": s(gate, 1)[:, 0], "c": s(hidden, 1)[:, 0], "b": np.zeros(1)}
        self.mean, self.std = np.zeros(d), np.ones(d)

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.std @ self.p["E"] + self.p["e"])

    def attend(self, h: np.ndarray, start: np.ndarray) -> dict:
        p = self.p
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
        raw = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(h)]))
        ex = np.exp(raw - np.maximum.reduceat(raw, start)[bag])
        att = ex / np.add.reduceat(ex, start)[bag]
        z = np.add.reduceat(att[:, None] * h, start)
        return {"t": t, "g": g, "att": att, "bag": bag, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))}

    def loss(self, x: np.ndarray, start: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
        s = self.attend(self.hidden(x), start)["score"]
        return float(-(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).mean())

    def gradient(self, x: np.ndarray, start: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean log loss, for every parameter."""
        p, h = self.p, self.hidden(x)
        f = self.attend(h, start)
        ds = (f["score"] - y) * weight / len(y)
        dz = ds[:, None] * p["c"]
        att, bag = f["att"], f["bag"]
        da = (dz[bag] * h).sum(axis=1)
        draw = att * (da - np.add.reduceat(att * da, start)[bag])
        dtg = draw[:, None] * p["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = (att[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
        own = (x - self.mean) / self.std
        return {"E": own.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (f["t"] * f["g"]).T @ draw, "c": f["z"].T @ ds, "b": np.array([ds.sum()])}

    def fit(self, bags: list, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01, decay: float = 1e-3, seed: int = 6, read=lambda b: b) -> None:
        """`read` makes the rows of features of a bag, which are held for one batch only."""
        p, r = self.p, np.random.default_rng(seed)
        n, total, square = 0, 0.0, 0.0
        for b in bags:
            x = read(b).astype(float)
            n, total, square = n + len(x), total + x.sum(axis=0), square + (x**2).sum(axis=0)
        self.mean = total / n
        self.std = np.maximum(np.sqrt(np.maximum(square / n - self.mean**2, 0)), 0.02)
        weight = np.where(y == 1, len(y) / max(2 * y.sum(), 1), len(y) / max(2 * (1 - y).sum(), 1))
        m, v, k = {n: np.zeros_like(a) for n, a in p.items()}, {n: np.zeros_like(a) for n, a in p.items()}, 0
        for epoch in range(epochs):
            order = r.permutation(len(bags))
            for lo in range(0, len(bags), batch):
                pick = order[lo : lo + batch]
                xs = [read(bags[i]) for i in pick]
                size = np.array([len(x) for x in xs])
                grad = self.gradient(np.concatenate(xs), np.cumsum(size) - size, y[pick], weight[pick])
                k += 1
                lr = rate * (1 - epoch / epochs) + 1e-4
                for n, g in grad.items():
                    g = g + decay * p[n]
                    m[n] = 0.9 * m[n] + 0.1 * g
                    v[n] = 0.999 * v[n] + 0.001 * g * g
                    p[n] -= lr * (m[n] / (1 - 0.9**k)) / (np.sqrt(v[n] / (1 - 0.999**k)) + 1e-8)

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, the passage of each document with most attention, and the numbers of passages."""
        return self._score([[self.hidden(b)] for b in bags])

    def score_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of whole texts; a slice of a long text leaves only its hidden rows behind."""
        ready, waiting, room = [], [], 0
        for t in texts:
            own = []
            for bag in passages(t):
                waiting.append((own, bag))
                room += len(bag[0])
                if room >= SLICE:
                    self._encode(waiting)
                    waiting, room = [], 0
            ready.append(own)
        self._encode(waiting)
        return self._score(ready)

    def _encode(self, waiting: list) -> None:
        if waiting:
            h = self.hidden(np.concatenate([features(bag) for _, bag in waiting]))
            for (own, _), part in zip(waiting, np.split(h, np.cumsum([len(bag[0]) for _, bag in waiting])[:-1])):
                own.append(part)

    def _score(self, hidden: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([sum(map(len, parts)) for parts in hidden], int)
        if not len(size):
            return np.empty(0), np.empty(0, int), size
        start = np.cumsum(size) - size
        f = self.attend(np.concatenate([x for parts in hidden for x in parts]), start)
        return f["score"], np.array([int(np.argmax(f["att"][s : s + n])) for s, n in zip(start, size)]), size


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1500) -> AttentionMIL | None:
    """Train on at most `per_class` labelled training rows of each class, chosen by a hash of the id alone.

    Every text of the sample is learnt from whole, all its passages in one bag: the driver gets 932 bytes for every 48
    words of these 2 * `per_class` texts. An id is one row of the sample; null texts are empty; other columns are not
    read. None if a class has no row.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bags = [[np.concatenate(x) for x in zip(*passages(t))] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "plain": [b[0].astype("<f4").tobytes() for b in bags], "hashed": [b[1].tobytes() for b in bags]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = labelled_sample(docs, labels, label, per_class).mapInPandas(cut, f"doc_id {kind}, y int, plain binary, hashed binary").orderBy("doc_id", "y").toArrow()
    y = got["y"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return None
    bags = [(np.frombuffer(p.as_buffer(), "<f4").reshape(-1, N_PLAIN), np.frombuffer(h.as_buffer(), np.uint8).reshape(-1, N_HASH)) for p, h in zip(got["plain"], got["hashed"])]
    model = AttentionMIL(N_PLAIN + N_HASH)
    model.fit(bags, y, read=features)
    return model


def score_quality(docs: DataFrame, model: AttentionMIL | None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages, key_passage) of every whole text, row by row.

    key_passage is the number of the passage with most attention (the first, where several tie). Null and empty texts
    are one passage of zeros and get its score; without a model every score is 0.5. Texts of any length are encoded
    slice by slice. Repeated rows are scored each; an empty table gives none; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blank = AttentionMIL(N_PLAIN + N_HASH)
        for batch in batches:
            for lo in range(0, len(batch), 128):
                part = batch.iloc[lo : lo + 128]
                score, key, size = (shared.value or blank).score_texts([t or "" for t in part["text"]])
                if shared.value is None:
                    score, key = np.full(len(part), 0.5), np.zeros(len(part), int)
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": score, "n_passages": size, "key_passage": key})

    out = docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double, n_passages long, key_passage long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages", "key_passage")


def keep_good(docs: DataFrame, model: AttentionMIL | None, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score (see `score_quality`) is at least the threshold.

    Without a model all stay. Every row is judged by its own text: repeated rows stay or go together, null and empty
    texts are scored as such.
    """
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = (texts.slice(lo, 128).to_pylist() for lo in range(0, len(texts), 128))
        return pa.array(np.concatenate([np.empty(0), *(shared.value.score_texts([t or "" for t in part])[0] for part in parts)]))

    return docs.where(score("text") >= threshold)
