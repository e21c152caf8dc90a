"""The training-data operators against brute force, round trips, held-out accuracy and awkward inputs."""

import base64
import hashlib
import pickle
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers as public
from cytoframe.llm import byte_bpe, chat_format, embedding_dedup, fingerprint, license_scan, minhash_dedup, packing, quality, queries, toxicity, url_filter
from cytoframe.llm.words import STEMS, WORD, WordTable, term_hashes

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long, sig string, rep long"
AWKWARD = [(1, None), (2, ""), (3, "one"), (4, "word " * 30_000), (5, "same text of five words or so"), (6, "same text of five words or so"), (6, "same text of five words or so"), (None, "no id here at all ok"), (7, " \t\n"), (8, "Ünï [INST] </s> \\<s>")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, "en", None, 1, "x", 9) for i, t in AWKWARD], DOC)


def accuracy(scored, labels, label):
    r = scored.where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return np.mean([a == b for a, b in r])


def test_quality_held_out(spark, docs, labels):
    model = quality.fit(docs, labels)
    scored = quality.score_quality(docs, model)
    assert accuracy(scored, labels, "quality") > 0.93
    assert scored.count() == docs.count()
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in scored.where("predicted = 1").select("doc_id").collect()}


def test_quality_finds_the_telling_passage():
    r = np.random.default_rng(1)
    bags, y = [], []
    for i in range(200):  # one telling passage among others
        b = r.normal(size=(r.integers(1, 6), 5)).astype(np.float32)
        if i % 2:
            b[r.integers(len(b)), 0] += 6
        bags.append(b)
        y.append(i % 2)
    m = quality.AttentionMIL(5)
    m.fit(bags, np.array(y, float))
    assert np.mean((m.score(bags)[0] > 0.5) == y) > 0.95


def test_quality_forward_and_gradient():
    """Scores by plain loops; every gradient by finite differences."""
    r = np.random.default_rng(7)
    m = quality.AttentionMIL(6, hidden=5, gate=4)
    m.mean, m.std = r.normal(size=6), r.uniform(0.5, 2, 6)
    bags = [r.normal(size=(n, 6)) for n in (1, 4, 2, 7)]
    y, weight = np.array([1.0, 0, 0, 1]), np.array([0.5, 2, 1, 1])
    p = m.p
    for bag, got in zip(bags, m.score(bags)[0]):
        h = [np.tanh(((x - m.mean) / m.std) @ p["E"] + p["e"]) for x in bag]
        raw = [sum(p["w"][k] * np.tanh(z @ p["V"][:, k]) / (1 + np.exp(-(z @ p["U"][:, k]))) for k in range(4)) for z in h]
        a = np.exp(raw) / np.exp(raw).sum()
        assert abs(got - 1 / (1 + np.exp(-(sum(w * z for w, z in zip(a, h)) @ p["c"] + p["b"][0])))) < 1e-9
    x, start = np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])])
    grad = m.gradient(x, start, y, weight)
    for name, g in grad.items():
        flat = p[name].reshape(-1)
        for k in range(len(flat)):
            old, step = flat[k], 1e-6
            flat[k] = old + step
            up = m.loss(x, start, y, weight)
            flat[k] = old - step
            down = m.loss(x, start, y, weight)
            flat[k] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[k]) < 1e-6


def test_quality_of_long_texts(spark, monkeypatch):
    """A text cut in slices scores as one; a class of long texts alone is learnt and told apart."""
    r = random.Random(2)
    texts = [" ".join(r.choice(["good", "fine"] if i % 2 else ["junk", "spam"]) + str(r.randint(0, 9)) for _ in range(3000 if i % 2 else 20)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"))
    whole = model.score_texts(texts)
    monkeypatch.setattr(quality, "SLICE", 7)
    assert all(np.allclose(a, b) for a, b in zip(whole, model.score_texts(texts)))
    assert list(whole[0] > 0.5) == [i % 2 == 1 for i in range(60)] and whole[2][1] == 63
    parts = [quality.features(b) for b in quality.passages(texts[1])]
    assert sum(map(len, parts)) == 63


def test_quality_features_equal_plain_loops():
    """Every feature of a passage, from the words alone."""
    r = random.Random(8)
    text = " ".join(r.choice(["Das", "HAUS,", "a", "(word)", "naïve", "x1", "...", "one", "one"]) for _ in range(130))
    words = text.encode().split()
    plain, hashed = (np.concatenate(x) for x in zip(*quality.passages(text)))
    assert len(plain) == 3
    for k in range(3):
        own = words[48 * k : 48 * k + 48]
        share = np.zeros(97)
        for w in own:
            for b in w + b" ":
                share[96 if b > 126 else max(b, 31) - 31] += 1
        share[0] = 0
        assert np.allclose(plain[k, :97], np.sqrt(share / share.sum()), atol=1e-6)
        size = [len(w) for w in own]
        follows = sum(words[i] == words[i + 1] for i in range(48 * k, min(48 * k + 48, len(words) - 1)))
        want = [sum(w.isupper() for w in own) / len(own), follows / len(own), np.mean(size) / 10, np.std(size) / 10, len(set(own)) / len(own), size.count(1) / len(own), np.log1p(len(own)) / 4, min(np.log1p(130) / 8, 2)]
        assert np.allclose(plain[k, 97:], want, atol=1e-4)
        count = np.zeros(512, int)
        for w in own:
            w = w.strip(quality.EDGE).lower()
            count[xxhash.xxh32_intdigest(w, 1) % 512] += 1
            count[xxhash.xxh32_intdigest(w[:4], 2) % 512] += 1
        assert (hashed[k] == count).all()


def test_toxicity_held_out(docs, labels):
    model, vectors = toxicity.fit(docs, labels, carry=tuple(docs.columns))
    scored = toxicity.score_toxicity(vectors, model)
    assert accuracy(scored, labels, "toxic") > 0.93
    kept = toxicity.keep_clean(vectors, model)
    assert kept.columns == docs.columns and kept.count() == scored.where("predicted = 0").count()


def _dense(index, rows, n_terms):
    """The unit vectors of rows under the index's weights, in plain loops."""
    out = np.zeros((len(rows), n_terms))
    for e, (t, n) in enumerate(rows):
        for term, count in zip(t, n):
            out[e, term] = (1 + np.log(count)) * index.idf[term]
        norm = np.sqrt((out[e] ** 2).sum())
        out[e] /= norm if norm else 1
    return out


def _rows(r, n, draw, most):
    terms = [np.array(sorted(draw()), np.int32) for _ in range(n)]
    return [(t, np.array([r.randint(1, most) for _ in t], np.int32)) for t in terms]


@pytest.mark.parametrize("shape", ["few terms", "rare and common"])
def test_block_max_search_is_exact(shape):
    r = random.Random(3)
    if shape == "few terms":
        n_terms, rows = 40, _rows(r, 500, lambda: r.sample(range(40), r.randint(1, 8)), 4)
    else:
        n_terms, rows = 900, _rows(r, 700, lambda: [*r.sample(range(20), 8), *r.sample(range(20, 900), 12)], 3)
    index = toxicity.BlockMaxIndex(rows, np.array([r.randint(0, 1) for _ in rows], float), np.array([r.uniform(0.5, 3) for _ in range(n_terms)]), block=16)
    index = pickle.loads(pickle.dumps(index))  # as tasks get it
    index._ready()
    assert (index.column >= 0).any() and (shape == "few terms" or (index.column < 0).any())
    dense = _dense(index, rows, n_terms)
    nobody = (np.empty(0, np.int32), np.empty(0, np.int32))
    cosine, place = index.search([*rows[:60], nobody], 10)
    assert (cosine[60] == 0).all() and (place[60] == -1).all()
    for c, p, q in zip(cosine, place, dense[:60]):
        every = dense @ q
        assert np.allclose(c, np.sort(every)[::-1][:10], atol=1e-5) and np.allclose(every[index.ids[p[p >= 0]]], c[p >= 0], atol=1e-5)
    for e, (c, p) in enumerate(zip(*index.search(rows[:60], 10, skip=np.arange(60)))):
        every = dense @ dense[e]
        assert e not in index.ids[p[p >= 0]] and np.allclose(c, np.sort(every[np.arange(len(rows)) != e])[::-1][:10], atol=1e-5)


def test_toxicity_scores_equal_brute_force(spark):
    """Terms, frequencies, weights, votes and calibration, recomputed from the texts with dictionaries and dense vectors."""
    r = random.Random(11)
    words = [f"{a}{b}{c}ing" for a in "bcdfg" for b in "aeiou" for c in "lmnrt"] + ["rotten", "lovely"]
    texts = [" ".join([*r.choices(words[:-2], k=r.randint(3, 30)), "rotten" if i % 3 == 0 else "lovely"]) for i in range(240)] + ["", "12 34"]
    labels = [(i, int(i % 3 == 0)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, vectors = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), per_class=100_000, k=7)
    got = {x["doc_id"]: x["score"] for x in toxicity.score_toxicity(vectors, model).collect()}

    def terms(text):
        out = {}
        for w in WORD.findall(text.lower()):
            for t in [w, *(w[:n] + "*" for n in STEMS if len(w) > n)]:
                out[t] = out.get(t, 0) + 1
        return out

    every = [terms(t) for t in texts]
    trained = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    known = {t for i, _ in trained for t in every[i]}
    held = lambda rows, t: sum(t in x for x in rows)
    n, n_pos = len(trained), sum(y for _, y in trained)
    weight = {}
    for t in known:
        a, b = held([every[i] for i, y in trained if y], t), held([every[i] for i, y in trained if not y], t)
        g2 = 0.0
        for observed, total in ((a, n_pos), (b, n - n_pos)):
            expected = (a + b) * total / n
            g2 += sum(o * np.log(o / e) for o, e in ((observed, expected), (total - observed, total - expected)) if o)
        weight[t] = (np.log((len(texts) + 1) / (held(every, t) + 1)) + 1) * np.sqrt(1 + max(2 * g2, 0))

    def unit(counts):
        v = {t: (1 + np.log(c)) * weight[t] for t, c in counts.items() if t in weight}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    units = [(i, y, unit(every[i])) for i, y in trained]
    prior = (n_pos + 1) / (n + 2)

    def vote(q, leave=None):
        near = sorted(((sum(x * v.get(t, 0) for t, x in q.items()), y) for i, y, v in units if i != leave), reverse=True)[:7]
        w = [1 / (1.05 - min(c, 1)) ** 2 for c, _ in near if c > 0]
        return (prior + sum(x * y for x, (_, y) in zip(w, near))) / (1 + sum(w))

    z = lambda p: np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    x, y = np.array([z(vote(v, i)) for i, _, v in units]), np.array([y for _, y, _ in units], float)
    a, b = 1.0, 0.0
    for _ in range(20_000):  # the same fit by plain gradient steps
        q = 1 / (1 + np.exp(-(a * x + b)))
        a, b = a - 1e-4 * (((q - y) * x).sum() + a - 1), b - 1e-4 * ((q - y).sum() + b)
    for i, counts in enumerate(every):
        q = unit(counts)
        want = 1 / (1 + np.exp(-(max(a, 0.1) * z(vote(q)) + b))) if q else prior
        assert abs(got[i] - want) < 2e-3


def test_toxicity_indexes_every_term(spark):
    """Neutral words are in no way telling of the label, and still find the nearest example."""
    texts = [f"topic{chr(97 + i % 26)}{chr(97 + i // 26)} plain words {'rotten' if i % 2 else 'lovely'}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, _ = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    trained = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(model.codes) == len({x for t in trained for w in WORD.findall(t) for x in (w, *(w[:n] + "*" for n in STEMS if len(w) > n))})
    for i, t in enumerate(texts):
        if t in trained:
            assert model.score([t.split()[0]])[0][1][0][0] == i
    assert model.score(["plain words"])[0][1]


@given(st.lists(st.text(alphabet="aéßΣ中1_-' \n\u2003²", max_size=30), max_size=8))
def test_word_table_cuts_like_the_pattern(texts):
    table = WordTable(lambda h: h)
    for _ in range(2):
        got = [table.rows[s][:, 0].tolist() for s in table.slots(texts)]
        assert got == [term_hashes(WORD.findall(" ".join(w.lower() for w in t.split())))[:, 0].tolist() for t in texts]


def test_scores_of_awkward_rows(spark, docs, labels, awkward):
    both = awkward.unionByName(docs, allowMissingColumns=True)
    model, vectors = toxicity.fit(both, labels)
    found = toxicity.score_toxicity(vectors, model).where("doc_id IS NULL OR doc_id < 9")
    assert found.where("doc_id IS NULL").count() == 1 and found.where("doc_id = 6").select("score").distinct().count() >= 1
    assert toxicity.score_toxicity(vectors, model).where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    for scored in (quality.score_quality(awkward, quality.fit(docs, labels)), quality.score_quality(awkward, None)):
        got = scored.collect()
        assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    empty = awkward.limit(0)
    assert quality.fit(empty, labels) is None
    model, vectors = toxicity.fit(empty, labels)
    assert toxicity.score_toxicity(vectors, model).count() == 0


def test_packing(spark, awkward, docs):
    def check(frame, limit):
        args = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN
        got = packing.pack_documents(frame, *args, max_segments=limit).toPandas()
        want = packing.tokenise([r["text"] or "" for r in frame.collect()], args[0], None, args[2])
        assert got["length"].sum() == sum(len(w) + 1 for w in want)
        for _, s in got.sort_values("offset").groupby("sequence_id"):
            assert s["length"].sum() <= 2048 and len(s) <= limit
            assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]]
        return got, want

    got, want = check(docs.limit(60), 6)
    ids = {r["doc_id"]: w for r, w in zip(docs.limit(60).collect(), want)}
    for key, p in got.sort_values("start").groupby("doc_id"):
        own, at = np.array([*ids[key], 1], "<u4"), 0
        for r in p.itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(own[at : at + r.length].tobytes())
            at += r.length
        assert at == len(own)
    check(awkward, 256)
    assert packing.pack_documents(awkward.limit(0), public.path("byte_bpe_50k.json"), None, public.PATTERN).count() == 0


def test_dot_product_bins_respect_every_limit():
    r = np.random.default_rng(2)
    items = np.stack([r.integers(1, 2048, 400), np.ones(400, int), r.integers(0, 1000, 400)], axis=1)
    limits = np.array([2048, 4, 1500])
    bins = packing.pack_vectors(items, limits)
    for b in np.unique(bins):
        assert (items[bins == b].sum(axis=0) <= limits).all()
    assert len(np.unique(bins)) <= 1.25 * items[:, 0].sum() / 2048 + 1
    assert (packing.pack_vectors(np.array([[3000, 1, 1], [5, 1, 1]]), limits) >= 0).all()


def test_fingerprints(spark, docs, awkward):
    for frame in (docs.limit(150), awkward.where("doc_id IS NOT NULL")):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in frame.collect()), key=lambda x: (-x[0], x[1]))
        got = sorted(fingerprint.fingerprint_documents(frame).collect(), key=lambda r: -r["doc_id"])
        assert len(got) == len(rows)
        errors = []
        for k, (r, (key, text)) in enumerate(zip(got, rows)):
            nxt = rows[(k + 1) % len(rows)][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + nxt[:half]
            assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (key, len(text), hashlib.sha256(edited.encode()).hexdigest())
            a, b = _shingles(text, 5), _shingles(edited, 5)
            if len(a) > 100:
                errors.append(r["near_edited"] - len(a & b) / len(a | b))
        assert not errors or abs(np.mean(errors)) < 0.03
    same = {r["fingerprint"] for r in fingerprint.fingerprint_documents(awkward).where("doc_id IN (5, 6)").collect()}
    assert len(same) == 1
    assert fingerprint.fingerprint_documents(awkward.limit(0)).count() == 0
    assert fingerprint.fingerprint_documents(awkward.where("doc_id = 3")).first()["near_next"] == 1


def _sketch(text, width=5, scale=fingerprint.SCALE):
    """All hashes below the threshold."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    every = set()
    for i in range(max(1, len(words) - width + 1) if words else 0):
        h = 42
        for w in words[i : i + width]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        every.add(h - (1 << 64) if h >> 63 else h)
    return sorted(h for h in every if h < fingerprint.top(scale))


def _alike(a, b):
    x, y = set(a), set(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_fingerprints_equal_brute_force(spark, docs, awkward):
    rows = docs.select("doc_id", "text").limit(200).union(awkward.where("doc_id is not null and doc_id <> 6").select(F.col("doc_id") + 10**7, "text"))
    data = sorted(((r[0], r[1] or "") for r in rows.collect()), reverse=True)
    got = sorted(fingerprint.fingerprint_documents(rows).collect(), key=lambda r: -r["doc_id"])
    hexed = lambda s: "".join(f"{h % (1 << 64):016x}" for h in s)
    for k, (r, (key, text)) in enumerate(zip(got, data)):
        nxt, half = data[(k + 1) % len(data)][1], len(text) // 2
        own, edited, other = _sketch(text), _sketch(text[: len(text) - half] + nxt[:half]), _sketch(nxt)
        assert (r["doc_id"], r["fingerprint"], r["edited_fingerprint"]) == (key, hexed(own), hexed(edited))
        assert abs(r["near_edited"] - _alike(own, edited)) < 1e-12 and abs(r["near_next"] - _alike(own, other)) < 1e-12


def test_next_of_an_id_that_fills_many_slices(spark):
    rows = [(7, f"text {i}") for i in range(300)] + [(None, f"none {i}") for i in range(200)] + [(i, f"other {i}") for i in range(20, 40)]
    df = spark.createDataFrame(rows, "id long, text string")
    out = fingerprint.with_next(df, "id", ["text"], 16, "text")
    got = {r["text"]: r["next_text"] for r in out.collect()}
    key = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = [t for _, t in sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), key[x[1]]))]
    assert got == dict(zip(order, [*order[1:], order[0]]))


def test_next_of_many_copies_of_one_row(spark):
    """Copies under one id, and under none: each but one is its own next, the last one has the row after them."""
    rows = [(7, "same text")] * 400 + [(7, f"text {i}") for i in range(40)] + [(None, "none")] * 300 + [(None, f"none {i}") for i in range(9)] + [(i, f"other {i}") for i in range(20, 60)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(7)
    out = fingerprint.with_next(df, "id", ["text"], 16, "text")
    got = {}
    for r in out.collect():
        got.setdefault((r["id"], r["text"]), []).append(r["next_text"])
    key = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = [t for _, t in sorted(set(rows), key=lambda x: (x[0] is None, -(x[0] or 0), key[x[1]]))]
    after = dict(zip(order, [*order[1:], order[0]]))
    assert sum(map(len, got.values())) == len(rows)
    for (_, text), nexts in got.items():
        assert sorted(nexts) == sorted([after[text]] + [text] * (len(nexts) - 1))


def test_merged_sketch_is_the_sketch_of_both(spark):
    df = spark.createDataFrame([("a b c d e f g h i j k l", "m n o p q r s t u v w x y z")], "a string, b string")
    for c in ("a", "b"):
        df = fingerprint.with_sketch(df, c, f"s_{c}", width=1)
    df = fingerprint.with_sketch(df.withColumn("ab", F.concat_ws(" ", "a", "b")), "ab", "s_ab", width=1)
    assert df.where(fingerprint.merge(F.col("s_a"), F.col("s_b")) == F.col("s_ab")).count() == 1
    assert df.select(fingerprint.containment(F.col("s_a"), F.col("s_ab"))).first()[0] == 1


def _shingles(text, width):
    w = text.encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def test_byte_bpe_equals_the_library(spark, awkward, docs):
    import tiktoken

    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.codec(path, public.PATTERN)
    r = random.Random(5)
    odd = ["".join(r.choice("aé \n\t'0ß中🙂_-.sT\u0301") for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts = [t or "" for _, t in AWKWARD] + odd + [x["text"] for x in docs.limit(100).collect()]
    for t in texts:
        ids = codec.encode(t)
        assert ids == enc.encode_ordinary(t) and codec.decode(ids) == t.encode()
    got = byte_bpe.digest_documents(awkward, path, public.PATTERN)
    assert got.count() == len(AWKWARD) and got.where("doc_id = 1").first()["n_tokens"] == 0
    assert got.where("doc_id = 6").distinct().count() == 1 and got.where("doc_id IS NULL").count() == 1
    assert byte_bpe.digest_documents(awkward.limit(0), path, public.PATTERN).count() == 0
    assert [list(r["ids"]) for r in byte_bpe.encode_documents(awkward.where("doc_id = 3"), path, public.PATTERN).collect()] == [enc.encode_ordinary("one")]


def test_urls(spark):
    urls = ["http://a.com/x", "http://EXAMPLE.com/en/1?q", "https://www.example.com/en/", "http://example.com", "http://x.net/fr/2#t", "http://x.net/de/", None, "no scheme", "http://net/es/", "http://notexample.com/en/", "ftp://u@h:80/p://q"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls + urls[:2])], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = {r["page_id"]: r for r in url_filter.judge(pages, rules).collect()}
    assert [got[i]["rule"] for i in range(len(urls))] == ["com/", "example.com/en/", "www.example.com/en/", None, "net/fr/", None, None, None, "net/es/", "com/", None]
    assert [got[i]["verdict"] for i in (0, 1, 2, 3, 4)] == ["allow", "block", "allow", "allow", "block"]
    assert (got[1]["host"], got[3]["path"], got[6]["host"], got[10]["host"]) == ("example.com", "", "", "u@h:80")
    assert len(got) == len(pages.collect())
    assert url_filter.judge(pages.limit(0), rules).count() == 0 and url_filter.judge(pages, rules.limit(0), default="block").where("verdict = 'block'").count() == pages.count()
    many = spark.range(5000).select(F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/a").alias("path"), F.lit("block").alias("verdict"))
    seen = spark.range(9000).select("id", F.concat(F.lit("http://s.h"), "id", F.lit(".org/ab")).alias("url")).withColumnRenamed("id", "page_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # the same by a shuffled join
    try:
        assert sorted(url_filter.judge(pages, rules).collect(), key=str) == sorted(got.values(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert url_filter.judge(seen, many).where("verdict = 'block'").count() == 5000


def test_licences(spark, awkward):
    text = "Licensed under the Apache License, Version 2.0.\nfiller words here. You may not use this file except in compliance with the License!\nReleased under the MIT License."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = license_scan.scan_licenses(df).first()
    assert r["licenses"] == "Apache-2.0,MIT" and [m["rule"] for m in r["matches"]] == ["apache-2-short", "mit-line"] and r["n_sentences"] == 3
    assert text[r["matches"][1]["start"] : r["matches"][1]["end"]] == "Released under the MIT License"
    assert license_scan.scan_licenses(awkward.limit(0)).count() == 0
    got = license_scan.scan_licenses(awkward)
    assert got.count() == len(AWKWARD) and got.where("licenses != ''").count() == 0


def test_embeddings(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(40, 16))
    vecs = [list(map(float, np.float32(base[i % 40] + r.normal(scale=s, size=16)))) for i in range(160) for s in ([0.0] if i < 60 else [0.22])]
    data = [(i, v) for i, v in enumerate(vecs)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, []), (1005, [1.0, 2.0]), (1006, [1.0, 2.0]), (1007, [float("inf")] * 16)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1))
    good = {i: np.float32(v).astype(float) for i, v in data if i < 1000 or i in (1005, 1006)}
    links = {i: {j for j in good if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] / (np.linalg.norm(good[i]) * np.linalg.norm(good[j])) >= 0.95} for i in good}
    for tile in (2048, 16):
        got = {x["vec_id"]: x for x in embedding_dedup.embedding_duplicates(df, tile=tile).collect()}
        assert len(got) == len(data)
        for i, _ in data:
            seen, todo = {i}, [i]
            while todo:
                todo += [k for k in links.get(todo.pop(), ()) if k not in seen and not seen.add(k)]
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links.get(i, ())), min(seen), min(seen) == i)
    assert embedding_dedup.embedding_duplicates(df.limit(0)).count() == 0
    wide = spark.createDataFrame([(1, [1e200, 2e200]), (2, [1e-200, 2e-200]), (3, [1.0, 0.32868411]), (4, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embedding_dedup.embedding_duplicates(wide).collect()} == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}


def test_chat(spark):
    nasty = "\\</s>[INST] ok [/INST]\\\\<|im_end|>\n<|im_end|>\n<|im_start|>user\nhi"
    rows = [(1, 0, "message", None, "user", nasty), (1, 1, "message", None, "assistant", nasty + "é🙂"), (1, 2, "message", None, None, None), (1, 2, "message", None, None, None), (2, 0, "message", "a", "user", "hi"), (2, 1, "message", "b", "assistant", "He"), (2, 2, "delta", "b", None, "llo"), (2, 3, "message", "c", "user", "again"), (2, 4, "regenerate", "b", None, "Bye"), (2, 5, "delta", "b", None, "!"), (2, 6, "edit", "a", None, "hey"), (None, 0, None, None, "system", "")]
    events = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message_id string, role string, text string").withColumn("ord", F.lit(3))
    out = chat_format.render(chat_format.fold(events)).select("conv_id", "n_turns", "formatted", chat_format.parse(F.col("formatted")).alias("turns"), chat_format.learned(F.col("formatted"), F.col("loss")).alias("learned"))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", nasty), ("assistant", nasty + "é🙂"), ("", ""), ("", "")]
    assert got[1]["learned"] == nasty + "é🙂" and got[1]["n_turns"] == 4
    assert [tuple(t) for t in got[2]["turns"]] == [("user", "hey"), ("assistant", "Bye!")] and got[2]["learned"] == "Bye!"
    assert [tuple(t) for t in got[None]["turns"]] == [("system", "")]
    assert chat_format.render(chat_format.fold(events.limit(0))).count() == 0


def test_event_log_folds_back(spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]), r.choice(["", None, "a", "two words", "[INST] x </s>\\\\</s>", "é🙂" * 5])) for c in range(12) for t in range(r.randint(1, 9))]
    rows += [(3, 2, "user", "same turn"), (3, 2, "user", "same turn"), (50, None, "user", "no turn at all")]
    got = chat_format.fold(queries.event_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).orderBy("conv_id", "ord").collect()
    want = sorted((c, t or 0, role or "", text or "") for c, t, role, text in rows)
    assert [(m["conv_id"], m["role"], m["text"]) for m in got] == [(c, role, text) for c, _, role, text in want]


def test_long_conversations_drop_what_regenerations_replace(spark):
    """Many regenerations in one conversation; only messages that began between a message and its regeneration go."""
    log = []
    for i in range(200):
        log += [(1, 10 * i, "message", f"m{i}", "assistant", f"first {i}"), (1, 10 * i + 1, "message", f"f{i}", "user", "gone"), (1, 10 * i + 2, "regenerate", f"m{i}", None, f"second {i}"), (1, 10 * i + 3, "message", f"k{i}", "user", f"kept {i}")]
    got = chat_format.fold(spark.createDataFrame(log, "conv_id long, seq long, kind string, message_id string, role string, text string")).orderBy("ord").collect()
    assert [m["text"] for m in got] == [x for i in range(200) for x in (f"second {i}", f"kept {i}")]


def _components(rows, width):
    sets = {}
    for key, text in rows:
        sets.setdefault(key, []).append(_shingles(text or "", width))
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {k: find(k) for k in keys}


def test_near_duplicates(spark, docs, awkward):
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    made = []
    for g in range(6):
        text = [r.choice(words) for _ in range(120)]
        for _ in range(60):
            copy = list(text)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = r.choice(words)
            made.append(" ".join(copy))
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string")
    for data, args in ((frame, {}), (frame, {"leaf": 8, "tile": 16}), (docs.where("doc_id < 300").select("doc_id", "text"), {})):
        got = {x["doc_id"]: x for x in minhash_dedup.near_duplicates(data, width=4, **args).collect()}
        want = _components([tuple(x) for x in data.collect()], 4)
        assert {k: x["component_id"] for k, x in got.items()} == want
    out = minhash_dedup.near_duplicates(awkward, width=4).collect()
    assert len(out) == len(AWKWARD)
    by = {(x["doc_id"]): x for x in out}
    assert by[6]["component_id"] == 5 and not by[6]["kept"] and by[1]["n_shingles"] == 0 and by[3]["n_shingles"] == 1 and by[7]["kept"] and by[None]["component_id"] is None
    assert minhash_dedup.near_duplicates(awkward.limit(0)).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """Each id has two texts, and another id a near copy of the second: one vertex each, no link lost."""
    r = random.Random(12)
    rows = []
    for i in range(60):
        a, b = ([f"w{r.randint(0, 10**6)}" for _ in range(100)] for _ in range(2))
        near = list(b)
        near[50] = "other"
        rows += [(i, " ".join(a)), (i, " ".join(b)), (1000 + i, " ".join(near)), (i, "")]
    rows += [(5000, rows[0][1]), (5000, rows[4][1]), (None, rows[0][1])]  # one id ties two others together
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = {k: (0 if k in (1, 1001) else k % 1000) for k, _ in rows if k is not None} | {5000: 0}
    assert all(x["component_id"] == want[x["doc_id"]] and x["kept"] == (x["doc_id"] == want[x["doc_id"]]) for x in got if x["doc_id"] is not None)
    ids = [5, 5, 1, 2, 7]
    frame = spark.createDataFrame([(5, rows[0][1]), (5, rows[4][1]), (1, rows[0][1]), (2, rows[4][1]), (7, None)], "doc_id long, text string")
    assert sorted((x["doc_id"], x["component_id"]) for x in minhash_dedup.near_duplicates(frame).collect()) == [(k, min(k, 1) if k != 7 else 7) for k in sorted(ids)]


@pytest.mark.parametrize("args", [{"leaf": 4, "tile": 8, "depth": 2}, {"leaf": 4, "tile": 8, "depth": 4, "most_broadcast": 0}])
def test_crowded_nodes_of_several_components(spark, args):
    """Chains of near copies: the ends of a chain are far apart, several chains share most of their words."""
    r = random.Random(21)
    base, rows = [f"w{i}" for i in range(150)], []
    for g in range(3):
        text = list(base)
        for i in r.sample(range(150), 6):
            text[i] = f"g{g}x{i}"
        for step in range(40):
            rows.append((len(rows), " ".join(text)))
            text[(step * 7) % 150] = f"g{g}s{step}"
    got = {x["doc_id"]: x["component_id"] for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2, **args).collect()}
    assert got == _components(rows, 2)


def test_embeddings_of_repeated_ids(spark):
    a, b, c = [1.0, 0.0, 0.0, 0.1], [0.0, 1.0, 0.1, 0.0], [0.0, 0.0, 1.0, 0.0]
    df = spark.createDataFrame([(5, a), (5, b), (1, a), (2, b), (9, c), (9, None), (8, None)], "vec_id long, embedding array<float>")
    got = sorted((x["vec_id"], x["component_id"], x["n_links"]) for x in embedding_dedup.embedding_duplicates(df).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (5, 1, 1), (5, 1, 1), (8, 8, 0), (9, 9, 0), (9, 9, 0)]


def test_packing_of_very_long_blanks(spark):
    for text in ("\n" * 1_000_000, " " * 1_000_000, "a" * 3000 + "\r\n" * 400_000 + "b", "x" * 200_000):
        ids = packing.tokenise([text], public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)[0]
        assert ids == packing.tokenise([text], public.path("byte_bpe_50k.json"), None, public.PATTERN)[0]
    df = spark.createDataFrame([(1, " " * 1_000_000), (2, "a b")], "doc_id long, text string")
    got = packing.pack_documents(df, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    assert {r["doc_id"] for r in got.collect()} == {1, 2}


def test_packing_spreads_repeated_rows(spark):
    df = spark.createDataFrame([(7, "the same short text")] * 500, "doc_id long, text string")
    got = packing.pack_documents(df, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, group_rows=50).toPandas()
    assert len(got) == 500 and (got["sequence_id"] // (1 << 32)).value_counts().max() < 100
    assert not got.duplicated(["sequence_id", "offset"]).any()


def test_pipeline_stages_of_awkward_rows(spark, docs, awkward):
    rows = awkward.select("doc_id", "text", "lang", "source", "n_chars").unionByName(docs)
    good = corpus_pipeline.quality_classifier(spark, rows, SF)
    clean = corpus_pipeline.toxicity_filter(spark, rows, SF)
    assert good.columns == clean.columns == docs.columns and good.count() <= rows.count() and clean.count() <= rows.count()
    copies = [(5, "one two three four five six", "en"), (5, "one two three four five six", "en"), (5, "another text that is under the same id", "en"), (None, "one two three four five six", "de"), (None, "nothing like the others here at all", "de"), (None, "nothing like the others here at all", "de"), (6, None, None), (6, "", None), (3, "another text that is under the same id", "fr")]
    frame = spark.createDataFrame(copies, "doc_id long, text string, lang string").withColumn("rep", F.lit(1)).withColumn("cid", F.lit("x"))
    kept = corpus_pipeline.near_duplicates(spark, frame, SF).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == [("3", "another text that is under the same id"), ("6", ""), ("None", "nothing like the others here at all")]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_stages_of_clashing_names(spark, docs):
    """Columns that are called like an operator's own, one with a dot in its name, and a map column pass every stage."""
    odd = docs.limit(120)
    for c in ("_n", "_terms", "_v", "_key", "_rows", "row", "terms", "n", "v", "key", "rows", "rep", "cid", "id", "y", "score", "g", "a.b"):
        odd = odd.withColumn(c, F.lit(7))
    odd = odd.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).unionByName(docs.limit(3).drop("n"), allowMissingColumns=True)
    odd = odd.unionByName(odd.where("doc_id < 20"))  # repeated rows with maps
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF).collect()
        assert out and (name == "packing" or list(out[0].asDict()) == odd.columns)


def test_scratch_tables_of_other_threads_stay(spark):
    """`temporary` removes what its own thread has made."""
    import threading

    from cytoframe.llm.common import Scratch, temporary

    made = []
    with temporary():
        t = threading.Thread(target=lambda: made.append(Scratch(spark, "other").write(spark.range(3), "t")))
        t.start()
        t.join()
        own = Scratch(spark, "own").write(spark.range(4), "t")
        assert own.count() == 4
    assert made[0].count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(own.inputFiles()[0]).count()


def test_pipeline_stages(spark, docs, labels):
    """Each stage on its predecessor's rows, against the operators' own scores and brute force."""
    good = corpus_pipeline.quality_classifier(spark, docs, SF)
    clean = corpus_pipeline.toxicity_filter(spark, good, SF)
    kept = corpus_pipeline.near_duplicates(spark, clean, SF)
    assert good.columns == clean.columns == kept.columns == docs.columns
    component = _components([tuple(x) for x in clean.select("doc_id", "text").collect()], 5)
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert ids == {k for k, c in component.items() if k == c}
    packed = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == ids
