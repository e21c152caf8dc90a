"""Fill-in-middle, lexical search and line dedup against brute force and awkward inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from cytoframe.llm import fill_in_middle as fim, lexical_search as search, line_dedup as lines, minhash_dedup
from cytoframe.llm.common import Scratch

SF = "/root/testdata/sf0.01"
AWKWARD = [(1, None), (2, ""), (3, "one"), (4, "word " * 30_000), (5, "same"), (6, "same"), (6, "same"), (None, "no id ok"), (7, " \t\n"), (8, "Ünï [INST] </s> \U0001f600 \x85 nb\u00a0sp"), (9, "a <P> marker"), (10, "\n\n"), (11, "x" * 1_000_000)]


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    for c in ("id", "n", "terms", "carry", "mark", "row"):  # names of the operators' own
        df = df.withColumn(c, F.lit(7))
    return df


@given(st.lists(st.booleans(), max_size=2000), st.data())
def test_rank_and_select(bits, data):
    v, a = fim.BitVector(np.array(bits, bool)), np.cumsum([0, *bits])
    at = np.arange(len(bits) + 1)
    assert (v.rank(at) == a).all() and v.before[-1] == sum(bits)
    ones = np.flatnonzero(bits)
    if len(ones):
        assert (v.select(np.arange(1, len(ones) + 1)) == ones).all()


def _fim(key, text, seed=42):
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 80 else "psm", len(p), len(m), out


def test_fill_in_middle_equals_plain_cuts(spark, awkward, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    rows = [(i, "".join(random.Random(i).choice(" \n\tab中é") for _ in range(i % 90))) for i in range(600)]
    for frame in (docs, awkward, spark.createDataFrame(rows, "doc_id long, text string")):
        out = fim.fill_in_middle(frame).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
        want = Counter((r["doc_id"], *_fim(r["doc_id"], r["text"] or "")) for r in frame.collect())
        assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out) == want
        texts = Counter(r["text"] or "" for r in frame.collect())
        assert Counter(r["back"] for r in out) == texts
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(awkward.limit(0)).count() == 0


def _ranked(docs, items, k):
    """Every document for every item, from the formula."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = [(key, Counter(terms(t))) for key, t in docs]
    found = [(key, c) for key, c in found if c]
    n_docs, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in found:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, key is None, key or 0, key))
        out += [(item, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("shard", [8, 100, 8192])
def test_search_finds_what_all_scores_say(spark, awkward, shard, monkeypatch):
    """Shards of any size, chains of equal gains, ties over shards, repeated rows, long items in blocks."""
    r = random.Random(3)
    words = [f"w{int(r.paretovariate(0.6)) % 400}" for _ in range(4000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 60)))) for i in range(400)] + [(1000 + i, "copy of these words w1 w2") for i in range(90)] + [(i, "twin w1") for i in range(5)]
    rows += [(r_[0], r_[1]) for r_ in AWKWARD]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 25)))) for i in range(12)] + [(20, None), (21, "!!"), (22, "nowhere"), (23, "copy w1"), (23, "w2"), (None, "words w3"), (24, " ".join(words))]
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "FRONTIER", 500)
    monkeypatch.setattr(search, "BLOCK", 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = search.search(search.index_documents(docs), spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(_ranked(rows, items, 10), key=key)


def test_search_of_nothing(spark, awkward):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert [tuple(r)[:3] for r in search.search(search.index_documents(awkward), items).collect()] == [(1, 1, 4)]
    assert search.search(search.index_documents(awkward.limit(0)), items).count() == 0
    assert search.search(search.index_documents(awkward), items.limit(0)).count() == 0
    assert search.search(search.index_documents(awkward.where("doc_id in (1, 2, 7, 10)")), items).count() == 0


def test_treaps_keep_both_orders():
    r = np.random.default_rng(5)
    n = 5000
    term, doc = r.integers(0, 40, n), np.arange(n)
    for gain in (r.integers(0, 1000, n), np.zeros(n, int), doc, n - doc):
        t = search.Treaps(term, doc, gain, 41)
        seen = np.zeros(n, bool)
        for root in t.root[t.root >= 0].tolist():
            stack, depth = [(root, -1, n, 0)], 0
            while stack:
                y, lo, hi, d = stack.pop()
                assert lo < t.doc[y] < hi and not seen[y]
                seen[y], depth = True, max(depth, d)
                for side, a, b in ((t.left[y], lo, t.doc[y]), (t.right[y], t.doc[y], hi)):
                    if side >= 0:
                        assert t.gain[side] <= t.gain[y]
                        stack.append((int(side), a, b, d + 1))
            assert depth < 60 or gain[0] != gain[1]  # equal gains make no chains
        assert seen.all() and t.root[40] == -1


def test_search_prunes():
    """Where few documents hold the rare terms, most are never scored."""
    r = np.random.default_rng(6)
    n = 4000
    rare = np.sort(r.choice(n, 60, replace=False))
    term, doc = np.r_[np.zeros(n, int), np.ones(60, int)], np.r_[np.arange(n), rare]
    gain = np.r_[r.integers(1, 1000, n), np.full(60, 900)]
    t = search.Treaps(term, doc, gain, 2)
    item, got, score, seen = search.top_k(t, np.zeros(2, int), np.array([0, 1]), np.array([1, 50]), np.ones(1, int), 10, n)
    whole = np.bincount(doc, np.where(term == 1, 50, 1) * gain, n).astype(int)
    assert score.tolist() == np.sort(whole)[::-1][:10].tolist() and (whole[got] == score).all()
    assert seen < 200


def _dedup(rows, least=40, docs=5):
    where = defaultdict(set)
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is not None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                where[key(line)].add(i)
    top = {k: max(v, key=order) for k, v in where.items() if len(v) >= docs}
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if top.get(key(x), i) == i]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("parts", ["3", "40"])
def test_lines_equal_brute_force(spark, awkward, parts):
    """Lines of one key over many ranges, repeated rows, rows that share an id, null ids, other cases and blanks."""
    r = random.Random(7)
    common = [f"This line number {i} is long enough to be counted as one" for i in range(6)] + ["ÄÖÜ " * 9 + "Äé中x", "ÄÖÜ " * 9 + "Äé中", "short"]
    rows = []
    for i in range(500):
        own = [r.choice(["  {}\t", "{}\r", "{}"]).format(x.upper() if x.isascii() and r.random() < 0.3 else x) for x in common if r.random() < 0.35] + [f"a line of document {i} alone, with more than forty letters"]
        r.shuffle(own)
        rows.append((r.choice([i, i, i % 7, None]), "\n".join(own * r.choice([1, 1, 2]))))
    rows += rows[:40] + [(10_000 + i, common[0]) for i in range(4)] + [tuple(x) for x in AWKWARD] + [(20_000 + i, "exactly four documents hold this line, so it stays") for i in range(4)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(1)).withColumn("keep", F.lit(2)).repartition(5)
        out = lines.repeated_lines(frame, carry=("text", "mark")).withColumn("kept", lines.kept_text(F.coalesce("text", F.lit("")), F.col("keep")))
        got = out.collect()
        assert Counter((x["doc_id"], x["n_lines"], x["n_dropped"], x["kept"]) for x in got) == _dedup(rows)
        for x in got:
            bits = np.unpackbits(np.frombuffer(zlib.decompress(x["keep"]), np.uint8), count=x["n_lines"]) if x["keep"] else np.ones(x["n_lines"])
            assert (bits == 0).sum() == x["n_dropped"] and (x["n_dropped"] > 0) == (x["keep"] is not None)
        assert any(x["n_dropped"] for x in got) and lines.repeated_lines(frame.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_compared_texts_are_shuffled_once(spark, monkeypatch):
    """Texts go to their classes' keys; repeated rows are dropped there, without an exchange by texts. Copies stay linked."""
    rows = [(i % 40, " ".join(f"w{i % 40 // 2}x{j}" for j in range(30 + i % 2))) for i in range(120)]
    seen, write = [], Scratch.write

    def note(self, df, name, **more):
        if name == "sets":
            seen.append((df._jdf.queryExecution().executedPlan().toString(), df.count(), df.select("cid").distinct().count()))
        return write(self, df, name, **more)

    monkeypatch.setattr(Scratch, "write", note)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted((k, k - k % 2) for k, _ in rows)
    text, n, classes = seen[0]
    assert n == classes == 40 and not re.search(r"Exchange hashpartitioning\([^)]*text", text)


def test_few_executions_of_near_duplicates(spark, monkeypatch):
    """What is only counted is observed while it is written, and chains within a tile are one round: the driver pays for every execution."""
    from cytoframe.llm import graph

    bus, store, seen, components = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore(), [], graph.components

    def last() -> int:
        bus.waitUntilEmpty(10_000)
        spark.range(1).write.format("noop").mode("overwrite").save()
        bus.waitUntilEmpty(10_000)
        return max(store.executionsList().apply(k).executionId() for k in range(store.executionsList().size()))

    def note(edges, scratch, tag):
        before = last()
        out = components(edges, scratch, tag)
        seen.append((tag, last() - before - 1))
        return out

    monkeypatch.setattr(minhash_dedup, "components", note)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for g in range(3):  # of a chain, only neighbours are linked
        text = [f"g{g}{w}" for w in words]
        for step in range(30):
            rows.append((len(rows) * 7 % 90, " ".join(text)))
            text[step * 6] = f"s{step}"
    before = last()
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert last() - before - 1 - 4 <= 27  # less those of note()
    assert dict(seen)["linked"] == 5
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == {(k, min(j for j, _ in rows[i // 30 * 30 : i // 30 * 30 + 30])) for i, (k, _) in enumerate(rows)}


@pytest.mark.parametrize("edges", [[], [(3, 3)], [(k, k + 1) for k in range(40)], [(k * 7 % 41, (k + 1) * 7 % 41) for k in range(40)] + [(50, 51), (51, 50), (60, 61), (62, 61)]])
def test_components_of_chains(spark, edges, tmp_path):
    from cytoframe.llm import graph

    got = graph.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"), "t").collect()
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for u, v in edges:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    assert {r["node"]: r["root"] for r in got} == label and len(got) == len(label)


def test_pipeline_rows_stay_where_they_are(spark, monkeypatch):
    """Only keys whose rows go or are repeated are joined, so whole rows aren't shuffled; where no node is crowded, no tables of such are written."""
    import corpus_pipeline

    words = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join([f"t{k // 2}{w}" for w in words] + ["more"] * (k % 2)), "en") for k in range(40)]
    frame = spark.createDataFrame([*rows, rows[6], rows[9], (None, "alone", "de"), (70, None, "de")], "doc_id long, text string, lang string").repartition(5)
    made, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name, **more: made.append(name) or write(self, df, name, **more))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = corpus_pipeline.near_duplicates(spark, frame.where("doc_id is null or doc_id not in (6, 9)"), "")
        plan = few._jdf.queryExecution().executedPlan().toString()
        got = [corpus_pipeline.near_duplicates(spark, frame, "", *args).collect() for args in ((), (0,))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in plan and "hashpartitioning" not in plan and not {"big", "crowded", "cand1"} & set(made)
    assert few.count() == 20 + 2
    for kept in got:
        assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == sorted((str(k), t or "") for k, t in [*[r[:2] for r in rows[::2]], (None, "alone"), (70, None)])
