"""Near-dedup, search and classifier against brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("starpanel.llm.common")

from pyspark.sql import functions as F  # noqa: E402

from starpanel.llm import embedding_dedup, minhash_dedup, quality, topk_search  # noqa: E402
from starpanel.llm.common import Written, components  # noqa: E402


def least(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(50)] + [(200, 200 + k) for k in range(30)]
    want = least({x for e in edges for x in e}, edges)
    got = {r.node: r.component for r in components(Written(spark), spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    assert got == {n: want[n] for e in edges if e[0] != e[1] for n in e}


def vectors(n=400, d=8):
    r = np.random.default_rng(2)
    x = r.standard_normal((n, d)).astype(np.float32)
    x[40:80] = x[40] + 0.05 * r.standard_normal((40, d))
    x[80:120] = x[80]
    x[120:150] = x[120] * r.uniform(0.5, 2, (30, 1))
    rows = [(i, [float(v) for v in row], "c", 1) for i, row in enumerate(x)]
    odd = [None, [], [0.0] * d, [float("nan")] * d, [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0, 2.0], [1.0, 2.0]]
    return rows + [(1000 + i, v, "c", 1) for i, v in enumerate(odd)] + [(None, [1.0] * d, "c", 1)]


@pytest.mark.parametrize("cell", [40, 4096])
def test_embedding_dedup(spark, cell):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string, id int").repartition(5)
    got = {r.vec_id: r for r in embedding_dedup.dedup(df, cell=cell).collect()}
    assert len(got) == len(rows)
    good = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(good)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95]
    want, n = least([i for i, *_ in rows if i is not None], edges), dict.fromkeys([i for i, *_ in rows], 0)
    for a, b in edges:
        n[a] += 1
        n[b] += 1
    for i, r in got.items():
        assert r.n_links == n[i]
        assert r.component_id == (want[i] if i is not None else None) and r.kept == (i is None or want[i] == i)
    assert embedding_dedup.dedup(df.where("false")).count() == 0


def brute_topk(rows, ask, k):
    good = [(i, [math.floor(64 * Fraction(float(np.float64(x)))) for x in v]) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    queries = {}
    for (i, v), e in zip([(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()], [e for _, e in good]):
        if ask(i):
            queries[i] = min(queries.get(i, (len(v), v, e)), (len(v), v, e))
    want = {}
    for q, (_, _, e) in queries.items():
        best = sorted((-sum(map(int.__mul__, e, x)), i) for i, x in good if i != q and len(x) == len(e))[:k]
        want[q] = [(i, -s if abs(s) < 10**38 else None) for s, i in best]
    return want


def found_topk(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score if r.score is None else int(r.score)))
    return got


@pytest.mark.parametrize("block", [8192, 50])
def test_topk(spark, monkeypatch, block):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", max(7, block // 5))
    rows = [(i, v) for i, v, *_ in vectors(300)] + [(2000 + i, [0.5] * 8) for i in range(40)]
    rows += [(20, [0.25] * 8), (20, rows[20][1]), (7, rows[7][1]), (40, [1.0, 2.0]), (3000, [3.0, -1.0])]  # ids that repeat, queries and others
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, score int").repartition(4)
    assert found_topk(topk_search.search(df, F.col("vec_id") % 20 == 0, k=20)) == brute_topk(rows, lambda i: i % 20 == 0, 20)
    assert topk_search.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_of_large_components(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.standard_normal((120, 6)))]
    for i, size in ((3, 1e12), (10, 1e12), (20, 1e10), (21, -1e10), (40, 1e25), (41, 1e300), (60, 3e7), (61, 1e7), (62, 2.0**60)):
        rows[i] = (i, [float(x * size) for x in r.standard_normal(6)])
    rows += [(200 + i, [1e12, -1e12, 1.0, 0.0, float(i), 0.0]) for i in range(30)]  # products that cancel
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert found_topk(topk_search.search(df, F.col("vec_id") % 10 == 0, k=5)) == brute_topk(rows, lambda i: i % 10 == 0, 5)


def test_topk_cells_leave_out_what_cannot_win(spark):
    r = np.random.default_rng(6)
    center = r.standard_normal((8, 16)) * 5
    x = (center[np.arange(400) % 8] + 0.05 * r.standard_normal((400, 16)))
    cells = topk_search.Cells(np.arange(400), np.floor(64 * x), topk_search.LEVELS, 3)
    s = topk_search.statistics(np.floor(64 * x), 4)
    own = cells.of(s)
    for c in np.unique(own):
        cells.low[c], cells.high[c] = s[own == c].min(axis=0), s[own == c].max(axis=0)
    _, may = cells.meets(np.arange(400), np.floor(64 * x), 20)
    assert may.mean() < 0.7


def test_topk_bounds_hold():
    r = np.random.default_rng(0)
    x, y = r.integers(-60, 60, (50, 64)).astype(float), r.integers(-60, 60, (70, 64)).astype(float)
    for n in (1, 4, 16, 64):
        assert (topk_search.statistics(x, n) @ topk_search.statistics(y, n).T >= x @ y.T - 1e-6).all()


def near_texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = [[word() for _ in range(120)] for _ in range(12)]
    texts = [None, "", " \t\n", "one two", "One TWO", "a b c d e", "x y z x y z " * 40, "  odd space"]
    for b in base:
        for k in range(rng.choice([1, 2, 3, 25])):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    big = [word() for _ in range(100)]
    for k in range(150):  # one large group of near copies about the threshold
        w = list(big)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize(("similarity", "block"), [(0.85, 32), (0.8, 512)])
def test_minhash_dedup(spark, monkeypatch, similarity, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash_dedup, "BUCKET_BLOCK", block)
    texts = near_texts()
    rows = [(i, t, 1, "s") for i, t in enumerate(texts)] + [(None, "no id here at all", 1, "s"), (9, texts[9], 1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, sig string").repartition(3)
    got = minhash_dedup.near_dedup(df, similarity).collect()
    assert len(got) == len(rows)
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids, pct = [i for i in sets if sets[i]], round(100 * similarity)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b])]
    want = least(sets, edges)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert minhash_dedup.near_dedup(df.where("false")).count() == 0
    kept = minhash_dedup.kept_documents(df, similarity)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in want if want[i] == i} | {None}


def test_index_finds_every_pair_within_the_radius():
    r = np.random.default_rng(5)
    within = minhash_dedup.radius(0.85)
    a = r.integers(0, 1 << 16, (200, minhash_dedup.POSITIONS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = r.choice(minhash_dedup.POSITIONS, within, replace=False)
        row[at] = r.integers(0, 1 << 16, within)
    assert (minhash_dedup.entries(a, within) == minhash_dedup.entries(b, within)).any(axis=1).all()
    assert minhash_dedup.radius(0.8) > within


def test_quality(spark, data):
    docs, labels = spark.read.parquet(f"{data}/../sf0.01/documents.parquet"), spark.read.parquet(f"{data}/../sf0.01/labels.parquet")
    model = quality.fit(docs, labels, ~quality.held_out())
    got = quality.score(docs, model).join(labels, "doc_id").where(quality.held_out())
    right = got.agg(F.avg(((F.col("score") >= 0.3) == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right >= 0.95
    assert quality.kept_documents(docs, model).columns == docs.columns


def test_quality_odd_rows(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 50_000), (None, "some words"), (4, "\n")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(odd, none)
    assert [r.score for r in quality.score(odd, model).collect()] == [0.5] * 5
    labels = spark.createDataFrame([(2, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    scores = quality.score(odd, quality.fit(odd, labels)).collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 for r in scores)
    assert quality.score(odd.where("false"), model).count() == 0


def bags():
    r = np.random.default_rng(1)
    return [r.standard_normal((k, quality.WIDTH)).astype(np.float32) + (y - 0.5) for k, y in zip([1, 3, 2, 5] * 10, [0, 1, 1, 0] * 10)], np.array([0, 1, 1, 0] * 10, float)


def loop_score(m, bag):
    """One bag's score, passage by passage."""
    h = [np.tanh(np.clip((x - m.mean) / m.std, -5, 5) @ m.p["E"] + m.p["e"]) for x in bag.astype(float)]
    logits = [float(sum(w * np.tanh(v) / (1 + np.exp(-u)) for w, v, u in zip(m.p["w"], x @ m.p["V"], x @ m.p["U"]))) for x in h]
    weights = [np.exp(z) / sum(np.exp(y) for y in logits) for z in logits]
    return 1 / (1 + np.exp(-(sum(a * x for a, x in zip(weights, h)) @ m.p["c"] + m.p["d"][0])))


def test_fit_and_loop_version():
    x, y = bags()
    m = quality.AttentionMIL().fit(x, y)
    got = m.score(x)
    assert ((got > 0.5) == (y == 1)).all()
    assert np.allclose(got, [loop_score(m, b) for b in x], atol=1e-9)


def test_gradient():
    bag, y = bags()
    m = quality.AttentionMIL()
    x, starts = np.concatenate(bag).astype(float), np.concatenate(([0], np.cumsum([len(b) for b in bag])))[:-1]
    loss = lambda: -np.mean(np.where(y == 1, np.log(s := m._forward(x, starts)["y"]), np.log(1 - s)))
    r = np.random.default_rng(3)
    for name, grad in m.gradient(x, starts, y).items():
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in m.p[name].shape)
            held = m.p[name][at]
            m.p[name][at] = held + 1e-5
            up = loss()
            m.p[name][at] = held - 1e-5
            down = loss()
            m.p[name][at] = held
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-6, name


def test_passages_are_cut_between_words():
    text = "wörter " * 2000
    rows = quality.encode(text)
    assert len(rows) == -(-len(text.encode()) // quality.PASSAGE) and (abs(rows.sum(axis=1) - rows.sum(axis=1).mean()) < 1).all()
    assert len(quality.encode("x" * 5500)) == 6 and len(quality.encode("")) == 1


def test_quality_long_labelled_texts(spark):
    long = spark.createDataFrame([(i, ("good text here " if i % 2 else "!!! ??? ") * 20_000) for i in range(8)] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    model = quality.fit(long, labels, passages=4)
    assert all((r.score >= 0.5) == r.doc_id % 2 for r in quality.score(long, model).collect())
