import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from tidemark.llm import near_dedup, topk


def brute(rows, k):
    best = {}
    for i, v in rows.items():
        best[i] = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows.items() if j != i and len(w) == len(v)))[:k]
    return {i: [(j, -s) for s, j in x] for i, x in best.items()}


def run(spark, vectors, k=3):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, query_id long, rank int, score double")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 2 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def test_topk_with_ties_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    r = random.Random(1)
    rows = {i: [float(r.randrange(-2, 3)) for _ in range(4)] for i in range(60)}
    got = run(spark, [(i, v, 1, 1, 1.0) for i, v in rows.items()])
    whole = {i: [256 * x for x in v] for i, v in rows.items()}
    assert got == {i: x for i, x in brute(whole, 3).items() if i % 2 == 0}


def test_topk_in_groups_of_queries_leaves_settings_alone(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_BYTES", 200)
    monkeypatch.setattr(topk, "FAN", 2)
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(n, None) for n in names]
    r = random.Random(2)
    rows = {i: [r.choice([-1.0, 0.5, 0.25, 3e4]) for _ in range(3)] for i in range(80)}
    assert run(spark, [(i, v, 1, 1, 1.0) for i, v in rows.items()]) == {i: x for i, x in brute({i: [256 * x for x in v] for i, v in rows.items()}, 3).items() if i % 2 == 0}
    assert [spark.conf.get(n, None) for n in names] == before


def test_topk_edges(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (4, [nan, 1.0]), (6, [inf, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [1e12, -1e12]), (10, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (12, [1e300, 1.0]), (11, [])]
    got = run(spark, [(i, v, 1, 1, 1.0) for i, v in vectors])
    assert set(got) == {0, 8, 12}  # 10 is alone in its number of components
    assert [j for j, _ in got[0]] == [12, 8, 9] and got[8][0][0] == 12
    assert got[0][0][1] == 2**63 - 1
    assert run(spark, []) == {}


def jaccard_components(rows, k):
    sets = {i: set(near_dedup.shingles(t, k).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                x = len(sets[a] & sets[b])
                if 100 * x >= 80 * (len(sets[a]) + len(sets[b]) - x):
                    ra, rb = sorted((find(a), find(b)))
                    root[rb] = ra
    return {i: (len(sets[i]), find(i)) for i in ids}


def families(seed, groups, size, words=60):
    r = random.Random(seed)
    rows, n = [], 0
    for g in range(groups):
        base = prose(1000 * seed + g, words).split()  # noqa: F405
        for _ in range(size):
            own = list(base)
            for _ in range(r.randrange(0, 4)):
                own[r.randrange(len(own))] = f"edit{r.randrange(10**6)}"
            rows.append((n, " ".join(own)))
            n += 1
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = families(1, 12, 12) + [(1000 + i, prose(50_000 + i, 50)) for i in range(60)]  # noqa: F405
    got = {r.doc_id: (r.n_shingles, r.component) for r in near_dedup.near_duplicates(docs_of(spark, rows), shingle=4).collect()}  # noqa: F405
    assert got == jaccard_components(rows, 4)


def test_large_nodes_branch_and_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    monkeypatch.setattr(near_dedup, "OTHERS", 4)
    monkeypatch.setattr(near_dedup, "DEPTH", 2)
    rows = families(2, 3, 60, 40)
    got = {r.doc_id: r.component for r in near_dedup.near_duplicates(docs_of(spark, rows), shingle=4).collect()}  # noqa: F405
    assert got == {i: c for i, (_, c) in jaccard_components(rows, 4).items()}


def test_long_texts_make_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HELD_SHINGLES", 300)
    monkeypatch.setattr(near_dedup, "SALTED", 3)
    monkeypatch.setattr(near_dedup, "CENTRAL", 2)
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 6)
    rows = families(4, 4, 14, 50)
    got = {r.doc_id: r.component for r in near_dedup.near_duplicates(docs_of(spark, rows), shingle=4).collect()}  # noqa: F405
    assert got == {i: c for i, (_, c) in jaccard_components(rows, 4).items()}


def test_sets_that_share_a_key_stay_apart(spark, monkeypatch):
    def with_one_key(k):
        def run(frames):
            for out in near_dedup_signatures(k)(frames):
                out.loc[out["n"] > 0, "key"] = 5
                yield out

        return run

    near_dedup_signatures = near_dedup._signatures
    monkeypatch.setattr(near_dedup, "_signatures", with_one_key)
    monkeypatch.setattr(near_dedup, "_texts_of", lambda k: lambda frames: (f[["key", "text"]] for f in frames))
    rows = [(1, prose(1, 40)), (2, prose(2, 40)), (3, prose(1, 40))]  # noqa: F405
    got = {r.doc_id: r.component for r in near_dedup.near_duplicates(docs_of(spark, rows)).collect()}  # noqa: F405
    assert got == {1: 1, 2: 2, 3: 1}


def test_pairs_stay_together_below_the_root():
    """Pairs at the threshold that share a node in one of the trees, level by level, as if all nodes branched on."""
    r = np.random.default_rng(9)
    pairs = 300
    left = r.integers(0, 2**32, (pairs, near_dedup.COORDINATES), dtype=np.uint64).astype(np.uint32)
    right = np.where(r.random(left.shape) < 0.8, left, r.integers(0, 2**32, left.shape, dtype=np.uint64).astype(np.uint32))
    roots = [int(x) for x in near_dedup.mix(np.arange(1, near_dedup.TREES + 1, dtype=np.uint64) * near_dedup._BASE).view(np.int64)]
    both = pd.DataFrame({"key": np.r_[np.arange(pairs), np.arange(pairs)], "s1": 0, "s2": np.r_[np.zeros(pairs, int), np.ones(pairs, int)], "tokens": [x.tobytes() for x in (*left, *right)]})
    nodes = pd.concat(near_dedup._branch(0.8, roots)(iter([both])))
    alive = []
    for depth in range(5):
        shared = nodes.groupby(["node", "key"])["s2"].nunique()
        shared = shared[shared == 2].reset_index()[["node", "key"]]
        alive.append(shared["key"].nunique())
        if depth < 4:
            again = shared.merge(both, on="key")
            nodes = pd.concat(near_dedup._branch(0.8, None)(iter([again])))
    assert alive[0] == pairs and min(alive) >= 0.98 * pairs


def test_near_edges(spark, edge, empty):
    rows = near_dedup.near_duplicates(edge, shingle=4).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].component == by[2].component == by[9].component == 1
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0
    assert by[3].component == 3 and by[6].n_shingles == 1 and by[6].component == 6
    assert [r.component for r in rows if r.doc_id is None] == [None]
    assert near_dedup.near_duplicates(empty).count() == 0


def test_overlaps_and_forest():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 50, 30)).astype(np.uint64) for _ in range(9)]
    assert (near_dedup.overlaps(sets) - np.diag([len(s) for s in sets]) * 0 == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]).all()
    near = np.zeros((6, 6), bool)
    for a, b in ((0, 3), (3, 5), (5, 0), (1, 2)):
        near[a, b] = near[b, a] = True
    i, j = near_dedup.forest(near)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 3), (0, 5), (1, 2)]


def peak_mb(f):
    tracemalloc.start()
    try:
        out = f()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_overlaps_of_large_sets_in_ranges():
    r = np.random.default_rng(4)
    every = np.unique(r.integers(0, 2**64, 60_000, dtype=np.uint64))
    sets = [np.sort(r.choice(every, 50_000 - 500 * i, replace=False)) for i in range(40)]
    both, peak = peak_mb(lambda: near_dedup.overlaps(sets))
    assert peak < 60  # 39; 80 when all are sorted at once
    assert all(both[a, b] == len(np.intersect1d(sets[a], sets[b])) for a, b in ((0, 1), (0, 39), (39, 0), (17, 23), (5, 5)))


def test_the_largest_tile_takes_little_memory():
    """A family of OTHERS texts outside a block of the largest component, which both Python workers of an executor may hold at once."""
    n = near_dedup.SMALL + near_dedup.OTHERS
    r = np.random.default_rng(5)
    texts = [f"{prose(i // 2, 30)} {i % 2}" for i in range(n)]  # noqa: F405
    sketch = np.repeat(r.integers(0, 2**62, 2), n // 2)
    pdf = pd.DataFrame({"node": 1, "tile": 0, "key": np.arange(n), "s1": sketch, "s2": sketch, "root": np.arange(n), "text": texts})
    near_dedup.shingles(" ".join(texts), 4)  # the words' hashes are kept
    got, peak = peak_mb(lambda: near_dedup._settle(4, 0.8, 33)(pdf))
    assert sorted(zip(got["a"], got["b"])) == [(i, i + 1) for i in range(0, n, 2)]
    assert peak < 110  # 60; 224 when all pairs are worked out at once
    spans, peak = peak_mb(lambda: near_dedup._compare(33)(pdf.drop(columns="text")))
    assert len(spans) == n - 2 and peak < 40  # 13; 72


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.key: r.root for r in near_dedup.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


@pytest.mark.parametrize("hot", [near_dedup.HOT_ROWS, 20])
def test_hubs_are_the_members_nearest_to_the_majority(spark, monkeypatch, hot):
    monkeypatch.setattr(near_dedup, "HOT_ROWS", hot)
    r = np.random.default_rng(1)
    sizes = [1, 2, 8, 9, 10, 40, 301]
    members = {node: [tuple(int(x) for x in r.integers(-(2**63), 2**63, 3)) for _ in range(n)] for node, n in enumerate(sizes)}
    rows = spark.createDataFrame([(node, *m) for node, ms in members.items() for m in ms], near_dedup.NODE)
    got = {x.node: (x.size, x.hub.key) for x in near_dedup.hubs_of(rows, rows.count()).collect()}
    want = {}
    for node, ms in members.items():
        bits = np.array([[(v >> i) & 1 for v in m[1:] for i in range(64)] for m in ms])
        off = (bits != (2 * bits.sum(axis=0) > len(ms))).sum(axis=1) if len(ms) > near_dedup.CENTRAL else np.zeros(len(ms), int)
        if len(ms) > 1:
            want[node] = (len(ms), min((int(o), m[0]) for o, m in zip(off, ms))[1])
    assert got == want
