from itertools import combinations

import numpy as np
import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from tidemark.llm import packing, queries, sharding, token_counts, tokens
from tidemark.llm.common import gapless_rank
from tidemark.llm.tokens import token_counter


def padding(lengths, counts, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    r = np.random.default_rng(seed)
    lengths = sorted(r.choice(np.arange(1, 60), 11, replace=False).tolist())
    counts = r.integers(1, 50, 11).tolist()
    for k in (1, 2, 3, 4, 20):
        got = packing.optimal_bounds(lengths, counts, k)
        best = min(padding(lengths, counts, [*c, lengths[-1]]) for j in range(min(k, 11)) for c in combinations(lengths[:-1], j))
        assert len(got) <= k or k > 11
        assert padding(lengths, counts, got) == best


def test_pack(spark, edge, empty):
    rows = packing.pack(edge, max_length=512, buckets=4, token_budget=1024).collect()
    tokens = {}
    count = token_counter(spark)
    for i, n in edge.select("doc_id", count(F.col("text")).alias("n")).collect():
        tokens[i] = tokens.get(i, 0) + n
    got = {}
    batches = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
        if r.n_tokens:
            assert r.n_tokens <= r.pad_to <= 512
            batches.setdefault((r.bucket, r.batch), []).append(r.pad_to)
        else:
            assert r.bucket is r.batch is r.slot is None
    assert got == tokens
    assert all(sum(b) <= 1024 for b in batches.values())
    full = {}
    for (bucket, batch), b in batches.items():
        full.setdefault(bucket, {})[batch] = len(b)
    for per in full.values():
        assert sorted(per) == list(range(len(per)))
        assert all(per[i] == 1024 // max(batches[k][0] for k in batches if per is full[k[0]]) for i in range(len(per) - 1))
    assert packing.pack(empty).count() == 0


def plain_lengths(spark, sf):
    """Tokens of every document, without Spark's batches."""
    encode = tokens._encoding(open(tokens.VOCABULARY, "rb").read()).encode_ordinary
    return {r.doc_id: len(encode(r.text)) if r.text else 0 for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def plain_bounds(hist, k):
    """Least padding of k buckets by trying every last boundary, over sorted lengths."""
    lengths = sorted(hist)
    cost = lambda a, b: sum(hist[x] * (lengths[b] - x) for x in lengths[a : b + 1])
    best = {(-1, 0): 0}
    for j in range(1, k + 1):
        for b in range(len(lengths)):
            options = [best[a, j - 1] + cost(a + 1, b) for a in range(-1, b) if (a, j - 1) in best]
            if options:
                best[b, j] = min(options)
    return min(v for (b, _), v in best.items() if b == len(lengths) - 1)


def test_the_count_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    lengths = list(plain_lengths(spark, sf).values())
    got = {r.context_limit: r for r in queries.op2_token_counts(spark, sf).collect()}
    assert set(got) == set(lengths)
    for c, r in got.items():
        assert (r.n_docs, r.docs_within, r.docs_over) == (lengths.count(c), sum(n <= c for n in lengths), sum(n > c for n in lengths))
        assert (r.tokens_within, r.truncated_total, r.total_tokens) == (sum(n for n in lengths if n <= c), sum(min(n, c) for n in lengths), sum(lengths))
        assert abs(r.quantile - r.docs_within / len(lengths)) < 1e-12


def test_the_packing_query_equals_brute_force(spark):
    sf, longest, budget = "/root/testdata/sf0.001", 8192, 65536
    lengths = plain_lengths(spark, sf)
    rows = queries.op1_packing(spark, sf).collect()
    want = {(i, p): min(longest, n - p * longest) for i, n in lengths.items() for p in range(max(1, -(-n // longest)))}
    assert {(r.doc_id, r.piece): r.n_tokens for r in rows} == want and len(rows) == len(want)
    full = [r for r in rows if r.n_tokens]
    hist = {}
    for r in full:
        hist[r.n_tokens] = hist.get(r.n_tokens, 0) + 1
    coarse = {}  # the same histogram in few lengths, so that all boundaries can be tried
    for n, c in hist.items():
        coarse[-(-n // 256) * 256] = coarse.get(-(-n // 256) * 256, 0) + c
    at = sorted(coarse)
    assert padding(at, [coarse[n] for n in at], packing.optimal_bounds(at, [coarse[n] for n in at], 16)) == plain_bounds(coarse, 16)
    bounds = packing.optimal_bounds(sorted(hist), [hist[n] for n in sorted(hist)], 16)
    batches = {}
    for r in full:
        assert r.pad_to == min(b for b in bounds if b >= r.n_tokens) and bounds[r.bucket] == r.pad_to
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    for (bucket, batch), slots in batches.items():
        per = max(1, budget // bounds[bucket])
        last = (bucket, batch + 1) not in batches
        assert sorted(slots) == list(range(len(slots))) and (len(slots) == per or last and len(slots) < per) and (batch == 0 or (bucket, batch - 1) in batches)


def test_suffix_sums(spark):
    lengths = [0, 0, 3, 3, 3, 5000, 1024, 1023, 70_000]
    hist = token_counts.histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens int"))
    rows = {r.context_limit: r for r in token_counts.suffix_sums(hist).collect()}
    assert set(rows) == set(lengths)
    for c, r in rows.items():
        assert r.n_docs == lengths.count(c)
        assert r.docs_over == sum(n > c for n in lengths)
        assert r.truncated_total == sum(min(n, c) for n in lengths)
        assert r.tokens_within == sum(n for n in lengths if n <= c)
        assert r.total_tokens == sum(lengths)
    any_limit = {r.context_limit: r for r in token_counts.at_limits(hist, [1, 4, 2000, 10**6]).collect()}
    assert all(r.truncated_total == sum(min(n, c) for n in lengths) for c, r in any_limit.items())
    q = {r.share: r.length for r in token_counts.quantiles(token_counts.suffix_sums(hist), [0.2, 0.5, 1.0]).collect()}
    assert q == {0.2: 0, 0.5: 3, 1.0: 70_000}
    assert token_counts.suffix_sums(hist.where("false")).count() == 0


def best_capacity(sizes, shards):
    c = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        n, held = 1, 0
        for s in sizes:
            if held + s > c:
                n, held = n + 1, 0
            held += s
        if n <= shards:
            return c
        c += 1


@pytest.mark.parametrize("seed,shards,hot", [(0, 5, 1), (1, 7, 1), (2, 3, 1), (3, 6, 4000), (4, 40, 1)])
def test_capacity_is_the_smallest(spark, seed, shards, hot, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "ATOMS", 64)
    r = np.random.default_rng(seed)
    keys = np.unique(r.integers(-(2**63), 2**63 - 1, 300))
    sizes = r.integers(1, 400, len(keys))
    sizes[17] *= hot
    groups = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes)], "key long, size long")
    cuts, capacity = sharding.cut_keys(groups, shards)
    assert capacity == best_capacity(sizes.tolist(), shards)
    bounds = np.searchsorted(keys, cuts)
    held = [int(x.sum()) for x in np.split(sizes, bounds)]
    assert max(held) <= capacity and len(held) <= shards
    if hot > 1:
        # what the forced group leaves over is cut alike: the smallest capacity of both sides in the other shards
        sides = [sizes[:17].tolist(), sizes[18:].tolist()]
        least = min(max(best_capacity(x, n) for x, n in zip(sides, (k, shards - 1 - k)) if x) for k in range(1, shards - 1))
        assert sorted(held)[-2] == least and held.count(int(sizes[17])) == 1


def test_several_forced_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 1)
    monkeypatch.setattr(sharding, "ATOMS", 8)
    sizes = [5, 900, 3, 3, 700, 4, 5, 6, 2, 1, 7]
    keys = [(i - 6) << 56 for i in range(len(sizes))]
    cuts, capacity = sharding.cut_keys(spark.createDataFrame(list(zip(keys, sizes)), "key long, size long"), 7)
    assert capacity == 900
    held = [x.tolist() for x in np.split(np.array(sizes), [keys.index(k) for k in cuts])]
    assert held == [[5], [900], [3, 3], [700], [4, 5], [6, 2, 1], [7]]
    assert sharding.cut_keys(spark.createDataFrame(list(zip(keys, sizes)), "key long, size long"), 1) == ([], sum(sizes))


def test_the_query_equals_brute_force(spark):
    import zlib

    import xxhash

    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op9_sharding(spark, sf).collect()}
    key = lambda t: int(np.uint64(xxhash.xxh64(t.encode(), seed=42).intdigest()).astype(np.int64))
    groups = {}
    for _, t in docs:
        groups[key(t)] = groups.get(key(t), 0) + len(t.encode()) + 16
    order = sorted(groups)
    capacity = best_capacity([groups[k] for k in order], 40)
    assert capacity > max(groups.values())  # no group forces it, so the cut is the greedy one
    shard, held, of = 0, 0, {}
    for k in order:
        if held + groups[k] > capacity:
            shard, held = shard + 1, 0
        held += groups[k]
        of[k] = shard
    assert len(got) == len(docs)
    for i, t in docs:
        assert (got[i].size, got[i].text_crc32, got[i].shard) == (len(t.encode()) + 16, zlib.crc32(t.encode()), of[key(t)])
    for n in set(of.values()):
        own = sorted(r.slot for r in got.values() if r.shard == n)
        assert own == list(range(len(own)))


def test_shard(spark, edge, empty):
    rows = sharding.shard(edge, 4).collect()
    assert len(rows) == edge.count()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    shard = {r.doc_id: r for r in rows}
    assert shard[1].shard == shard[2].shard
    assert shard[3].size == 16 and shard[3].text_crc32 == 0 and shard[4].size == 16
    assert shard[7].size == 16 + len(prose(3, 20_000))  # noqa: F405
    assert sharding.shard(empty, 4).count() == 0


def test_gapless_rank_over_salts(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, null, concat('g', id % 7))) as g")
    rows = gapless_rank(df, ["g"], ["id"], 5000, "rank").collect()
    by = {}
    for r in rows:
        by.setdefault(r.g, []).append(r["rank"])
    assert sum(map(len, by.values())) == 5000
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
