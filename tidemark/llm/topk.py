"""Exact top-k search by tiled matrix products.

A block of queries and a shard of candidates (an Arrow batch of BLOCK rows, where it lies) form a tile: one matrix
product and a partial selection of its k best. A task merges the tiles of a query block that it sees; what tasks
hold is merged in a tree of FAN nodes a level. Candidates never move: queries go to them, in groups of about
GROUP_BYTES, one pass over the candidates a group, and a task holds one tile at a time beside the group's lists.

Components become floor(scale * x), x as double; the score is the integer inner product, exact at any
magnitude: in float32 where no partial sum can reach 2**24, in float64 where none can reach 2**53, else in Python
integers. A score outside 64 bits counts as the nearest 64-bit integer, as it is returned.
Ties go to the smaller id. Defined results: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; of rows that share an id the smallest vector counts; vectors are only
compared within the same number of components; with fewer than k candidates all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, materialize

#: Vectors of a block. A tile's scores take BLOCK * STRIP * 8 bytes twice.
BLOCK = 4096
STRIP = 256
FAN = 16
#: Bytes of query vectors that are sent to the candidates at once.
GROUP_BYTES = 32 << 20
SINGLE, LIMIT = 2.0**24, 2.0**53


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(vector.isNotNull() & ~broken, whole)


def matrices(rows: pd.DataFrame):
    """(dim, ids, matrix) of rows (id, v), ids ascending, one for each number of components."""
    for dim, part in rows.groupby(rows["v"].map(len), sort=True):
        part = part.sort_values("id", kind="stable")
        yield int(dim), part["id"].to_numpy(np.int64), np.stack(part["v"].to_numpy()).astype(np.float64) if dim else np.zeros((len(part), 0))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """q @ c.T as exact integers: in floats while sums stay exact, else int64 held to its range."""
    most = q.shape[1] * float(np.abs(q).max()) * float(np.abs(c).max()) if q.size and c.size else 0.0
    if most < SINGLE:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.float64)
    if most < LIMIT:
        return q @ c.T
    big = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array([[int(x) for x in r] for r in c], dtype=object).T
    return np.clip(big, -(2**63), 2**63 - 1).astype(np.int64)


def tile_top(q_ids, q, c_ids, c, k: int):
    """(query id, id, score) of the k best of each query in a tile; c_ids ascend, so the first of equals has the smallest id."""
    out = []
    for at in range(0, len(q_ids), STRIP):
        ids = q_ids[at : at + STRIP]
        scores = products(q[at : at + STRIP], c)
        own = c_ids[None, :] == ids[:, None]
        n = scores.shape[1]
        if scores.dtype == np.float64 and (np.abs(scores).max(initial=0) + 1) * (n + 1) < LIMIT:
            key = scores * n + (n - 1 - np.arange(n))
            key[own] = -np.inf
            pick = np.argpartition(-key, min(k, n) - 1, axis=1)[:, :k] if n > k else np.tile(np.arange(n), (len(ids), 1))
        else:
            pick = np.empty((len(ids), min(k + 1, n)), dtype=np.int64)
            for i, row in enumerate(scores):
                pick[i] = np.lexsort((c_ids, [-int(x) for x in row] if row.dtype == np.int64 else -row))[: min(k + 1, n)]
        row = np.repeat(np.arange(len(ids)), pick.shape[1])
        col = pick.ravel()
        fine = ~own[row, col]
        row, col = row[fine], col[fine]
        out.append((ids[row], c_ids[col], scores[row, col].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*out)]


def best(q_ids, ids, scores, k: int):
    """The k best of each query among merged lists."""
    order = np.lexsort((ids, -scores.astype(np.float64) if abs(scores).max(initial=0) < LIMIT else [-int(s) for s in scores], q_ids))
    q_ids, ids, scores = q_ids[order], ids[order], scores[order]
    first = np.r_[True, q_ids[1:] != q_ids[:-1]] if len(q_ids) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    rank = np.arange(len(q_ids)) - np.repeat(start, np.diff(np.r_[start, len(q_ids)]))
    keep = rank < k
    return q_ids[keep], ids[keep], scores[keep]


def _search(shared, k: int):
    def run(frames):
        blocks, held = shared.value, {}
        for pdf in frames:
            for dim, ids, m in matrices(pdf):
                for n, (q_ids, q) in enumerate(blocks.get(dim, ())):
                    found = tile_top(q_ids, q, ids, m, k)
                    kept = held.get((dim, n))
                    held[dim, n] = list(best(*[np.concatenate(x) for x in zip(kept, found)], k)) if kept else found
        for found in held.values():
            yield pd.DataFrame({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    return run


def query_blocks(rows: pd.DataFrame) -> dict[int, list]:
    """Blocks of (ids, matrix) by number of components."""
    return {dim: [(ids[at : at + BLOCK], m[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)] for dim, ids, m in matrices(rows)} if len(rows) else {}


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row among all rows but its own."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), is_query.alias("asked"))
    rows = materialize(rows.where("id is not null and v is not null").groupBy("id").agg(F.min("v").alias("v"), F.max("asked").alias("asked")), "topk-vectors")
    asked = rows.where("asked").select("id", "v")
    cells = asked.agg(F.sum(F.size("v") + 1)).first()[0] or 0
    groups = max(1, -(-8 * cells // GROUP_BYTES))
    every = None
    for g in range(groups):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == g) if groups > 1 else asked
        sent = spark.sparkContext.broadcast(query_blocks(own.toArrow().to_pandas()))
        found = rows.select("id", "v").mapInPandas(_search(sent, k), "query_id long, vec_id long, score long")
        found = found.withColumn("node", F.spark_partition_id())
        with batches(spark, BLOCK):
            found = materialize(found, "topk-tiles")
        sent.unpersist()
        every = found if every is None else every.unionByName(found)
    nodes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc("vec_id")]
    every = every.withColumn("node", F.pmod("node", F.lit(nodes)))
    while nodes > FAN:
        nodes = -(-nodes // FAN)
        every = every.withColumn("node", F.pmod("node", F.lit(nodes)))
        every = every.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "node").orderBy(*order))).where(F.col("rank") <= k).drop("rank")
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
