"""Packing into length buckets that minimise padding, and token-budget batches inside each bucket.

A document of more than `max_length` tokens is cut into pieces of max_length and a rest. The global histogram
of piece lengths (at most max_length rows) goes to the driver, where dynamic programming over its lengths
finds the `buckets` upper bounds with the least total padding; the cost is of Monge kind, so each layer is
solved by divide and conquer over monotone optima. Inside a bucket pieces are numbered without gaps, a fixed
pseudo-random order of the documents, and every `token_budget // bound` of them form a batch.

Defined results: documents without tokens (null or empty text) get one row of 0 tokens with null bucket,
pad_to, batch and slot; repeated rows are all packed; no documents give no rows; a bound above the budget
makes batches of one piece.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import gapless_rank, materialize, small_batches
from tidemark.llm.tokens import VOCABULARY, token_counter


def optimal_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets over the sorted lengths with the least total padding."""
    m = len(lengths)
    if m <= buckets:
        return list(lengths)
    top = np.r_[0, np.asarray(lengths, dtype=np.int64)]
    docs = np.r_[0, np.cumsum(np.asarray(counts, dtype=np.int64))]
    best = top * docs  # padded tokens, one bucket; unpadded tokens are the same for all choices
    best[0] = 0
    choices = []
    for _ in range(buckets - 1):
        new, arg = best.copy(), np.zeros(m + 1, dtype=np.int64)
        todo = [(1, m, 0, m - 1)]
        while todo:
            a, b, low, high = todo.pop()
            mid = (a + b) // 2
            to = min(high, mid - 1)
            cost = best[low : to + 1] + top[mid] * (docs[mid] - docs[low : to + 1])
            at = low + int(np.argmin(cost))
            new[mid], arg[mid] = cost[at - low], at
            if a < mid:
                todo.append((a, mid - 1, low, at))
            if mid < b:
                todo.append((mid + 1, b, at, high))
        best, choices = new, [*choices, arg]
    bounds, at = [], m
    for arg in reversed(choices):
        bounds.append(int(top[at]))
        at = int(arg[at])
        if not at:
            break
    if at:
        bounds.append(int(top[at]))
    return sorted(bounds)


def pieces(lengths: DataFrame, max_length: int, length: str = "n_tokens") -> DataFrame:
    """A row for each piece: piece number and its tokens; a document without tokens keeps one row."""
    n = F.col(length)
    count = F.greatest(F.lit(1), F.ceil(n / max_length)).cast("int")
    cut = lengths.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    return cut.withColumn(length, F.least(F.lit(max_length), n - F.col("piece") * max_length).cast("long"))


def pack_lengths(lengths: DataFrame, max_length: int, buckets: int, token_budget: int, id_col: str = "doc_id", length: str = "n_tokens") -> DataFrame:
    """Pack rows of (id, tokens), which are read several times: id, piece, n_tokens, bucket, pad_to, batch, slot."""
    cut = pieces(lengths.select(id_col, length), max_length, length)
    hist = {r[0]: r[1] for r in cut.groupBy(length).count().collect()}  # at most max_length + 1 rows
    present = sorted(x for x in hist if x > 0)
    bounds = optimal_bounds(present, [hist[x] for x in present], buckets)
    n = F.col(length)
    bucket = pad = F.lit(None).cast("int")
    for i, bound in reversed(list(enumerate(bounds))):
        bucket, pad = F.when(n <= bound, i).otherwise(bucket), F.when(n <= bound, bound).otherwise(pad)
    dealt = cut.withColumns({"bucket": F.when(n > 0, bucket).cast("int"), "pad_to": F.when(n > 0, pad).cast("int")})
    ranked = gapless_rank(dealt, ["bucket"], [id_col, "piece", length], sum(hist.values()), "_rank")
    per = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("pad_to"))).cast("long")
    batch = F.when(F.col("bucket").isNotNull(), F.floor(F.col("_rank") / per).cast("long"))
    slot = F.when(F.col("bucket").isNotNull(), F.pmod(F.col("_rank"), per).cast("int"))
    return ranked.select(id_col, "piece", F.col(length).alias("n_tokens"), "bucket", "pad_to", batch.alias("batch"), slot.alias("slot"))


def pack(docs: DataFrame, max_length: int = 8192, buckets: int = 16, token_budget: int = 65536, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the tokens of whole texts once, then pack_lengths()."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    count = token_counter(spark, vocabulary)
    lengths = materialize(docs.select(F.col(id_col), count(F.col(text_col)).alias("n_tokens")), "pack-lengths")
    return pack_lengths(lengths, max_length, buckets, token_budget, id_col)
