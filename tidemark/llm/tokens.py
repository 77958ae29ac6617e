"""Token counts of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Rank file of the vocabulary that queries use; a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def token_counter(spark: SparkSession, vocabulary: str = VOCABULARY):
    """A function of a text column that gives its number of tokens (null: 0). The driver reads the file; executors get its bytes."""
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(ranks.value).encode_ordinary
        return pd.Series([0 if t is None else len(encode(t)) for t in texts], dtype="int64")

    def counted(text: Column) -> Column:
        return count(text)

    return counted
