"""Results kept as Parquet by fingerprint, with a budget."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.store import Files


class ResultCache:
    """top: a folder that driver and executors share, in any of Spark's file systems. The least recently used results go first."""

    def __init__(self, spark: SparkSession, top: str, max_mb: float = 2000):
        self.spark, self.top, self.max_mb, self.files = spark, top.rstrip("/"), max_mb, Files(spark)

    def _meta(self, key: str) -> str:
        return f"{self.top}/{key}.json"

    def get(self, key: str) -> DataFrame | None:
        text = self.files.read_text(self._meta(key))
        if text is None:
            return None
        self.files.write_text(self._meta(key), json.dumps(json.loads(text) | {"accessed_at": time.time()}))
        return self.spark.read.parquet(f"{self.top}/{key}")

    def put(self, key: str, dataset: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.top}/{key}")
        size = sum(b for _, _, b in self.files.find(f"{self.top}/{key}/*"))
        self.files.write_text(self._meta(key), json.dumps({"dataset": dataset, "bytes": size, "created_at": time.time(), "accessed_at": None}))
        self._evict(keep=key)
        return self.spark.read.parquet(f"{self.top}/{key}")

    def entries(self) -> dict[str, dict]:
        names = [p for p, _, _ in self.files.find(f"{self.top}/*.json")]
        return {p.rpartition("/")[2].removesuffix(".json"): json.loads(text) for p in names if (text := self.files.read_text(p))}

    def invalidate(self, dataset: str | None = None) -> int:
        """Drop all results, or a dataset's. How many."""
        gone = [k for k, m in self.entries().items() if dataset in (None, m["dataset"])]
        for k in gone:
            self._drop(k)
        return len(gone)

    def _drop(self, key: str) -> None:
        self.files.delete(f"{self.top}/{key}")
        self.files.delete(self._meta(key))

    def _evict(self, keep: str) -> None:
        have = self.entries()
        total = sum(m["bytes"] for m in have.values())
        for key in sorted(have, key=lambda k: have[k]["accessed_at"] or have[k]["created_at"]):
            if total <= self.max_mb * 1e6:
                break
            if key != keep:
                total -= have[key]["bytes"]
                self._drop(key)
