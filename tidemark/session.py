"""Sessions as the engine expects them."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that the engine's semantics rest on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_shipped: set[str] = set()


def session(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; the number of shuffle partitions is left to the cluster unless given."""
    builder = SparkSession.builder.config(map=SETTINGS | more)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only in local mode, where there are no other machines, one is made if it is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once an application, so that it need not be installed on them."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidemark-ship-")) / "tidemark.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
