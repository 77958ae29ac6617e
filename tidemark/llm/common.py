"""Helpers shared by the training-data operators: shared-storage tables, text tables and gapless ranks."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Most salts a group is spread over by gapless_rank(); bounds its table of offsets to groups x SALTS rows.
SALTS = 4096
#: Rows that one salt of gapless_rank() is meant to hold while the number of salts is below SALTS.
ROWS_PER_SALT = 256

_written: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may be gone already; the folder is scratch space
            return


_BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


@contextmanager
def batches(spark: SparkSession, rows: int = 1024, size: str = "8m") -> Iterator[None]:
    """Bound what one Arrow batch holds, so that a run of very long texts doesn't swell a Python worker; for what is written inside, the caller's settings return."""
    before = [spark.conf.get(k, None) for k in _BATCH]
    for k, v in zip(_BATCH, (str(rows), size)):
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in zip(_BATCH, before):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_batches(spark: SparkSession) -> None:
    """The bounds of batches() for results that are returned unwritten; they hold in the session from then on, where the caller's are not smaller."""
    rows, size = 1024, 8 << 20
    have_rows, have_size = (spark.conf.get(k, None) for k in _BATCH)
    if have_rows is None or not 0 < int(have_rows) <= rows:
        spark.conf.set(_BATCH[0], str(rows))
    if have_size is None or not 0 < in_bytes(have_size) <= size:
        spark.conf.set(_BATCH[1], str(size))


def in_bytes(text: str) -> int:
    """Bytes of a size as Spark writes it: a number, with a unit or none."""
    number = text.strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if unit else number) << unit


def inner(name: str) -> str:
    """A column's name inside an operator, which no column of a caller has."""
    return f"__tidemark_{name}__"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_bytes(text: Column) -> Column:
    """Bytes of the text in UTF-8; 0 where it is null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def salts_for(n_rows: int) -> int:
    return max(1, min(SALTS, n_rows // ROWS_PER_SALT))


def gapless_rank(df: DataFrame, group: list[str], order: list[str], n_rows: int, out: str) -> DataFrame:
    """Add `out`: 0, 1, 2, ... within each group, without one task holding a group.

    Rows are dealt by (group, salt), where the salt is a hash of the order columns; each salt is ranked by
    itself and shifted by the number of rows in the salts before it. The order within a group is (salt,
    order columns): fixed by the rows' contents, not by how they were dealt. Rows alike in group and order
    columns take neighbouring ranks, in any order. df is read twice: materialize() it first if it is costly.
    """
    salts = salts_for(n_rows)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = salted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy(*group, "_salt").orderBy(*order)
    ranked = salted.withColumn("_own", F.row_number().over(own) - 1)
    keys = [*group, "_salt"]
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    joined = ranked.alias("r").join(shift.alias("s"), on, "left")
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r._own") + F.col("s._shift")).cast("long").alias(out))
