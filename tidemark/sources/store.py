"""Ingestion into the store: projected to the declared schema, partitioned by month, a file a session, incremental."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.catalog import Catalog, Dataset


#: The column of staged sessions, and the session's eight digits in a file's path (a file, or a folder of parts).
SESSION = "__session"
SESSION_OF = r"([0-9]{8})[^/_]*(?:/part-[^/]*)?$"


class Files:
    """Listing, times, small texts, moves and deletion through Hadoop's file systems, so that any store that Spark reads will do."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self._conf), p

    def _glob(self, pattern: str):
        fs, p = self._at(pattern)
        return fs.globStatus(p) or []

    def find(self, pattern: str) -> list[tuple[str, int, int]]:
        """(path, time of change, bytes) of files that match."""
        return sorted((str(s.getPath().toString()), int(s.getModificationTime()), int(s.getLen())) for s in self._glob(pattern))

    def complete(self, pattern: str) -> list[tuple[str, int]]:
        """(path, time of change) of what matches and was written to its end: plain files, and folders that hold _SUCCESS."""
        plain = [(str(s.getPath().toString()), int(s.getModificationTime())) for s in self._glob(pattern) if s.isFile()]
        folders = [(p.rpartition("/")[0], t) for p, t, _ in self.find(f"{pattern}/_SUCCESS")]
        return sorted(plain + folders)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def publish(self, staged: str, target: str) -> None:
        """Put a folder in place of the target; _SUCCESS comes last, as a move is not one step in every file system."""
        fs, p = self._at(staged)
        to = self._path(target)
        fs.mkdirs(to.getParent())
        fs.delete(self._path(f"{staged}/_SUCCESS"), False)
        fs.delete(to, True)
        if not fs.rename(p, to):
            raise OSError(f"can't move {staged} to {target}")
        self.write_text(f"{target}/_SUCCESS", "")

    def read_text(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def path_of(template: str, date: dt.date) -> str:
    return template.format(year=date.year, month=date.month, date=date.strftime("%Y%m%d"))


def date_of(path: str) -> dt.date | None:
    """The first eight digits after the last underscore of a file's stem."""
    stem = path.rpartition("/")[2].rpartition(".")[0].rpartition("_")[2]
    try:
        return dt.datetime.strptime(re.match(r"\d{8}", stem)[0], "%Y%m%d").date()
    except (TypeError, ValueError):
        return None


def conform(df: DataFrame, dataset: Dataset, also: list[str] = ()) -> DataFrame:
    """Renamed, without dropped columns, projected and cast to the declared schema; a missing declared column raises. also: columns kept as they are."""
    df = df.withColumnsRenamed(dataset.rename).drop(*dataset.drop)
    want = [f for f in dataset.schema.fields if f.name not in dataset.drop]
    if missing := [f.name for f in want if f.name not in df.columns]:
        raise ValueError(f"{dataset.name}: missing columns {missing}")
    return df.select(*[_cast(df, f).alias(f.name) for f in want], *also)


def _cast(df: DataFrame, f: T.StructField):
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.TimestampNTZType) and isinstance(df.schema[f.name].dataType, T.LongType):
        return F.timestamp_micros(F.floor(c / 1000)).cast("timestamp_ntz")  # nanoseconds read as numbers
    return c.cast(f.dataType)


def coerced(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns; what can't be cast is null."""
    have = set(df.columns)
    return df.select(*[(F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})") if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


class Store:
    """raw: top of the vendor's files; top: folder above the store."""

    def __init__(self, spark: SparkSession, raw: str, top: str, catalog: Catalog):
        self.spark, self.raw, self.top, self.catalog, self.files = spark, raw.rstrip("/"), top.rstrip("/"), catalog, Files(spark)

    def _read(self, dataset: Dataset, paths: list[str]) -> DataFrame:
        self.spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        if dataset.source_format == "csv":
            return self.spark.read.option("header", True).csv(paths)
        return self.spark.read.parquet(*paths)

    def dates(self, name: str) -> list[dt.date]:
        """Sessions that have a source file."""
        d = self.catalog.get(name)
        pattern = re.sub(r"\{[^}]*\}", "*", d.source_path)
        return sorted({x for p, _, _ in self.files.find(f"{self.raw}/{pattern}") if (x := date_of(p))})

    def ingest(self, name: str, dates: list[dt.date] | None = None, delete_source: bool = False) -> dict[str, int]:
        """Write what is new. {ingested, skipped, errors, bytes_written, bytes_freed}; a bad file does not stop the others.

        Sessions of a month are one job without a shuffle: each is a partition of what is staged beside the store, its rows sorted as they were
        read, and is moved into place when all is written, so a target is either whole or as it was. Where a job fails its sessions are tried one by one.
        """
        d = self.catalog.get(name)
        stats = dict.fromkeys(("ingested", "skipped", "errors", "bytes_written", "bytes_freed"), 0)
        months: dict[tuple, list] = {}
        for source, target, day in self._jobs(d, dates):
            try:
                if self._wanted(d, source, target, stats):
                    months.setdefault((day.year, day.month) if day else (source,), []).append((source, target, day))
            except Exception as e:  # noqa: BLE001
                self._failed(stats, source, e)
        for jobs in months.values():
            done = self._together(d, jobs) if len(jobs) > 1 else set()
            for source, target, _ in jobs:
                try:
                    if target not in done:
                        self._alone(d, source, target)
                    self._stored(source, target, delete_source, stats)
                except Exception as e:  # noqa: BLE001
                    self._failed(stats, source, e)
        return stats

    @staticmethod
    def _failed(stats: dict, source: str, e: Exception) -> None:
        stats["errors"] += 1
        stats.setdefault("messages", []).append(f"{source}: {str(e)[:200]}")

    def _jobs(self, d: Dataset, dates):
        if d.single_file:
            return [(f"{self.raw}/{d.source_path}", f"{self.top}/{d.store_path}", None)]
        if d.bulk:
            pattern = re.sub(r"\{[^}]*\}", "*", d.source_path)
            jobs = []
            for p, _, _ in self.files.find(f"{self.raw}/{pattern}"):
                m = re.search(r"year=(\d{4})/month=(\d{1,2})/([^/]+)$", p)
                jobs.append((p, f"{self.top}/{d.root}/year={m[1]}/month={int(m[2]):02d}/{m[3]}" if m else None, None))
            return jobs
        return [(f"{self.raw}/{path_of(d.source_path, x)}", f"{self.top}/{path_of(d.store_path, x)}", x) for x in (dates or self.dates(d.name))]

    def _wanted(self, d: Dataset, source: str, target: str | None, stats: dict) -> bool:
        """Whether the source is there and newer than what is stored whole."""
        if target is None:
            raise ValueError("no year= and month= in the path")
        found = self.files.find(source)
        if not found and d.single_file:
            raise FileNotFoundError(source)
        have = self.files.complete(target)
        if not found or (have and not d.single_file and have[0][1] >= found[0][1]):
            stats["skipped"] += 1
            return False
        return True

    def _order(self, d: Dataset) -> list[str]:
        return [c for c in (d.index, "strike", "right") if c in d.columns]

    def _staging(self, d: Dataset) -> str:
        return f"{self.top}/_staging/{d.name}-{uuid.uuid4().hex}"

    def _together(self, d: Dataset, jobs: list) -> set[str]:
        """Write several sessions by one job; the targets that are in place. Sessions without rows are left out."""
        staged, done = self._staging(d), set()
        try:
            raw = self._read(d, [source for source, _, _ in jobs])
            held = raw.withColumn(SESSION, F.regexp_extract(F.col("_metadata.file_path"), SESSION_OF, 1))
            rows = conform(held, d, also=[SESSION]).sortWithinPartitions(SESSION, *self._order(d))
            rows.write.option("compression", "zstd").partitionBy(SESSION).parquet(staged)
            for _, target, day in jobs:
                part = f"{staged}/{SESSION}={day:%Y%m%d}"
                if self.files.find(f"{part}/*"):
                    self.files.publish(part, target)
                    done.add(target)
        except Exception:  # noqa: BLE001
            pass  # each of the others is tried alone, which tells what is wrong with it
        finally:
            self.files.delete(staged)
        return done

    def _alone(self, d: Dataset, source: str, target: str) -> None:
        staged = self._staging(d)
        try:
            rows = conform(self._read(d, [source]), d).sortWithinPartitions(*self._order(d))
            if not d.bulk:
                rows = rows.coalesce(1)  # a session or one small file
            rows.write.option("compression", "zstd").parquet(staged)
            self.files.publish(staged, target)
        finally:
            self.files.delete(staged)

    def _stored(self, source: str, target: str, delete_source: bool, stats: dict) -> None:
        stats["ingested"] += 1
        stats["bytes_written"] += sum(b for _, _, b in self.files.find(f"{target}/*.parquet"))
        if delete_source and source != target:
            stats["bytes_freed"] += sum(b for _, _, b in self.files.find(source))
            self.files.delete(source)

    def stored_files(self, name: str) -> list[str]:
        """What is stored whole of a dataset, a path a session."""
        d = self.catalog.get(name)
        pattern = re.sub(r"\{[^}]*\}", "*", d.store_path)
        return [p for p, _ in self.files.complete(f"{self.top}/{pattern}")]

    def available(self, name: str) -> list[dt.date]:
        return sorted({x for p in self.stored_files(name) if (x := date_of(p))})

    def split(self, name: str, df: DataFrame, dry_run: bool = False) -> dict[str, int]:
        """The sessions of a dataset's rows, each where the loader seeks it. Rows by session, of those that were not stored alike before."""
        d = self.catalog.get(name)
        return write_sessions(conform(df, d), f"{self.top}/{d.root}", dry_run, d.index)

    def snapshot(self, name: str) -> str:
        """Changes whenever a file of the dataset does."""
        import hashlib

        d = self.catalog.get(name)
        pattern = re.sub(r"\{[^}]*\}", "*", d.store_path)
        return hashlib.sha256(repr(self.files.find(f"{self.top}/{pattern}")).encode()).hexdigest()[:16]


def split_sessions(df: DataFrame, index: str | None = None) -> DataFrame:
    """Rows with their session date (and its year and month); rows without a time go."""
    index = index or ("timestamp" if "timestamp" in df.columns else "created")
    day = F.to_date(index)
    return df.where(F.col(index).isNotNull()).withColumns({"session": day, "year": F.year(day), "month": F.month(day)})


def write_sessions(df: DataFrame, path: str, dry_run: bool = False, index: str | None = None) -> dict[str, int]:
    """A folder a session: path/year=YYYY/month=MM/YYYYMMDD.parquet; a session is a day of one dataset. Rows by session that are (or in a dry run
    would be) written: a session stored with as many rows is left alone, other sessions stay as they are."""
    spark, files = df.sparkSession, Files(df.sparkSession)
    rows = split_sessions(df, index).drop("year", "month")
    counts = {r["session"]: r["count"] for r in rows.groupBy("session").count().collect()}  # a row a day
    target = {day: f"{path}/{path_of('year={year}/month={month:02d}/{date}.parquet', day)}" for day in counts}
    have = [p for day in counts if (p := target[day]) and files.complete(p)]
    stored = {}
    if have:
        name = F.regexp_extract(F.col("_metadata.file_path"), SESSION_OF, 1).alias("session")
        stored = {r["session"]: r["count"] for r in spark.read.parquet(*have).select(name).groupBy("session").count().collect()}
    new = {day: n for day, n in counts.items() if stored.get(f"{day:%Y%m%d}") != n}
    if new and not dry_run:
        staged = f"{path}/_staging-{uuid.uuid4().hex}"
        try:
            some = rows.where(F.col("session").isin(list(new))).withColumn(SESSION, F.date_format("session", "yyyyMMdd")).drop("session")
            some.repartition(len(new), SESSION).write.option("compression", "zstd").partitionBy(SESSION).parquet(staged)
            for day in new:
                part = f"{staged}/{SESSION}={day:%Y%m%d}"
                files.publish(part, target[day])
        finally:
            files.delete(staged)
    return {str(day): n for day, n in sorted(new.items())}


def union_days(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def flatten(df: DataFrame, column: str, contract: str, data: str) -> DataFrame:
    """Vendor JSON: one record of {contract: {...}, data: [{...}]} a row -> contract fields beside each data row. contract, data: DDL of their fields."""
    kind = f"struct<contract: struct<{contract}>, data: array<struct<{data}>>>"
    rows = df.select(F.from_json(column, kind).alias("r")).select(F.col("r.contract").alias("c"), F.explode("r.data").alias("d"))
    return rows.select("c.*", "d.*")
