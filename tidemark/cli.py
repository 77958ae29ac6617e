"""Command line: python -m tidemark.cli COMMAND."""

from __future__ import annotations

import argparse
import sys
import tempfile

from pyspark.sql import functions as F

from tidemark.plans import quality, synthetic
from tidemark.plans.loader import Loader, PointInTimeLoader, store_regime
from tidemark.session import session
from tidemark.sources.catalog import DEFAULT
from tidemark.sources.scan import as_date
from tidemark.sources.store import Store, write_sessions


def _datasets(args) -> int:
    for name in sorted(DEFAULT.names(), key=lambda n: DEFAULT.get(n).rows_per_day):
        d = DEFAULT.get(name)
        print(f"{name:14} {d.granularity:6} {d.rows_per_day or '-':>8}  {', '.join(r.name for r in d.rules)}")
    return 0


def _migrate(args) -> int:
    store = Store(session(), args.raw, args.top, DEFAULT)
    errors = 0
    for name in sorted(args.dataset or DEFAULT.names(), key=lambda n: DEFAULT.get(n).rows_per_day):
        stats = store.ingest(name, [as_date(x) for x in args.date] or None, args.delete_source)
        errors += stats["errors"]
        print(name, stats)
    return int(bool(errors))


def _validate(args) -> int:
    spark = session()
    store = Store(spark, args.raw, args.top, DEFAULT)
    checks = []
    for n in args.dataset or DEFAULT.names():
        d, files = DEFAULT.get(n), store.stored_files(n)
        if not (d.single_file or d.bulk):
            checks.append(quality.check_migration(spark, n, store.dates(n), store.available(n), files))
        checks.append(quality.check_store(spark, n, files, set(d.schema.names) - set(d.drop)))
    rows = quality.report(checks)
    rows.show(100, False)
    got = quality.summary(rows).first()
    print(got["verdict"])
    if args.json:
        rows.coalesce(1).write.mode("overwrite").json(args.json)
    return int(got["fail"] > 0)


def _regime(args) -> int:
    print(store_regime(Loader(session(), args.top)), "sessions")
    return 0


def _split(args) -> int:
    print(write_sessions(session().read.parquet(args.source), args.target, args.dry_run))
    return 0


def _demo(args) -> int:
    """Make a feed, ingest it, load it raw and cleaned, and check two things that must hold."""
    spark = session()
    top = args.top or tempfile.mkdtemp(prefix="tidemark-demo-")
    n = synthetic.write_feed(spark, f"{top}/raw")
    store = Store(spark, f"{top}/raw", top, DEFAULT)
    for name in ("spx_ohlc", "vix_ohlc", "vvix_ohlc", "greeks_0dte"):
        print(name, store.ingest(name))
    loader = Loader(spark, top)
    days = loader.available_dates("greeks_0dte")
    raw, clean = loader.load("greeks_0dte", (days[0], days[-1]), clean=False), loader.load("greeks_0dte", (days[0], days[-1]))
    bars = PointInTimeLoader(loader, days[1]).load_aligned((days[0], days[-1]), datasets=("spx_ohlc", "vix_ohlc"))
    latest = bars.agg(F.max(F.to_date("timestamp"))).first()[0]
    fine = clean.where("underlying_price <= 0 or year(to_date(expiration)) < 2000").isEmpty() and latest <= days[1]
    print(f"{n} sessions, {raw.count()} rows raw, {clean.count()} clean; checks {'hold' if fine else 'FAIL'}")
    return int(not fine)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("datasets").set_defaults(run=_datasets)
    for name, run in (("migrate", _migrate), ("validate", _validate)):
        c = sub.add_parser(name)
        c.add_argument("raw")
        c.add_argument("top")
        c.add_argument("--dataset", action="append")
        c.set_defaults(run=run)
        if name == "migrate":
            c.add_argument("--date", action="append", default=[])
            c.add_argument("--delete-source", action="store_true")
        else:
            c.add_argument("--json")
    c = sub.add_parser("regime")
    c.add_argument("top")
    c.set_defaults(run=_regime)
    c = sub.add_parser("split")
    c.add_argument("source")
    c.add_argument("target")
    c.add_argument("--dry-run", action="store_true")
    c.set_defaults(run=_split)
    c = sub.add_parser("demo")
    c.add_argument("--top")
    c.set_defaults(run=_demo)
    args = p.parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
