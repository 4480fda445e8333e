"""Commands: profile, discover, ops.

    python -m tidemill.cli profile PACKAGE TABLE [--files N] [--rows N] [--skim] ...
    python -m tidemill.cli discover ROOT [--option KEY=VALUE] [--option-env KEY=ENV] [--maxdepth N]
    python -m tidemill.cli ops PACKAGE reload TABLE START [END] | ignore ID... | reclassify TABLE
"""

from __future__ import annotations

import argparse
import os
from dataclasses import replace
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import Dataset, coerce_option, discover_datasets
from .operators import discover, mirror
from .operators import manifest as m
from .operators.profile import report, typing
from .plans.engine import Engine
from .schema import write_schema

#: A quick look: so many files and rows a file (fixed values).
SKIM_FILES, SKIM_ROWS = 5, 200_000


def engine_of(spark: SparkSession, dataset: Dataset) -> Engine:
    """Folders come from LANDING_ROOT, TARGET_ROOT and MANIFEST_ROOT."""
    return Engine(spark, dataset, *[os.environ.get(f"{x}_ROOT", x.lower()) for x in ("LANDING", "TARGET", "MANIFEST")])


def find(package: str, table: str) -> Dataset:
    for d in discover_datasets(package):
        if any(table in (t.name, t.key) for t in d.tables):
            return d
    raise SystemExit(f"no dataset of {package} has a table {table}")


def newest(files, table: str, most: int | None):
    """The newest files of a table, in their order."""
    rows = files.where(m.active(table)).orderBy(F.col("business_date").desc(), F.col("id").desc())
    return sorted((rows.limit(most) if most else rows).collect(), key=lambda r: (r["business_date"], r["id"]))


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    dataset = find(args.package, args.table)
    engine = engine_of(spark, dataset)
    table = engine.table(args.table)
    options = typing.Options(max_rows=args.rows, decimals=args.decimals, narrow=args.narrow, strict_nulls=args.strict_nulls, text_headroom=args.text_headroom, date_formats=tuple(args.date_format))
    most = args.files
    if args.skim:
        most, options = most or SKIM_FILES, replace(options, max_rows=options.max_rows or SKIM_ROWS)
    files = newest(engine.store.read(), table.key, most)
    if not files:
        raise SystemExit(f"{table.key} has no active files")
    result, schema = report.profile(spark, dataset, table, files, options)
    print(report.summary(result))
    print(f"schema: {write_schema(dataset, schema)}")
    if not args.no_report:
        print(f"report: {report.write_report(result, dataset, table)}")


def options_of(args: argparse.Namespace) -> dict:
    out = {k: coerce_option(v) for k, v in (o.split("=", 1) for o in args.option)}
    return out | {k: coerce_option(os.environ[v]) for k, v in (o.split("=", 1) for o in args.option_env)}


def look(spark: SparkSession, args: argparse.Namespace) -> None:
    for k, v in options_of(args).items():
        spark._jsc.hadoopConfiguration().set(k, str(v))
    print(discover.to_json(discover.analyze(mirror.inventory(spark, args.root, args.maxdepth), root_of(spark, args.root))))


def root_of(spark: SparkSession, root: str) -> str:
    """A root in the form in which listings name it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def ops(spark: SparkSession, args: argparse.Namespace) -> None:
    datasets = discover_datasets(args.package)
    for d in [find(args.package, args.table)] if args.action != "ignore" else datasets:
        store = engine_of(spark, d).store
        files = store.read()
        if args.action == "reload":
            changed, n = m.reload(files, args.table, args.start, args.end)
        elif args.action == "reclassify":
            changed, n = m.reclassify(files, args.table)
        else:
            changed, n = m.ignore(files, args.ids), len(args.ids)
        store.write(changed)
        print(f"{args.action}: {n} file(s) of {d.name}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("profile")
    p.add_argument("package")
    p.add_argument("table")
    p.add_argument("--files", type=int)
    p.add_argument("--rows", type=int)
    for flag in ("--skim", "--decimals", "--narrow", "--strict-nulls", "--no-report"):
        p.add_argument(flag, action="store_true")
    p.add_argument("--text-headroom", type=float, default=1.5)
    p.add_argument("--date-format", action="append", default=[])
    p.set_defaults(run=profile)
    d = sub.add_parser("discover")
    d.add_argument("root")
    d.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    d.add_argument("--option-env", action="append", default=[], metavar="KEY=ENV")
    d.add_argument("--maxdepth", type=int)
    d.set_defaults(run=look)
    o = sub.add_parser("ops")
    o.add_argument("package")
    actions = o.add_subparsers(dest="action", required=True)
    r = actions.add_parser("reload")
    r.add_argument("table")
    r.add_argument("start", type=date.fromisoformat)
    r.add_argument("end", type=date.fromisoformat, nargs="?")
    i = actions.add_parser("ignore")
    i.add_argument("ids", type=int, nargs="+")
    c = actions.add_parser("reclassify")
    c.add_argument("table")
    o.set_defaults(run=ops)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    from .session import local_session

    args = parser().parse_args(argv)
    args.run(spark or local_session("tidemill"), args)


if __name__ == "__main__":
    main()
