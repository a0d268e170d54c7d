"""Command line: the jobs the source system ran, as Spark applications.

    python -m tierwise bronze --area comercial --source SRC --bronze BRZ --as-of "2024-03-01 10:00:00" [--sweep]
    python -m tierwise silver --bronze BRZ --silver SLV --as-of ... [--product NAME ...] [--sheet NAME=PATH ...] [--input PRODUCT.NAME=PATH ...]
    python -m tierwise check  --area comercial --source SRC --bronze BRZ [--content]
    python -m tierwise diff   --a PATH_A[@VERSION] --b PATH_B[@VERSION] [--ignore COL] [--where SQL] [--strict]

Sources are read as Parquet exports ``SRC/<TABLE>`` (any other reader, e.g.
JDBC, plugs into :func:`tierwise.operators.ingest.refresh_area`).  Every job
prints its metrics rows; nothing else leaves the cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .operators import reconcile as R
from .operators.ingest import refresh_area, run_summary
from .plans.products import PRODUCT_INPUTS, PRODUCTS, SHEET_PRODUCTS, ProductParams, TableBronze, run_products
from .session import get_session
from .sources.bronze_catalog import bronze_catalog, default_partition_cols
from .sources.scan import normalize_blanks
from .sources.store import VersionedTable


def _session(args):
    return get_session(master=args.master, app=f"tierwise-{args.cmd}", shuffle_partitions=args.shuffle_partitions,
                       profile=args.profile)


def cmd_bronze(args) -> int:
    spark = _session(args)
    cat = bronze_catalog()
    parts = default_partition_cols() if args.partitioned else None
    m = refresh_area(spark, cat, args.area, lambda spec: spark.read.parquet(f"{args.source}/{spec.name}"),
                     args.bronze, args.as_of, sweep=args.sweep, partition_cols=parts, parallelism=args.parallelism,
                     drift=args.drift)
    m.show(200, truncate=False)
    run_summary(m).show(truncate=False)
    return 0 if m.where(F.col("status").startswith("ERROR")).isEmpty() else 1


def cmd_silver(args) -> int:
    spark = _session(args)
    names = args.product or list(PRODUCTS)
    sheets = {}
    for item in args.sheet or []:
        name, path = item.split("=", 1)
        sheets[name] = (spark.read.parquet(path) if path.endswith(".parquet")
                        else spark.read.csv(path, header=True, inferSchema=False))
    inputs: dict = {}
    for item in args.input or []:
        target, path = item.split("=", 1)
        product, name = target.split(".", 1)
        data = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.csv(path, header=True, inferSchema=True)
        # the listed resources are a parameter of the query: a short list of codes
        inputs.setdefault(product, {})[name] = [r[0] for r in data.collect()] if name == "listed_resources" else data
    need_sheet = SHEET_PRODUCTS | {"FAT_UTILIZACAO_META_PRODUCAO"}
    lacking = {n: [x for x in PRODUCT_INPUTS.get(n, ()) if x not in inputs.get(n, {})] for n in names}
    missing = [n for n in names if (n in need_sheet and n not in sheets) or lacking[n]]
    for n in missing:
        print(f"{n}: not built, needs " + ", ".join([f"--sheet {n}=PATH"] * (n in need_sheet and n not in sheets)
                                                   + [f"--input {n}.{x}=PATH" for x in lacking[n]]), file=sys.stderr)
    params = ProductParams(as_of=args.as_of)
    m = run_products(spark, [n for n in names if n not in missing], TableBronze(spark, args.bronze), args.silver,
                     params, sheets=sheets, inputs=inputs, parallelism=args.parallelism, fresh_after=args.fresh_after)
    m.show(100, truncate=False)
    return 0 if not missing and m.where(F.col("status").startswith("ERROR")).isEmpty() else 1


def cmd_check(args) -> int:
    """Row counts in catalog scope, source vs bronze, with the widened-scope
    alert (REC-01/02/04) and a per-status summary (REC-13)."""
    spark = _session(args)
    cat = bronze_catalog()
    checks, differing = None, 0
    for spec in sorted((s for s in cat.specs.values() if s.owner == args.area), key=lambda s: s.name):
        target = VersionedTable(spark, f"{args.bronze}/{spec.name}")
        if not target.exists():
            row = R.skipped(spec.name, spark)
        else:
            source = spark.read.parquet(f"{args.source}/{spec.name}")
            widened = spec.scope(widened=True) if spec.branch_col else None
            row = R.count_check(spec.name, source, target.read(), scope=spec.scope(), widened_scope=widened,
                                multi_writer=spec.name in cat.multi_writer)
            if args.content:
                # REC-05: every real column, load timestamp left out, both
                # directions; the source is normalised like the ingest ('' -> NULL)
                cols = [c for c in source.columns if c in target.read().columns]
                d = R.symmetric_diff(normalize_blanks(source).where(spec.scope()), target.read(), cols)
                differing += _report_diff(spec.name, d, cols)
        checks = row if checks is None else checks.unionByName(row)
    checks.show(200, truncate=False)
    R.summary(checks).show(truncate=False)
    return 0 if checks.where(F.col("status") == R.DIVERGENT).isEmpty() and differing == 0 else 1


def _report_diff(name: str, diff, order) -> int:
    counts = {r["side"]: r["n"] for r in diff.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    print(f"{name}: only_in_a={counts.get(R.SIDE_A, 0)} only_in_b={counts.get(R.SIDE_B, 0)}")
    if counts:
        R.sample(diff, list(order) + ["side"], 10).show(truncate=False)
    return sum(counts.values())


def _table(spark, ref: str):
    """``ROOT@N`` reads pinned version N of a versioned table, ``ROOT`` its
    current version (or plain Parquet), a bare name a catalog table."""
    if "@" in ref:
        root, v = ref.rsplit("@", 1)
        return VersionedTable(spark, root).read(version=int(v))
    if "/" in ref:
        t = VersionedTable(spark, ref)
        return t.read() if t.exists() else spark.read.parquet(ref)
    return spark.table(ref)


def cmd_diff(args) -> int:
    """Two versions of a table (e.g. product vs legacy baseline): common
    columns only (REC-07), optional row filter on both (REC-08), MINUS or
    strict multiset difference (REC-05/06)."""
    spark = _session(args)
    a, b = (_table(spark, x) for x in (args.a, args.b))
    if args.where:
        a, b = a.where(args.where), b.where(args.where)
    common, only_a, only_b = R.column_sets(a, b, ignore=args.ignore or [])
    print(f"columns compared: {len(common)}; only in a: {only_a}; only in b: {only_b}")
    n = _report_diff(args.a, R.symmetric_diff(a, b, common, strict=args.strict), common)
    return 0 if n == 0 else 1


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tierwise")
    p.add_argument("--master", default=None, help="default: spark-submit's; local[*] for a run without it")
    p.add_argument("--profile", choices=["local", "cluster"], default="local")
    p.add_argument("--parallelism", type=int, default=1, help="tables / products run concurrently")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze", help="refresh the bronze tables of one area")
    b.add_argument("--area", required=True)
    b.add_argument("--source", required=True)
    b.add_argument("--bronze", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--sweep", action="store_true", help="scoped orphan sweep (last cycle of the day)")
    b.add_argument("--drift", choices=["fail", "add_nullable", "ignore", "widen", "lossless"], default="fail",
                   help="schema-drift policy when a source gains, loses or changes columns")
    b.add_argument("--partitioned", action="store_true",
                   help="partition new tables by their generation date (merges rewrite touched months only)")
    s = sub.add_parser("silver", help="build and load silver products")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--as-of", required=True)
    s.add_argument("--product", action="append")
    s.add_argument("--sheet", action="append", help="PRODUCT=PATH (CSV with header, or .parquet)")
    s.add_argument("--input", action="append", help="PRODUCT.NAME=PATH, e.g. DIM_REGIONAL.by_region=x.parquet")
    s.add_argument("--fresh-after", help="skip products whose bronze inputs were loaded before this instant")
    c = sub.add_parser("check", help="count checks source vs bronze for one area")
    c.add_argument("--area", required=True)
    c.add_argument("--source", required=True)
    c.add_argument("--bronze", required=True)
    c.add_argument("--content", action="store_true", help="also compare every row (symmetric MINUS)")
    d = sub.add_parser("diff", help="compare two versions of a table on their common columns")
    d.add_argument("--a", required=True)
    d.add_argument("--b", required=True)
    d.add_argument("--ignore", action="append", help="column left out (e.g. the load timestamp)")
    d.add_argument("--where", help="SQL filter applied to both sides (cutoff / stability window)")
    d.add_argument("--strict", action="store_true", help="multiset difference (EXCEPT ALL)")
    args = p.parse_args(argv)
    return {"bronze": cmd_bronze, "silver": cmd_silver, "check": cmd_check, "diff": cmd_diff}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
