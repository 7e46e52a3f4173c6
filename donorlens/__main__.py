"""Run the reports end to end: load the four tables, build every report, write each one.

    python -m donorlens --csv-dir DIR --out DIR [--format csv|parquet]
    python -m donorlens --parquet-dir DIR --jdbc-url URL --jdbc-user U --jdbc-password P
    python -m donorlens --jdbc-source --jdbc-url URL ... --cycle-bounds 1990 2020 --out DIR

Reports: by_cycle, by_cycle_by_party, top_candidates_by_cycle,
top_committees_by_cycle, by_sector_by_cycle, by_sector_by_party_by_cycle. With files as the source,
``load_report`` goes with them: row counts and rejected values per table.
"""

from __future__ import annotations

import argparse
import os
import uuid

from donorlens.plans import reports, shared
from donorlens.session import build_session, scratch_path
from donorlens.sinks.writers import run_reports, write_files, write_jdbc
from donorlens.sources import load


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="donorlens", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv-dir", help="directory of <table>.csv extracts")
    src.add_argument("--parquet-dir", help="directory of <table>.parquet tables")
    src.add_argument("--jdbc-source", action="store_true", help="read the tables from --jdbc-url")
    p.add_argument("--jdbc-url", help="database to read from (--jdbc-source) and/or write reports to")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--cycle-bounds", nargs=2, type=int, help="first and last cycle, for sliced JDBC reads")
    p.add_argument("--out", help="output directory for flat files")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--mode", default="spec", choices=["spec", "as_coded"],
                   help="as_coded applies to by_cycle and by_cycle_by_party")
    p.add_argument("--reports", nargs="*", default=None, help="subset of report names")
    p.add_argument("--sample", type=int, default=None, help="use only the first N contributions")
    p.add_argument("--partitions", type=int, default=None, help="spark.sql.shuffle.partitions")
    p.add_argument("--strict", action="store_true", help="fail on malformed numbers or dates")
    p.add_argument("--master", default=None, help="Spark master (default: the environment's)")
    return p.parse_args(argv)


def main(argv=None, spark=None):
    args = parse_args(argv)
    if not args.out and not args.jdbc_url:
        raise SystemExit("give --out and/or --jdbc-url")
    spark = spark or build_session(args.master, shuffle_partitions=args.partitions)
    props = {k: v for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password)) if v}
    loaded = None
    if args.csv_dir or args.parquet_dir:
        # typed and stored once; the same pass counts what the load rejected
        raw = load.raw_csv_dir(spark, args.csv_dir) if args.csv_dir else load.raw_parquet_dir(spark, args.parquet_dir)
        loaded = load.store_loaded(raw, scratch_path(spark, f"loaded-{uuid.uuid4().hex}"), strict=args.strict)
        tables = loaded.tables
    else:
        from donorlens.sources.jdbc import read_jdbc_tables
        if not args.jdbc_url:
            raise SystemExit("--jdbc-source needs --jdbc-url")
        tables = read_jdbc_tables(spark, args.jdbc_url, props, strict=args.strict,
                                  cycle_bounds=tuple(args.cycle_bounds) if args.cycle_bounds else None)
    tables = tables.sample(args.sample)
    names = args.reports or list(reports.REPORTS)
    if len(names) > 1 and args.mode == "spec":
        common = shared.all_reports(shared.store(shared.fold(tables)))
        chosen = [(name, common[name]) for name in names]
    else:
        if len(names) > 1 and (loaded is None or args.sample is not None):
            tables = reports.materialise(tables)
        chosen = reports.generate_reports(tables, names, mode=args.mode)

    def sink(report, name, keys):
        if args.out:
            write_files(report, os.path.join(args.out, name), fmt=args.format, keys=keys, stored=True)
        if args.jdbc_url:
            write_jdbc(report, args.jdbc_url, name, props, keys=keys, stored=True)

    written = run_reports(chosen, sink, keys=reports.REPORT_KEYS)
    if loaded is not None:
        run_reports([("load_report", load.load_report(spark, loaded.counts))], sink, keys={"load_report": ["table_name", "metric"]})
    return written


if __name__ == "__main__":
    main()
