"""Command line: list, run or explain the registered reports.

    python -m hirebook list
    python -m hirebook run client_profitability --sf /root/testdata/sf0.01 --show 20
    python -m hirebook run balance_at --sf DIR --out /shared/out/balance --format parquet
    python -m hirebook explain compile_fp --sf DIR

``run --out`` writes the whole result with Spark (nothing is collected);
``--show`` prints only the first rows for a look.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m hirebook")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("--sf", default="/root/testdata/sf0.01", help="folder of the source parquet tables")
        p.add_argument("--master", help="for example local[8]; by default the launcher's")
    run = sub.choices["run"]
    run.add_argument("--show", type=int, default=0, help="print the first N rows")
    run.add_argument("--out", help="write the result here")
    run.add_argument("--format", default="parquet", choices=["parquet", "csv", "orc", "json"])
    args = ap.parse_args(argv)

    from hirebook.plans.catalog import QUERIES
    if args.cmd == "list":
        for name, fn in QUERIES.items():
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:36s}{doc[0] if doc else ''}")
        return 0
    if args.query not in QUERIES:
        print(f"unknown query {args.query!r}; see `python -m hirebook list`", file=sys.stderr)
        return 2
    from hirebook.session import build_session
    spark = build_session(master=args.master)
    df = QUERIES[args.query](spark, args.sf)
    if args.cmd == "explain":
        df.explain("formatted")
        return 0
    if args.out:
        from hirebook.sources.loaders import write_table
        write_table(df, args.out, args.format)
    if args.show or not args.out:
        df.show(args.show or 20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
