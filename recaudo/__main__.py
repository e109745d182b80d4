"""Command line for the pipelines (what the reference runs as scripts).

    python -m recaudo assignment   --bases DIR --discounts DIR --out DIR
    python -m recaudo contacts     --input FILE --month 3 --year 2025 --out DIR
    python -m recaudo touches      --input DIR --month 3 --year 2025 --out DIR
    python -m recaudo folder-merge --input DIR --month 6 --year 2024 --out DIR
    python -m recaudo monthly      --input DIR --start 2024-09 --end 2025-03 --patterns FILE --out DIR

Inputs are ';' separated text with a header unless stated; outputs are ';'
CSV folders (partitioned by month where there is one), without success
markers. The session comes from the environment (spark-submit settings);
``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .session import get_session
from .sources import delimited


def _ym(text: str) -> tuple[int, int]:
    y, m = text.split("-")
    return int(y), int(m)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="recaudo")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("assignment")
    a.add_argument("--bases", required=True)
    a.add_argument("--discounts", required=True)
    a.add_argument("--out", required=True)
    c = sub.add_parser("contacts")
    c.add_argument("--input", required=True)
    c.add_argument("--month", type=int, required=True)
    c.add_argument("--year", type=int, required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--by-slot-code", action="store_true", help="files in the order of the slot code: mobiles first, then landlines")
    t = sub.add_parser("touches")
    t.add_argument("--input", required=True)
    t.add_argument("--month", type=int, required=True)
    t.add_argument("--year", type=int, required=True)
    t.add_argument("--out", required=True)
    f = sub.add_parser("folder-merge")
    f.add_argument("--input", required=True)
    f.add_argument("--month", type=int, required=True)
    f.add_argument("--year", type=int, required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--skip-unreadable", action="store_true", help="leave out and report files that can't be read")
    m = sub.add_parser("monthly")
    m.add_argument("--input", required=True)
    m.add_argument("--start", required=True, help="yyyy-mm")
    m.add_argument("--end", required=True, help="yyyy-mm")
    m.add_argument("--patterns", required=True, help="CSV ord;pattern;department;grp")
    m.add_argument("--out", required=True)
    m.add_argument("--changed-only", action="store_true", help="only months whose files changed since they were written; others keep their folders")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    if args.cmd == "assignment":
        from .plans.assignment import assignment_base
        raw = delimited.read_by_header(spark, args.bases)
        disc = delimited.read_by_header(spark, args.discounts, ["CUENTA", "PORCENTAJE"])
        out = assignment_base(raw, disc)
        delimited.write_delimited(out.withColumn("mes", F.concat_ws("-", "PERIODO DE ASIGNACION",
                                                                    F.lpad("MES DE ASIGNACION", 2, "0"))),
                                  args.out, partition_by=["mes"])
    elif args.cmd == "contacts":
        from .plans.contact_plan import contact_table, write_contact_table
        raw = delimited.read_by_header(spark, args.input, ["identificacion", "cuenta", "dato"])
        (write_contact_table if args.by_slot_code else delimited.write_delimited)(contact_table(raw, args.month, args.year), args.out)
    elif args.cmd == "touches":
        from .plans.touch_plan import read_channels, touch_table
        delimited.write_delimited(touch_table(read_channels(spark, args.input), args.month, args.year), args.out)
    elif args.cmd == "folder-merge":
        from .plans.folder_merge import merge_export_folder
        scan = merge_export_folder(spark, args.input, args.month, args.year, skip_unreadable=args.skip_unreadable)
        for p in scan.unreadable:
            print(f"skipped (can't be read): {p}", file=sys.stderr)
        for p in scan.skipped:
            print(f"skipped (no ',' or ';' in the header): {p}", file=sys.stderr)
        if scan.df is not None:
            delimited.write_delimited(scan.df, args.out)
    elif args.cmd == "monthly":
        from .operators import geo
        from .plans import monthly
        months = monthly.month_range(_ym(args.start), _ym(args.end))
        pats = geo.read_pattern_table(spark, args.patterns)
        if args.changed_only:
            for month, rows in monthly.rerun_months(spark, args.input, args.out, months, pats).items():
                print(f"{month}: {rows} rows" if rows else f"{month}: no rows, left as it was", file=sys.stderr)
            return 0
        src = monthly.read_months(spark, args.input, months)
        for p in src.missing:
            print(f"missing monthly file: {p}", file=sys.stderr)
        monthly.write_monthly(monthly.monthly_consolidation(src, pats), args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
