"""Command line: load a CSV folder, then write every report.

    python -m tillsight load   --input data/raw --dest /shared/raw
    python -m tillsight report --dest /shared/raw --out /shared/reports

``load`` infers the schema from all rows, validates, loads and reconciles the
CSV files and publishes the run only when every table is ``ok``; ``report``
reads the published tables and writes each report as Parquet.
"""

from __future__ import annotations

import argparse
import sys

from tillsight.plans.retail import RAW_TABLES, reports
from tillsight.session import get_session
from tillsight.sources.csv_files import list_csv
from tillsight.sources.load import load_run
from tillsight.sources.snapshots import open_snapshot


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillsight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="infer, load and reconcile a folder of CSV files")
    ld.add_argument("--input", required=True)
    ld.add_argument("--dest", required=True)
    rp = sub.add_parser("report", help="write every report of the published tables")
    rp.add_argument("--dest", required=True)
    rp.add_argument("--out", required=True)
    rp.add_argument("--forecast-product")
    rp.add_argument("--recommend-product")
    rp.add_argument("--as-of")
    rp.add_argument("--window", type=int, help="months of the moving average")
    rp.add_argument("--train-end", help="last training month, yyyy-mm")
    rp.add_argument("--test-months", nargs="+", help="months to forecast, yyyy-mm")
    rp.add_argument("--top", type=int, help="length of the similar-products list")
    args = ap.parse_args(argv)

    spark = get_session()
    if args.cmd == "load":
        report, run = load_run(spark, list_csv(spark, args.input), args.dest, raise_on_divergence=True)
        report.show(100, truncate=False)
        print(f"published {run}")
        return 0
    held = open_snapshot(spark, args.dest)  # all tables of one version
    raw = {t: held.table(t) for t in RAW_TABLES}
    kwargs = {"as_of": args.as_of}
    if args.forecast_product:
        kwargs["forecast_product"] = args.forecast_product
    if args.recommend_product:
        kwargs["recommend_product"] = args.recommend_product
    for key in ("window", "train_end", "test_months", "top"):
        if getattr(args, key) is not None:
            kwargs[key] = getattr(args, key)
    for name, df in reports(raw, **kwargs).items():
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        print(f"wrote {name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
