"""Command line: ``python -m lunchbox --tables DIR --start YYYY-MM-DD --end YYYY-MM-DD --out DIR``.

``--tables`` is a stored model (``sources.tables.write_model``) or, with
``--testdata``, a directory of the driver's tables.  With ``--sheets DIR`` the CSV sheets of
that folder are loaded into ``--tables`` first (``sources.loader``), and rows that can't be loaded are quarantined there.  ``--rules`` is a JSON
file or inline JSON text; without it the plain purchase sheet is written.
"""

from __future__ import annotations

import argparse

from lunchbox.periods import Period
from lunchbox.plans.benefits import generate_purchase, process_benefits
from lunchbox.session import build_session
from lunchbox.sources import sinks
from lunchbox.sources.loader import load_sheets
from lunchbox.sources.tables import read_model
from lunchbox.sources.testdata import load_model


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="lunchbox", description="Monthly meal-voucher purchase")
    ap.add_argument("--tables", required=True)
    ap.add_argument("--testdata", action="store_true", help="--tables holds the driver's tables")
    ap.add_argument("--sheets", help="folder of CSV sheets to load into --tables first")
    ap.add_argument("--start", required=True)
    ap.add_argument("--end", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--rules")
    ap.add_argument("--declared", action="store_true", help="apply every declared agreement rule")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--master", default="local[*]")
    a = ap.parse_args(argv)
    spark = build_session(master=a.master)
    period = Period.parse(a.start, a.end)
    if a.sheets:
        model = load_sheets(spark, a.sheets, a.tables, period)
    else:
        model = load_model(spark, a.tables, period) if a.testdata else read_model(spark, a.tables, period)
    if a.rules:
        process_benefits(model, a.rules, a.out, [period], a.format, a.declared)
    else:
        layout, _ = generate_purchase(model, [period])
        sinks.write_purchase_sheet(layout, a.out, a.format)
    print(a.out)


if __name__ == "__main__":
    main()
