"""Command line: ``python -m tradewind RAW_FOLDER OUT_FOLDER [entity=file ...]``."""

from __future__ import annotations

import sys

from tradewind.operators.reconcile import render_markdown
from tradewind.plans.pipeline import run
from tradewind.plans.warehouse import ChecksFailed
from tradewind.session import build_session
from tradewind.sources.schemas import RAW_COLUMNS


def main(arguments: list[str]) -> int:
    if len(arguments) < 2:
        print(__doc__, file=sys.stderr)
        return 2
    folder, out, *renamed = arguments
    names = {e: f"{e}.csv" for e in RAW_COLUMNS} | dict(item.split("=", 1) for item in renamed)
    spark = build_session()
    try:
        wh = run(spark, folder, out, names)
    except ChecksFailed as stopped:
        print(stopped, file=sys.stderr)
        return 1
    print(render_markdown(spark.read.parquet(f"{wh.root}/reports/reconciliation")))
    print("all checks passed")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
