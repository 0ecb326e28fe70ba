"""``python -m ledgerlane CSV_FOLDER ROOT``: run the flow once and say where its results lie."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ledgerlane.plans.daily import Run, run


def write_reports(done: Run, root: str) -> dict[str, str]:
    """Every report in full, as Parquet under ``<root>/reports/<key>``; key to folder."""
    places = {}
    for key, report in done.reports().items():
        places[key] = f"{root.rstrip('/')}/reports/{key}"
        report.write.mode("overwrite").parquet(places[key])
    return places


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlane")
    parser.add_argument("folder", help="folder of the CSV files")
    parser.add_argument("root", help="folder of the layers, reachable by all executors")
    parser.add_argument("--no-gate", action="store_true", help="report even if checks fail")
    parser.add_argument("--keep-bad-rows", action="store_true", help="set rows that do not fit aside")
    parser.add_argument("--most-bad", type=float, default=1.0, help="share of rows a file may have set aside")
    parser.add_argument("--multi-line", action="store_true", help="allow line breaks inside fields")
    parser.add_argument(
        "--expected", help='JSON file: {"bounds": {name: [low, high]}, "accepted": {table: {column: [values]}}}'
    )
    given = parser.parse_args(arguments)
    expected = {}
    if given.expected:
        with open(given.expected, encoding="utf-8") as file:
            expected = json.load(file)
    bounds = {name: tuple(pair) for name, pair in expected["bounds"].items()} if "bounds" in expected else None
    spark = SparkSession.builder.appName("ledgerlane").getOrCreate()
    done = run(
        spark, given.folder, given.root, datetime.now(timezone.utc), gate=not given.no_gate, bounds=bounds,
        accepted=expected.get("accepted"), keep_bad_rows=given.keep_bad_rows, multi_line=given.multi_line,
        most_bad=given.most_bad,
    )
    for row in done.loads.collect():  # one row per raw table
        print(f"{row.table}: {row.rows} rows, {row.bad_rows} set aside, {row.status}")
    failed = 0
    for row in done.smoke.collect():  # one row per check
        failed += not row.ok
        print(f"{'ok' if row.ok else 'FAILED'} {row.name}: {row.value}")
    for key, place in write_reports(done, given.root).items():
        print(f"{key}: {place}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
