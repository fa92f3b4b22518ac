"""Run the whole study from the three CSV files.

    python -m runway --flights F --weather W --planes P --origin JFK --out DIR

(the session comes from the environment's Spark configuration).

Every answer is written to ``DIR/<name>`` (Parquet unless ``--format csv``).
"""

from __future__ import annotations

import argparse

from .plans.study import run_study
from .session import build_session
from .sources import schemas
from .sources.csv import read_csv_checked, read_flights, read_planes, read_weather, write_table


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="runway", description=__doc__.splitlines()[0])
    ap.add_argument("--flights", required=True, help="flights CSV file or folder (with header)")
    ap.add_argument("--weather", required=True, help="weather CSV file or folder (with header)")
    ap.add_argument("--planes", required=True, help="planes CSV file or folder (with header)")
    ap.add_argument("--origin", required=True, help="airport of the delayed-share question")
    ap.add_argument("--out", required=True, help="folder for the answers, one sub-folder each")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    ap.add_argument("--k", type=int, default=5, help="top routes to break down by carrier")
    ap.add_argument("--shift-seconds", type=int, default=1,
                    help="actual clocks moved back: 1 (pandas notebook) or 60 (Spark notebook)")
    ap.add_argument("--rank-year", type=int, help="rank the routes by this year's trips, count all")
    ap.add_argument("--null-value", default="NA")
    ap.add_argument("--rejects", help="folder for cells that do not parse, one sub-folder per table; "
                                      "their rows are left out (without this they keep a null)")
    a = ap.parse_args(argv)
    spark = build_session(app="runway-study")
    if a.rejects:
        tables = []
        for name, path, schema in (("flights", a.flights, schemas.FLIGHTS), ("weather", a.weather, schemas.WEATHER),
                                   ("planes", a.planes, schemas.PLANES)):
            rows, rejects = read_csv_checked(spark, path, schema, a.null_value)
            write_table(rejects, f"{a.rejects}/{name}", a.format)
            tables.append(rows)
    else:
        tables = [read_flights(spark, a.flights, a.null_value), read_weather(spark, a.weather, a.null_value),
                  read_planes(spark, a.planes, a.null_value)]
    run_study(*tables, origin=a.origin, k=a.k, shift_seconds=a.shift_seconds,
              out_dir=a.out, out_format=a.format, rank_year=a.rank_year)


if __name__ == "__main__":
    main()
