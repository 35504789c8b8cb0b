"""Jobs for spark-submit.

    extract SCRIPTS OUT        behaviour scripts -> OUT/lines (table of device lines)
    report LINES OUT           device lines -> OUT/report, OUT/movement, OUT/visits
    running LINES OUT          device lines -> OUT/running (presence counts by area)

LINES is the table that extract wrote (OUT/lines), or text files with --text.

Each takes the files that are there and stops; with --watch it goes on, one
batch a minute.  Files that were taken are remembered under OUT.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from roomtrace.session import get_session
from roomtrace.sources.behaviour import stream_documents
from roomtrace.sources.lines import parse_lines, stream_line_table, stream_lines
from roomtrace.streaming import jobs


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roomtrace", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=["extract", "report", "running"])
    parser.add_argument("source", help="folder (or pattern) of input files")
    parser.add_argument("out", help="output folder")
    parser.add_argument("--text", action="store_true", help="LINES are text files; each is a house")
    parser.add_argument("--watch", action="store_true", help="keep running")
    parser.add_argument("--one-house", action="store_true", help="report: all files of a batch are one house")
    parser.add_argument("--areas", nargs="*", help="running: only these areas")
    parser.add_argument("--run-ts", default=str(dt.datetime.now()), help="report: time shown in the lines")
    parser.add_argument("--max-files", help="files per batch")
    args = parser.parse_args(argv)

    spark = get_session()
    options = {"maxFilesPerTrigger": args.max_files} if args.max_files else {}
    once = not args.watch
    if args.job == "extract":
        query = jobs.extract(stream_documents(spark, args.source, **options), args.out, once)
    else:
        lines = (stream_lines if args.text else stream_line_table)(spark, args.source, **options)
        if args.job == "report":
            house = F.lit("home") if args.one_house else None
            query = jobs.house_report(lines, args.out, args.run_ts, house, once)
        else:
            query = jobs.running_presence(parse_lines(lines), args.out, args.areas, once)
    jobs.finish(query)


if __name__ == "__main__":
    main()
