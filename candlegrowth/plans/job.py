"""Batch job for spark-submit.

    spark-submit candlegrowth/plans/job.py --folder_path s --output o [--algorithm_type o-c] \
        [--delimiter ';'] [--rules pairs] [--mode initial|full|incremental]

`initial` creates the tables and loads every file there is; `full` empties the tables first;
`incremental` loads the files that came since the last run.
"""

import argparse

from candlegrowth import schema
from candlegrowth.operators.growth import RULES
from candlegrowth.session import build_session
from candlegrowth.sinks import files as sinks
from candlegrowth.streaming.incremental import IncrementalLoad


def parser():
    args = argparse.ArgumentParser(prog="candlegrowth", description=__doc__.splitlines()[0])
    args.add_argument("-fl", "--folder_path", required=True, help="folder with candle files")
    args.add_argument("-o", "--output", required=True, help="folder for tables and reports")
    args.add_argument("-dl", "--delimiter", default=schema.DELIMITER)
    args.add_argument("-at", "--algorithm_type", choices=("o-c", "c-c", "both"), default="o-c")
    args.add_argument("--rules", choices=sorted(RULES), default="pairs")
    args.add_argument("--mode", choices=("initial", "full", "incremental"), default="initial")
    args.add_argument("--glob", default=schema.BID_GLOB, help="file names to read")
    args.add_argument("--layout", choices=("file_name", "folders", "partitions"), default="file_name")
    args.add_argument("--max_files", type=int, help="files in one load")
    args.add_argument("--csv", help="folder for the reports as delimited text")
    return args


def run(spark, options):
    """Run one load and return the tables it maintains."""
    kinds = ("o-c", "c-c") if options.algorithm_type == "both" else (options.algorithm_type,)
    load = IncrementalLoad(spark, options.output, options.rules, kinds)
    if options.mode != "incremental":
        load.initialise(replace=options.mode == "full")
    load.run(
        options.folder_path, options.delimiter, options.glob, options.layout, options.max_files
    )
    if options.csv:
        sinks.write_report_csv(
            load.report().drop("stock_bucket"), f"{options.csv}/years", options.delimiter
        )
        sinks.write_report_csv(
            load.averages().drop("stock_bucket"), f"{options.csv}/averages", options.delimiter
        )
    return load


def main(arguments=None):
    options = parser().parse_args(arguments)
    spark = build_session()
    run(spark, options).report().orderBy("stock_name", "current_year").show()


if __name__ == "__main__":
    main()
