"""Command line for spark-submit or ``python -m sievework``. Results and whole reports go to
storage; ``--show`` rows of each report are printed as well."""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievework.plans import modelling, prepare
from sievework.sources import scratch_dir, write_csv
from sievework.specs import booking_spec


def report(args, folder: str, reports: dict) -> None:
    """Every report as CSV files under ``folder``, with all its rows, and a preview of each."""
    for name, df in reports.items():
        path = f"{folder.rstrip('/')}/{re.sub('[^A-Za-z0-9/]+', '_', name)}"
        rows = write_csv(df, path, single_file=True)
        print(f"\n{name}: {rows} rows in {path}")
        if args.show:
            df.show(args.show, truncate=False)


def prepare_file(spark, args):
    done = prepare.prepare_file(spark, args.csv, booking_spec(args.key), args.out)
    report(args, f"{args.out}/reports", done.reports)
    print(done.counts)


def prepare_table(spark, args):
    work = args.work or scratch_dir(spark)
    done = prepare.prepare_catalog(spark, args.table, booking_spec(args.key), args.database, work)
    report(args, args.out, done.reports)


def train_table(spark, args):
    spec = booking_spec(args.key)
    chosen = modelling.compare_models(
        spark.table(f"{args.database}.train_normalized"),
        spark.table(f"{args.database}.test_normalized"),
        spec,
        partitions=args.partitions,
        model_path=args.model,
    )
    tables = {"comparison": chosen.comparison} | modelling.result_tables(spark, chosen)
    report(args, args.out, tables | {f"models/{n}": df for n, df in chosen.reports.items()})
    print(f"best model: {chosen.best.name}, saved to {args.model}")


def train_file(spark, args):
    work = args.work or scratch_dir(spark)
    chosen = modelling.train_two_from_csv(spark, args.csv, booking_spec(args.key), work, args.model)
    report(args, args.out, {"comparison": chosen.comparison} | modelling.result_tables(spark, chosen))
    print(f"best model: {chosen.best.name}, saved to {args.model}")


def describe(spark, args):
    # Categories of a split are an array, which CSV has no place for.
    contents = modelling.describe_saved_model(spark, args.model)
    if "left_categories" in contents.columns:
        contents = contents.withColumn("left_categories", F.col("left_categories").cast("string"))
    report(args, args.out, {"contents": contents})


def main() -> None:
    parser = argparse.ArgumentParser(prog="sievework", description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(fn, key, **arguments):
        p = commands.add_parser(fn.__name__.replace("_", "-"))
        for name, required in arguments.items():
            p.add_argument(f"--{name}", required=required)
        if key:
            p.add_argument("--key", default=key)
        p.add_argument("--show", type=int, default=20, help="rows of each report to print as well")
        p.set_defaults(run=fn)
        return p

    command(prepare_file, "Booking_ID", csv=True, out=True)
    command(prepare_table, "booking_id", table=True, database=True, out=True, work=False)
    p = command(train_table, "booking_id", database=True, model=True, out=True)
    p.add_argument("--partitions", type=int)
    command(train_file, "Booking_ID", csv=True, model=True, out=True, work=False)
    command(describe, None, model=True, out=True)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("sievework").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
