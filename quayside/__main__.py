"""Command line: ``python -m quayside`` or ``spark-submit``, one subcommand per stage."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quayside.operators import marts, quality
from quayside.operators.models import DelayModels
from quayside.operators.whatif import whatif_carrier_switch
from quayside.plans import dashboard, etl, training
from quayside.session import clear_staged
from quayside.sources import files


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = files.read_raw_tables(spark, args.raw, multiline=False if args.one_line else None)
    for report in (quality.table_audit, quality.schema_audit):
        quality.audit_tables(report, raw).show(100, truncate=False)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = etl.run_etl(spark, args.raw, args.processed, multiline=False if args.one_line else None)
    for report in ("audit", "schema_audit"):
        tables[report].show(100, truncate=False)
    quality.shipment_quality_metrics(tables["shipments"]).show()
    etl.post_load_check(tables["v_carrier_kpis"], tables["v_monthly_kpis"]).show()
    marts.carrier_delay_rank(tables["v_carrier_kpis"]).orderBy("perf_rank", "carrier_id").show()
    marts.monthly_delay_rolling_avg(tables["v_monthly_kpis"]).orderBy("departure_month").show()
    if args.database:
        etl.save(tables, args.database)


def show(spark: SparkSession, args: argparse.Namespace) -> None:
    relations = etl.read_tables(spark, args.processed)
    for name, df in dashboard.datasets(relations, args.years, args.regions, args.compare).items():
        print(name)
        df.show(truncate=False)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    master = files.read_parquet_tables(spark, args.processed, ["master"])["master"]
    for name, report in training.run_training(master, args.models).items():
        print(name)
        report.show(truncate=False)


def whatif(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = files.read_parquet_tables(spark, args.processed, ["master", "carriers"])
    trained = DelayModels.load(spark, args.models)
    whatif_carrier_switch(
        tables["master"], tables["carriers"], trained.classifier, trained.codes, args.carrier_from, args.carrier_to,
        args.sample, args.swap,
    ).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="quayside")
    commands = root.add_subparsers(required=True)

    def command(name: str, run, *places: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for place in places:
            sub.add_argument(place)
        return sub

    delivered = [command("audit", audit, "raw"), command("etl", load, "raw", "processed")]
    for sub in delivered:
        sub.add_argument("--one-line", action="store_true", help="no value holds a line break: tasks share a file")
    delivered[1].add_argument("--database", help="also replace the tables of this catalog database")
    command("train", train, "processed", "models")
    shown = command("dashboard", show, "processed")
    shown.add_argument("--years", nargs="*", type=int)
    shown.add_argument("--regions", nargs="*")
    shown.add_argument("--compare", nargs=2, metavar=("FROM", "TO"))
    moved = command("whatif", whatif, "processed", "models", "carrier_from", "carrier_to")
    moved.add_argument("--sample", type=int, default=50)
    moved.add_argument("--swap", choices=["profile", "id"], default="id")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("quayside").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        clear_staged(spark)


if __name__ == "__main__":
    main()
