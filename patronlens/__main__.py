"""Command line: ``python -m patronlens run|train|<stage> --root FOLDER``."""

from __future__ import annotations

import argparse
import logging

from patronlens.config import ClassifierConfig, JdbcSource, RunConfig, SyntheticSource
from patronlens.plans import runs
from patronlens.session import build_session


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="patronlens", description=__doc__)
    parser.add_argument("command", choices=["run", "train", *runs.STAGES])
    parser.add_argument("--root", required=True, help="folder of the run's tables, reachable by all executors")
    parser.add_argument("--snapshot", default=RunConfig.snapshot)
    parser.add_argument("--churn-window-days", type=int, default=RunConfig.churn_window_days)
    parser.add_argument("--horizon-months", type=int, default=RunConfig.horizon_months)
    parser.add_argument("--min-customers", type=int, default=RunConfig.min_customers)
    parser.add_argument("--trees", type=int, default=ClassifierConfig.trees)
    parser.add_argument("--master", help="Spark master; left out where spark-submit sets it")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--orders", help="Parquet folder with the orders")
    source.add_argument("--jdbc", help="JDBC address of a database with an orders table")
    parser.add_argument("--jdbc-table", default=JdbcSource.table, help="table, or a query in parentheses with a name")
    parser.add_argument("--jdbc-column", default=JdbcSource.partition_column, help="column that splits the read")
    parser.add_argument("--jdbc-lower", help="least value of that column (asked of the database if left out)")
    parser.add_argument("--jdbc-upper", help="greatest value of that column")
    parser.add_argument("--jdbc-parts", type=int, default=JdbcSource.num_partitions)
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="such as user=reader")
    parser.add_argument("--fit-part", choices=runs.FIT_PARTS, default=runs.FIT_PARTS[0], help="rows the classifier learns from")
    parser.add_argument("--orders-at-midnight", action="store_true", help="order dates have no time of day")
    source.add_argument("--generate", type=int, help="number of orders to generate (the default source)")
    return parser.parse_args(given)


def jdbc_source(args: argparse.Namespace) -> JdbcSource:
    """The database named on the command line."""
    pairs = [tuple(p.split("=", 1)) for p in args.jdbc_property]
    if any(len(p) != 2 for p in pairs):
        raise SystemExit("--jdbc-property takes NAME=VALUE")
    return JdbcSource(
        args.jdbc,
        table=args.jdbc_table,
        partition_column=args.jdbc_column,
        lower_bound=args.jdbc_lower,
        upper_bound=args.jdbc_upper,
        num_partitions=args.jdbc_parts,
        properties=tuple(pairs),
    )


def main() -> None:
    logging.basicConfig(format="%(message)s")
    logging.getLogger("patronlens").setLevel(logging.INFO)
    args = arguments()
    source = args.orders
    if args.jdbc:
        source = jdbc_source(args)
    elif args.generate:
        source = SyntheticSource(orders=args.generate)
    cfg = RunConfig(
        snapshot=args.snapshot,
        churn_window_days=args.churn_window_days,
        horizon_months=args.horizon_months,
        min_customers=args.min_customers,
        orders_at_midnight=args.orders_at_midnight,
    )
    spark = build_session(args.master)
    run = runs.Run(spark, args.root, source, cfg, ClassifierConfig(trees=args.trees), fit_part=args.fit_part)
    commands = {"run": runs.run_all, "train": runs.train}
    result = commands[args.command](run) if args.command in commands else runs.perform(run, [args.command])
    if result is not None:
        result.show(5)
    spark.stop()


if __name__ == "__main__":
    main()
