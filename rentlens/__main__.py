"""Command line: ``python -m rentlens <command> --help``."""

import argparse

from pyspark.sql import DataFrame

from .ml import features, models
from .plans import ingestion, market, scaling, workloads
from .session import get_spark
from .sources import run_logs, tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rentlens", description=__doc__)
    top.add_argument("--root", required=True, help="folder that holds raw, interim, processed, results and models")
    top.add_argument("--master", help="Spark master, if not set by spark-submit")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("ingest", "clean"):
        command = commands.add_parser(name)
        command.add_argument("--cities", nargs="+", default=list(ingestion.CITY_FOLDERS))
    ask = commands.add_parser("ask")
    ask.add_argument("questions", nargs="*", help="q01 to q11, all if none is named")
    ask.add_argument("--csv", action="store_true", help="also store each answer as a single CSV file")
    train = commands.add_parser("train")
    train.add_argument("target", choices=["price", "occupancy", "monthly"])
    train.add_argument("--algo", default="all")
    train.add_argument("--sample", type=int, help="percentage of the listings to train on")
    importance = commands.add_parser("importance")
    importance.add_argument("model", nargs="+", help="folders below models, such as price_gbt")
    score = commands.add_parser("score")
    score.add_argument("model", help="folder below models")
    workload = commands.add_parser("workload")
    workload.add_argument("name", choices=list(workloads.WORKLOADS))
    logs = commands.add_parser("scaling")
    logs.add_argument("logs", help="folder of run logs")
    return top


def train_models(args, data: market.Market) -> None:
    folder = f"{args.root}/models"
    catalog = {"price": models.PRICE_MODELS, "occupancy": models.DEMAND_MODELS, "monthly": {"rf": None}}[args.target]
    for algo in catalog if args.algo == "all" else [args.algo]:
        if args.target == "price":
            trained = models.train_price(data.listings, algo, sample=args.sample)
        elif args.target == "occupancy":
            trained = models.train_occupancy(data.listings, algo, sample=args.sample)
        else:
            months = features.monthly_demand(data.calendar, data.listings)
            trained = models.train_monthly_occupancy(months, sample=args.sample)
        trained.save(f"{folder}/{args.target}_{algo}")
        trained.metrics.show(truncate=False)


def scoring_input(name: str, data: market.Market) -> tuple[DataFrame, tuple, tuple, tuple]:
    """Rows, left-out and additional columns and row names that suit a trained model."""
    if name.startswith("price"):
        return data.listings, (), (), ("id",)
    if name.startswith("occupancy"):
        return data.listings, features.AVAILABILITY_LEAKS, (), ("id",)
    months = features.monthly_demand(data.calendar, data.listings)
    return months, features.AVAILABILITY_LEAKS, features.TEMPORAL, ("id", "year", "month")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_spark(f"rentlens-{args.command}", args.master)
    raw, interim, processed = (f"{args.root}/{zone}" for zone in ("raw", "interim", "processed"))
    if args.command in ("ingest", "clean"):
        cities = {c: ingestion.CITY_FOLDERS[c] for c in args.cities}
        if args.command == "ingest":
            ingestion.ingest(spark, raw, interim, cities)
        else:
            ingestion.clean(spark, interim, processed, raw, cities)
        return
    if args.command == "scaling":
        summary = scaling.scaling_summary(run_logs.read_run_logs(spark, args.logs))
        tables.export_report(summary, f"{args.root}/results/scaling", single_csv=True).show()
        return
    data = market.Market.load(spark, processed)
    if args.command == "ask":
        market.answer(data, f"{args.root}/results", args.questions, args.csv)
    elif args.command == "train":
        train_models(args, data)
    elif args.command == "workload":
        workloads.WORKLOADS[args.name](data).write.format("noop").mode("overwrite").save()
    else:
        names = args.model if isinstance(args.model, list) else [args.model]
        for name in names:
            model, encoding = models.load(spark, f"{args.root}/models/{name}")
            rows, leaks, extra, keys = scoring_input(name, data)
            if args.command == "score":
                scored = models.score(rows, model, encoding, leaks, extra, keys)
                tables.write_table(scored, f"{args.root}/results/scores_{name}")
            else:
                report = models.feature_importance(model, features.model_input(rows, encoding, leaks, extra))
                tables.export_report(report, f"{args.root}/results/importance_{name}", single_csv=True).show()


if __name__ == "__main__":
    main()
