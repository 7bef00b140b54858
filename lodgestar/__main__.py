"""Load the warehouse from raw files, or print one analysis of it.

    python -m lodgestar load ROOT --positive WORDS... --negative WORDS... [--database NAME]
    python -m lodgestar reviews-by-year CITY [--database NAME]
    python -m lodgestar avg-price-by-month CITY [--months 1 6 7 10]
    python -m lodgestar top-hosts CITY [--min-reviews 30] [--k 2]

``load --into new`` creates the tables, ``replace``, ``append`` and ``merge`` take those that are there.
It prints, per input, the rows read, those with a fault and those left out. An analysis is printed as rows of tab-separated values under a line of column names, all of them and
nulls as ``NULL``. On a cluster submit this file with ``spark-submit``; master and resources are those
of the submit.
"""

from __future__ import annotations

import argparse

from lodgestar.functions import parsing
from lodgestar.operators.star import Star
from lodgestar.plans import analyses
from lodgestar.plans.warehouse import Inputs, create_warehouse, load_warehouse
from lodgestar.session import build_session
from lodgestar.sources import RawLayout


def parser() -> argparse.ArgumentParser:
    commands = argparse.ArgumentParser(prog="lodgestar")
    sub = commands.add_subparsers(dest="command", required=True)

    load = sub.add_parser("load")
    load.add_argument("root")
    load.add_argument("--positive", nargs="+", required=True)
    load.add_argument("--negative", nargs="+", required=True)
    load.add_argument("--cities", nargs="+", default=list(RawLayout.cities))
    load.add_argument("--review-mode", choices=("split", "whole"), default="split")
    load.add_argument("--listing-mode", choices=("split", "whole"), default="split")
    load.add_argument("--review-prefix", default=parsing.REVIEW_PREFIX)
    load.add_argument("--normalize-lexicon", action="store_true")
    load.add_argument("--lenient", action="store_true", help="list malformed rows, do not fail")
    load.add_argument("--into", choices=("new", "replace", "append", "merge"), default="new")
    load.add_argument("--row-id", choices=("stable", "run"), default="stable")
    load.add_argument("--format", choices=("orc", "parquet"), default="orc")
    load.add_argument("--fact-by-year", action="store_true")
    load.add_argument("--fact-by-city", action="store_true")

    reviews = sub.add_parser("reviews-by-year")
    prices = sub.add_parser("avg-price-by-month")
    prices.add_argument("--months", nargs="+", type=int)
    hosts = sub.add_parser("top-hosts")
    hosts.add_argument("--min-reviews", type=int, default=analyses.MIN_REVIEWS)
    hosts.add_argument("--k", type=int, default=analyses.BEST_HOSTS)
    for command in (reviews, prices, hosts):
        command.add_argument("city")
    for command in (load, reviews, prices, hosts):
        command.add_argument("--database")
    return commands


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"lodgestar {args.command}")
    if args.command == "load":
        layout = RawLayout(args.root, cities=tuple(args.cities))
        inputs = Inputs.from_files(
            spark,
            layout,
            args.positive,
            args.negative,
            review_mode=args.review_mode,
            listing_mode=args.listing_mode,
            review_prefix=args.review_prefix,
            normalize_lexicon=args.normalize_lexicon,
            on_error="null" if args.lenient else "fail",
        )
        if args.into == "new":
            create_warehouse(
                spark,
                args.database,
                file_format=args.format,
                fact_by_year=args.fact_by_year,
                fact_by_city=args.fact_by_city,
            )
        counts = load_warehouse(
            spark,
            inputs,
            args.database,
            overwrite=args.into != "append",
            merge=args.into == "merge",
            row_id=args.row_id,
        )
        for name, seen in counts.items():
            print(name, seen.rows, seen.rejected, seen.left_out, sep="\t")
        return
    star = Star.from_catalog(spark, args.database)
    if args.command == "reviews-by-year":
        result = analyses.reviews_by_year(star, args.city)
    elif args.command == "avg-price-by-month":
        result = analyses.avg_price_by_month(star, args.city, args.months)
    else:
        result = analyses.top_hosts(star, args.city, args.min_reviews, args.k)
    print(*result.columns, sep="\t")
    for row in result.toLocalIterator():
        print(*("NULL" if value is None else value for value in row), sep="\t")


if __name__ == "__main__":
    main()
