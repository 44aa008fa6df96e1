"""Land (if given tables), clean and store one run date, then print what was read and stored.

    spark-submit run.py 2025-04-13 --root s3a://bucket --dataset league
"""

from __future__ import annotations

import argparse

from statloom.operators.reports import landed_counts
from statloom.plans import pipeline
from statloom.plans.land import land_games, land_players
from statloom.session import build_session
from statloom.sources import tables
from statloom.sources.paths import Zones


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("run_date", help="yyyy-mm-dd")
    parser.add_argument("--root", required=True, help="storage root of all zones")
    parser.add_argument("--dataset", required=True, help="folder of this dataset in each zone")
    parser.add_argument("--database", help="catalog database; by default named after the two")
    parser.add_argument("--mode", choices=[tables.APPEND, tables.REPLACE_DATES],
                        default=tables.APPEND)
    parser.add_argument("--games", help="Parquet of games to land first, with --players")
    parser.add_argument("--players", help="Parquet of player records to land first")
    parser.add_argument("--names", help="Parquet of (id, full_name)")
    parser.add_argument("--entities", type=int, nargs="+", default=[], help="players to land")
    parser.add_argument("--season", help="season to land")
    parser.add_argument("--league", help="league of the games to land")
    parser.add_argument("--expire-days", type=int, help="remove runs older than this")
    args = parser.parse_args(argv)
    spark = build_session("statloom")
    zones = Zones(args.root, args.dataset, args.database)
    if args.games and args.players:
        land_games(spark.read.parquet(args.games), zones.raw(args.run_date, "games"),
                   args.season, args.league)
        land_players(spark.read.parquet(args.players), zones.raw(args.run_date, "player_stats"),
                     args.season, args.entities, spark.read.parquet(args.names))
    pipeline.transform(spark, zones, args.run_date, args.mode)
    pipeline.audits(spark, zones, args.run_date).show(truncate=False)
    landed_counts(pipeline.warehouse_tables(spark, zones)).show(truncate=False)
    if args.expire_days is not None:
        pipeline.expire_runs(spark, zones, args.expire_days, args.run_date)


if __name__ == "__main__":
    main()
