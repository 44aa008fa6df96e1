"""Time the store job against the same job written without any layout, reuse or declared schema.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python compare_plain.py

The plain job infers the schema, casts in lenient mode, deduplicates with ``dropDuplicates`` and
writes both sinks straight from that plan. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from statloom.operators import columns
from statloom.plans import pipeline
from statloom.session import build_session, scratch_path
from statloom.sources.jsonl import write_json_lines
from statloom.sources.paths import Zones
from statloom.workload import standins
from statloom.workload.queries import RUN_DATE


def plain(spark, zones: Zones) -> None:
    spark.conf.set("spark.sql.ansi.enabled", "false")
    for spec, feed in pipeline.FEEDS:
        df = spark.read.json(zones.raw(RUN_DATE, feed)).transform(columns.lowercase_columns)
        kinds = {c: "int" for c in spec.int_columns} | {c: "float" for c in spec.float_columns}
        df = (
            df.withColumn(spec.date_column, F.to_date(spec.date_column, spec.date_format))
            .withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})
            .filter(F.col(spec.required).isNotNull())
            .dropDuplicates(list(spec.keys))
            .transform(columns.stamp, RUN_DATE)
            .transform(columns.project, spec.contract)
        )
        for path in (zones.processed(RUN_DATE, feed), zones.warehouse(spec.name)):
            df.write.partitionBy(spec.partition).mode("append").parquet(path)
    spark.conf.set("spark.sql.ansi.enabled", "true")


def ours(spark, zones: Zones) -> None:
    pipeline.transform(spark, zones, RUN_DATE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("compare", f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.legacy.timeParserPolicy": "CORRECTED",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    raw = Zones(scratch_path(spark, "raw"), "league")
    write_json_lines(standins.raw_games(spark, sf_dir).repartition(int(cpus)),
                     raw.raw(RUN_DATE, "games"))
    write_json_lines(
        standins.raw_players(spark, sf_dir, named=True).repartition(int(cpus)),
        raw.raw(RUN_DATE, "player_stats"))
    times = {"plain": [], "ours": []}
    files = {}
    for _ in range(4):
        for job in (plain, ours):
            zones = _Outputs(raw, scratch_path(spark, job.__name__))
            start = time.perf_counter()
            job(spark, zones)
            times[job.__name__].append(time.perf_counter() - start)
            files[job.__name__] = sum(
                spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .load(zones.warehouse(spec.name)).select("path").count()
                for spec, _ in pipeline.FEEDS)
    print(json.dumps({
        "metric": "store_job_median", "unit": "sec",
        **{name: round(statistics.median(t[1:]), 3) for name, t in times.items()},
        "warehouse_files": files, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


class _Outputs(Zones):
    """Raw files of one place, outputs in another."""

    def __init__(self, source: Zones, root: str):
        super().__init__(root, source.dataset)
        object.__setattr__(self, "source", source)

    def raw(self, run_date, feed):
        return self.source.raw(run_date, feed)


if __name__ == "__main__":
    main()
