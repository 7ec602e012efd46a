"""Seconds per headline query. Prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every query writes all its rows to the noop sink,
so nothing is pruned away; ``store_detections`` derives and writes the detection table, ``index`` is the time to build the polygon indexes and the cell table that the others share.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fathomline.plans import queries as registry
from fathomline.runtime import session

HEADLINE = (
    "dedupe_detections", "classify", "points_in_polygons", "assign_country", "hex_monthly", "aggregate_hexes", "hotspots",
    "monthly_totals", "country_series", "pressure_rollup", "clear_matrix", "selection_aggregate", "quantile_breaks",
    "publish_points", "merge_periods", "cells_touching_polygons", "cell_area",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the engine

    seconds: dict[str, float] = {}
    t = registry.tables(spark, folder)
    start = time.perf_counter()
    _ = t.detections
    seconds["store_detections"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    _ = (t.meadow_index, t.zone_index, t.cells)
    seconds["index"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        registry.QUERIES[name](t).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
