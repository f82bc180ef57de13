"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads. Each query runs once to warm up and
is then timed to the end of a full read of its result.
"""

import json
import os
import time

from railpulse.session import build_session
from railpulse.workload.queries import QUERIES

HEADLINE = [
    "clean_full", "clean_drop_nulls", "tof_frame_counts", "tof_occupancy", "tof_block_mean", "tof_client",
    "dht11_registry", "dht11_client", "dps_registry", "dps_client", "pair_lag", "pair_self_join",
    "pair_sliced", "piezo_segments", "piezo_registry", "headway", "headway_sliced", "piezo_client",
    "upsert_latest_by_key", "omron_passthrough", "route_family", "csv_scan", "file_stream_ingest",
    "stream_upsert", "tof_run", "dps_run", "piezo_run",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    times = {}
    for name in HEADLINE:
        seconds(name)
        times[name] = seconds(name)
    spark.stop()
    print(json.dumps({"metric": "headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
