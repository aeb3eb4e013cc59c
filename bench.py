"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8).
Every query writes its whole result to the no-op sink; the first run warms up, the best of the
following runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from streamlab import build_session
from streamlab.workloads import all_queries

HEADLINE = [
    "ride_cleansing", "geo_functions", "path_cells", "popular_places", "popular_places_sql",
    "hourly_tips", "hourly_tip_max", "ride_count", "running_ride_count",
    "ending_rides_rolling_count", "latest_ride", "join_rides_fares", "match_or_expire", "asof_join",
    "long_rides", "sequence_timeout", "driving_segments", "driving_sessions", "event_time_order",
    "sequence_rules", "travel_time_predictions", "nearest_taxi", "nearest_taxi_improvements",
    "ongoing_rides", "taxi_query", "mail_count", "reply_graph", "member_of_month", "tf_idf",
    "mbox_to_mails", "transition_weights", "pagerank", "ride_topic_round_trip",
    "trips_to_ride_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Small inputs: let every core read a share of the single files.
            "spark.sql.files.maxPartitionBytes": "1m",
            "spark.sql.files.openCostInBytes": "256k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in wanted:
        times = []
        for _ in range(3):
            begun = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(min(times[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
