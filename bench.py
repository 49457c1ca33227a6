"""
BENCH_REPS runs per query. Each run executes the full plan into the ``noop`` sink (no
collect). Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPS (5)
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from ratecast.operators import forecast as FC  # noqa: E402
from ratecast.operators import stats as ST  # noqa: E402
from ratecast.operators import windows as WI  # noqa: E402
from ratecast.functions import calendar as CA  # noqa: E402
from ratecast.operators.series import resample_count  # noqa: E402
from ratecast.plans import experiments as XP  # noqa: E402
from ratecast.session import get_spark, materialize  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    spark = get_spark("ratecast-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    events = spark.read.parquet(f"{sf_dir}/events.parquet")

    def series():
        # as the plans do: the series is computed once from the log, then reused
        return materialize(resample_count(events))

    benches = {
        "T1_resample_minute": lambda: resample_count(events),
        "R1_event_gaps": lambda: WI.event_gaps(events),
        "R4_rolling_1440": lambda: WI.rolling_mean_std(series(), rows=1440),
        "R6_lookback_L60_F4": lambda: WI.lookback_windows_multi(CA.add_time_features(series()), lookback=60),
        "R7_running_metrics": lambda: WI.running_metrics(FC.walk_forward(series())),
        "A2_acf_0_100": lambda: ST.acf(series(), range(101)),
        "A10_adf": lambda: ST.adf_test(series()),
        "O6_walk_forward_ma": lambda: FC.walk_forward(series()),
        "O9_grid_3x3": lambda: XP.experiment_grid(series(), lookbacks=(10, 30, 60), batch_sizes=(64,)),
    }
    results = {}
    for name, build in benches.items():
        times = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                times.append(dt)
        results[name] = round(statistics.median(times), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 4), "unit": "sec",
           "queries": results, "sf": float(m.group(1)) if m else None, "cpus": cpus, "reps": reps,
           "spark": spark.version, "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
           "events_rows": events.count()}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
