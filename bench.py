"""Benchmark: full warehouse load plus the analytical marts.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:

    {"metric": "...", "value": <total sec>, "unit": "sec", "queries": {...}, "sf": ...}

* ``full_load``: derive the sources from the test tables and write the four
  warehouse tables (one job per table).
* ``wh_<mart>``: each mart on the written warehouse (the dashboard path),
  executed to completion with the ``noop`` sink; warm, median of 3.
* ``raw_<query>``: a registered query that derives the star from the raw
  tables inside its own plan.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chartlake.plans import marts as M  # noqa: E402
from chartlake.plans import warehouse as WH  # noqa: E402
from chartlake.session import local_session  # noqa: E402
from chartlake.sources import staging as ST  # noqa: E402
from chartlake.sources import testdata as TD  # noqa: E402

REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = REPEATS) -> float:
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # BENCH_EVENT_LOG_DIR: write Spark's event log there (stage / task timings, no UI needed)
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app="chartlake-bench", extra_conf=extra)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    results: dict[str, float] = {}

    # full load: derive sources, write the warehouse (fresh folder per run)
    def full_load():
        root = ST.shared_path(spark, "bench_warehouse")
        WH.write_star(TD.load_fixture(spark, sf_dir).star, root)
        return root

    root = full_load()  # warm-up, also the warehouse used below
    results["full_load"] = timed(full_load)

    star = WH.read_star(spark, root)
    cfg_de, cfg_all = TD.MART, TD.MART.__class__(country=None, periods=TD.PERIODS, baseline=TD.BASELINE)
    marts = {
        "kpis": lambda: M.kpis(star, cfg_de),
        "current_top_tracks": lambda: M.current_top_tracks(star, cfg_de),
        "weekly_feature_changes": lambda: M.weekly_feature_changes(star, cfg_de),
        "audio_features_by_season": lambda: M.audio_features_by_season(star, cfg_de),
        "audio_features_by_weather": lambda: M.audio_features_by_weather(star, cfg_de),
        "danceability_by_sunshine": lambda: M.danceability_by_sunshine(star, cfg_de),
        "seasonal_streaming_trends": lambda: M.seasonal_streaming_trends(star, cfg_all),
        "acoustic_vs_electronic": lambda: M.acoustic_vs_electronic(star, cfg_all),
        "key_distribution": lambda: M.key_distribution(star, cfg_all),
        "period_comparison": lambda: M.period_comparison(star, cfg_de),
        "weekly_change_history": lambda: M.weekly_change_history(star, cfg_de),
    }
    run(marts["kpis"]())  # warm the JVM paths once
    for name, build in marts.items():
        results[f"wh_{name}"] = timed(lambda b=build: run(b()))

    raw = {
        "audio_features_by_season": lambda: M.audio_features_by_season(TD.load_fixture(spark, sf_dir).plain_star, cfg_de),
        "audio_features_by_weather": lambda: M.audio_features_by_weather(TD.load_fixture(spark, sf_dir).plain_star, cfg_de),
    }
    for name, build in raw.items():
        results[f"raw_{name}"] = timed(lambda b=build: run(b()))

    total = sum(results.values())
    print(json.dumps({
        "metric": "chartlake_full_load_plus_marts",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "sf": sf,
        "cpus": cpus,
        "repeats": REPEATS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
