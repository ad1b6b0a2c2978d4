"""Benchmark: build the marts (with checks) and run every analysis on them.

Reads the synthetic tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line with per-step seconds.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import uuid
from collections import defaultdict
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.plans import analyses as A  # noqa: E402
from mercato.plans import extensions as X  # noqa: E402
from mercato.plans.build import build_marts, store_raw  # noqa: E402
from mercato.plans.checks import (MART_CHECKS, RAW_CHECKS, STAGING_CHECKS,  # noqa: E402
                                  check_frames)
from mercato.operators.quality import run_checks  # noqa: E402
from mercato.plans.layers import Layers  # noqa: E402
from mercato.session import build_session, scratch_path  # noqa: E402


def log(*a):
    print(*a, file=sys.stderr, flush=True)


def shuffle_bytes_by_group(event_dir: str) -> dict[str, int]:
    """Sum shuffle bytes written per job group from Spark's JSON event log."""
    stage_group: dict[int, str] = {}
    written: dict[str, int] = defaultdict(int)
    for path in sorted(glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if group:
                        written[group] += int(metrics.get("Shuffle Bytes Written", 0))
    return dict(written)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR") or tempfile.mkdtemp(prefix="mercato-events-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.eventLog.enabled": "true",
                                 "spark.eventLog.rolling.enabled": "false",
                                 "spark.eventLog.compress": "false",
                                 "spark.eventLog.dir": event_dir})
    out_dir = scratch_path(spark, f"bench-{uuid.uuid4().hex}")

    # warm-up on the smallest scale (JIT, codegen caches, file listing)
    warm = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    A.promised_vs_actual(warm.fct_orders).collect()

    times: dict[str, float] = {}

    def timed(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        res = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        log(f"{name:32s} {times[name]:8.3f}s")
        return res

    # raw layer: derive the nine raw tables from the synthetic tables and store them
    layers = timed("ingest_raw", lambda: store_raw(spark, Layers.from_testdata(spark, sf_dir),
                                                   f"{out_dir}/raw"))
    # build = checks on raw + staging, stored facts and marts, checks on marts
    frames = check_frames(layers)
    timed("dq_raw_staging", lambda: run_checks(frames, RAW_CHECKS + STAGING_CHECKS).collect())
    marts = timed("build_marts", lambda: build_marts(spark, layers, f"{out_dir}/marts", gate=False))
    frames.update({"fct_orders": marts.fct_orders,
                   "mart_category_performance": marts.mart_category_performance,
                   "mart_seller_performance": marts.mart_seller_performance})
    timed("dq_marts", lambda: run_checks(frames, MART_CHECKS).collect())

    items, fct = marts.items_enriched, marts.fct_orders
    cat, sel = marts.mart_category_performance, marts.mart_seller_performance
    runs = {
        "late_rate_by_category": lambda: A.late_rate_by_category(items, fct),
        "promised_vs_actual": lambda: A.promised_vs_actual(fct),
        "late_by_route": lambda: A.late_by_route(items, fct),
        "category_quadrants": lambda: A.category_quadrants(cat),
        "freight_bucket_satisfaction": lambda: A.freight_bucket_satisfaction(fct),
        "seasonality_by_category": lambda: A.seasonality_by_category(cat, years=(1997, 1998)),
        "region_comparison": lambda: A.region_comparison(sel, focus="NATION_7"),
        "revenue_pareto": lambda: A.revenue_pareto(sel),
        "volume_quality_quintiles": lambda: A.volume_quality_quintiles(sel),
        "cohort_repurchase": lambda: A.cohort_repurchase(fct),
        "repeat_vs_new": lambda: A.repeat_vs_new(fct),
        "satisfaction_by_state": lambda: A.satisfaction_by_state(fct),
        "ext_route_distance": lambda: X.ext_route_distance(items, fct, layers.stg_geolocation),
        "ext_lorenz_gini": lambda: X.ext_lorenz_gini(sel),
    }
    for name, make in runs.items():
        timed(name, lambda make=make: make().collect())

    total = round(sum(times.values()), 3)
    version = spark.version
    spark.stop()  # flushes the event log
    shuffled = shuffle_bytes_by_group(event_dir)
    print(json.dumps({"metric": "build_plus_analyses_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "spark": version,
                      "shuffle_bytes": {k: shuffled.get(k, 0) for k in times}}))


if __name__ == "__main__":
    main()
