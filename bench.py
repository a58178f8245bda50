"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through Spark's no-op sink (full execution, no
collect). Model fits inside a query are part of its time. The JVM is warmed
once on the smallest tables before timing; ``spark_jobs`` counts the Spark
jobs each query ran (fits, sketches, checkpoints and the final write;
with AQE every shuffle stage is its own job, and jobs started from helper
threads are not counted). Boosting runs
BENCH_ROUNDS rounds (default 10) instead of the API default of 100, and the
net BENCH_STEPS full-batch steps (default 20) instead of 2000; both are
reported in the JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bandwise.plans import calibration, nets, trees  # noqa: E402
from bandwise.plans.registry import all_queries  # noqa: E402
from bandwise.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "10"))
STEPS = int(os.environ.get("BENCH_STEPS", "20"))


def headline():
    q = all_queries()
    return {
        "calibration_chain": q["calibration_chain"],
        "conformal_by_segment": q["conformal_by_segment"],
        "sharpness_audit": q["sharpness_audit"],
        "temperature_batched": q["temperature_batched"],
        "skew_audit": q["skew_audit"],
        "density_curve": q["density_curve"],
        "order_stat_quantile": q["order_stat_quantile"],
        "report_card_lineitem": q["report_card"],
        "standardized_check_lineitem": q["standardized_check"],
        "mc_predictive_linear": q["mc_predictive_linear"],
        "nearest_center": q["nearest_center"],
        "isolation_scores": q["isolation_scores"],
        "quantile_boost": lambda s, d: trees.quantile_boost(s, d, rounds=ROUNDS),
        "kmeans_feature": q["kmeans_feature"],
        "mean_logvar_net": lambda s, d: nets.mean_logvar_net(s, d, steps=STEPS),
        "gbt_mean_lineitem": lambda s, d: trees.lineitem_gbt_mean(s, d, rounds=ROUNDS),
        "quantile_pair_lineitem": lambda s, d: trees.lineitem_quantile_pair(s, d, rounds=ROUNDS),
    }


def main() -> None:
    spark = local_session(CPUS, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # warm the JVM (code generation, Python workers) outside the timings:
    # the flagship chain once on the smallest tables
    small = os.path.join(os.path.dirname(os.path.normpath(SF_DIR)), "sf0.001")
    warm_dir = small if os.path.exists(os.path.join(small, "events.parquet")) else SF_DIR
    calibration.calibration_chain(spark, warm_dir).write.format("noop").mode("overwrite").save()
    sc = spark.sparkContext
    times, jobs, errors = {}, {}, {}
    for name, fn in headline().items():
        sc.setJobGroup(name, name)
        t0 = time.time()
        try:
            fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(name))
    sf = os.path.basename(os.path.normpath(SF_DIR)).replace("sf", "")
    ok = [v for v in times.values() if v is not None]
    print(json.dumps({"metric": "headline_total", "value": round(sum(ok), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": CPUS,
                      "boost_rounds": ROUNDS, "net_steps": STEPS, "spark_jobs": jobs,
                      "failed": errors}))


if __name__ == "__main__":
    main()
