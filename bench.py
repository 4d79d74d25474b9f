"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed to completion with the ``noop`` sink (nothing is
collected), after one warm-up of the JVM on a tiny query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabclass.config import JobConfig  # noqa: E402
from tabclass.plans.job import train_job  # noqa: E402
from tabclass.queries import all_queries  # noqa: E402
from tabclass.session import get_spark, scratch_path  # noqa: E402
from tabclass.sources import fixtures as fx  # noqa: E402

HEADLINE = ("classification_report", "percentile_breakdown", "precision_buckets", "roc_auc_macro",
            "stratified_kfold", "smote", "knn_classify", "fit_nb", "score_stored")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark("bench", cpus=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    qs = all_queries()
    run(qs["accuracy"](spark, sf_dir))  # warm-up: JVM, codegen and the Python worker
    spark.createDataFrame([(1,)], "x int").collect()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        run(qs[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    # full job: F_SEP, models rf + dt, rf with 2 random draws, 3 folds
    out_root = scratch_path(spark, "bench")  # the shared checkpoint folder
    sep = fx.f_sep(spark, sf_dir)
    cfg = JobConfig(historic_table="events", prediction_table="events_scored", target="band",
                    id_col="event_id", model_id="bench-01", accuracy_focus="recall",
                    target_focus=("high", "low"), models=("rf", "dt"), cv_kfold=3,
                    max_trials={"rf": 2}, persist_model=True)
    t0 = time.time()
    res = train_job(spark, cfg, sep, sep, out_root)
    run(res.predictions)
    times["full_job"] = round(time.time() - t0, 3)
    print(json.dumps(res.extra["phase_sec"]), file=sys.stderr)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
