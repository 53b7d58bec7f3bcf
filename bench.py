"""Benchmark the headline jobs.

Runs each job at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each job is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). Each job first runs untimed on the smallest
data set, so JVM start-up and compilation are not charged to any job.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bayesmill.plans import registry  # noqa: E402
from bayesmill.session import build_session  # noqa: E402

HEADLINE = [
    "nb_predict",          # flagship: naive Bayes fit + predict
    "nb_model",
    "tfidf",
    "class_term_sums",
    "multilabel_accuracy",
    "ngram_freq",
    "byte_features",
    "byte_tfidf",
    "topk_error",
    "weighted_mean",
    "reorder_predictions",
    "img_preprocess",
    "img_color_jitter",
    "channel_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})
    qs = registry.queries()
    small = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    warm_dir = small if os.path.isdir(small) else sf_dir
    for k in keys:
        qs[k](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_jobs_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
