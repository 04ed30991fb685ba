"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores;
names on the command line choose other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quillspark.plans.queries import QUERIES
from quillspark.session import build_session

HEADLINE = [
    "clean_en", "clean_es", "symbol_counts", "emoji_names", "spell_correct", "norm_zscore",
    "lexicon_last_wins", "slang_score", "polarity_score", "emotion_shares", "glove_mean",
    "vector_parse", "ext_training_set", "feature_vectors", "class_balance", "eval_task_a",
    "eval_task_b", "eval_report", "baseline_predict", "ext_scores", "lr_together", "rf_together",
    "svm_together", "ensemble_lr",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="20g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
