"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the number of local cores. Every query runs once to
warm up, and the best of three further runs counts; results go to the no-op sink, so whole tables
are computed and nothing is collected. Fits of models run twice and the second counts, the boosted
trees also at sf0.01 where that is there. A query that fails is named under "failed" and the others still count.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from sievework.operators import training
from sievework.plans import modelling
from sievework.plans.queries import QUERIES, model_tables
from sievework.specs import BOOKING

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = (
    "violation_summary",
    "clean_rows",
    "stored_verdicts",
    "clean_assertion",
    "frequency_tables",
    "numeric_summary",
    "exact_percentiles",
    "duplicate_rows",
    "duplicate_keys",
    "dedupe_keep_one",
    "feature_table",
    "hash_split_md5",
    "scaling_stats",
    "standardized",
    "normalized_test_rows",
    "target_correlation",
    "correlation_report",
    "full_profile",
    "pairwise_correlation",
    "classification_metrics",
    "roc_auc",
    "pr_auc",
    "csv_contract_scan",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def clock(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def run_query(spark: SparkSession, name: str) -> None:
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def train_times(spark: SparkSession, sf_dir: str, times: dict, suffix: str = "", names: tuple[str, ...] = ()) -> None:
    """Adds the seconds to fit each of the named models, all four by default, on the persisted training rows."""
    train, test = model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    sides = [
        training.spread(training.assemble(t, columns, BOOKING.label), int(CPUS))
        for t in (train, test)
    ]
    models = training.four_models()
    with training.kept(*sides) as (train_ml, test_ml):
        train_ml.count(), test_ml.count()
        for name in names or models:
            key = f"fit_{name.lower().replace(' ', '_')}{suffix}"

            def fit(name=name):
                return training.train_models({name: models[name]}, train_ml, test_ml)[0].training_seconds

            attempt(times, key, lambda: [round(fit(), 3) for _ in range(2)][-1])


def attempt(times: dict, name: str, run) -> None:
    """Adds the seconds that ``run`` returns, if any; a failure is noted as None and the rest goes on."""
    try:
        seconds = run()
    except Exception as error:  # one failing query must not lose the figures of the others
        times[name] = None
        print(f"{name}: {str(error)[:300]}", file=sys.stderr, flush=True)
        return
    if seconds is not None:
        times[name] = seconds
        print(f"{name}: {seconds}", file=sys.stderr, flush=True)


def best_time(spark: SparkSession, name: str) -> float:
    run_query(spark, name)
    return min(clock(lambda: run_query(spark, name)) for _ in range(RUNS))


def main() -> None:
    spark = session()
    times: dict[str, float | None] = {}
    for name in HEADLINE:
        attempt(times, name, lambda: best_time(spark, name))
    attempt(times, "fits", lambda: train_times(spark, SF_DIR, times))
    smaller = os.path.join(os.path.dirname(os.path.normpath(SF_DIR)), "sf0.01")
    if os.path.isdir(smaller) and os.path.normpath(SF_DIR) != smaller:
        few = ("Gradient Boosted Tree",)
        attempt(times, "small_fits", lambda: train_times(spark, smaller, times, "_sf0.01", few))
    failed = sorted(n for n, seconds in times.items() if seconds is None)
    times = {n: seconds for n, seconds in times.items() if seconds is not None}
    print(
        json.dumps(
            {
                "metric": "headline queries and model fits, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "failed": failed,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
