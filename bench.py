"""Wall time of the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Detector fit and score are timed apart from preparation, as the numbers they are compared with were.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wattsift.operators.models import anomaly_scores, fit_model, stored_vectors
from wattsift.operators.prep import fit_preprocessor
from wattsift.plans.all_queries import QUERIES
from wattsift.plans.shared import clean_energy, labelled_energy
from wattsift.session import local_session

HEADLINE = (
    "context_summary", "clean_all", "normalise_shares", "csv_locale_scan", "dense_row_id", "sample_exact",
    "sample_excluding", "split_stratified", "impute_median", "freq_encode", "preprocessor_24", "pr_curve",
    "metrics_by_type", "metrics_top_rate", "top_k_by_type", "diagnostics_overall", "diagnostics_by_type", "context_means",
    "ratio_tails", "inject_all", "inject_audit", "registry_resolve", "registry_conflicts", "lineage", "knn_join", "knn_join_distributed",
    "lof_scores", "predict_records", "stream_clean",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, work):
        started = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
        return result

    run(QUERIES["context_summary"](spark, sf_dir))  # start-up of the JVM and its code generator
    timed("publish_clean", lambda: clean_energy(spark, sf_dir))
    timed("inject_labelled", lambda: labelled_energy(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda name=name: run(QUERIES[name](spark, sf_dir)))

    clean, labelled = clean_energy(spark, sf_dir), labelled_energy(spark, sf_dir)
    pre = timed("prepare_fit", lambda: fit_preprocessor(clean))
    rows = timed("prepare_train", lambda: stored_vectors(clean, pre))
    test = timed("prepare_test", lambda: stored_vectors(labelled, pre))
    n = rows.count()
    rates = {}
    for model, short in (("isolation_forest", "iforest"), ("lof", "lof"), ("one_class_svm", "ocsvm"), ("one_class_dual", "ocsvm_dual")):
        fitted = timed(f"{short}_fit", lambda model=model: fit_model(model, rows))
        timed(f"{short}_score", lambda model=model, fitted=fitted: run(anomaly_scores(model, fitted, test)))
        rates[f"{short}_fit_rows_per_s"] = round(n / times[f"{short}_fit"])
        rates[f"{short}_score_rows_per_s"] = round(n / times[f"{short}_score"])
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "rows": n,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
