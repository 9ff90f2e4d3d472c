"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. The
tables are first written again as BENCH_FILES files each (default 2 a core), outside the timing, as
large tables consist of many files; 0 reads them as they are. The fit of the screen is timed on its own.
"""
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tellmark.plans.queries import QUERIES, screen_of  # noqa: E402
from tellmark.session import build_session  # noqa: E402

HEADLINE = [
    "clean_reviews", "clean_report", "split_reviews", "value_counts", "describe_words",
    "style_features", "rule_features", "feature_means_by_label", "fit_medians",
    "near_duplicates_lsh", "near_duplicates_exact", "perplexity_features",
    "roc_auc", "threshold_sweep", "compare_models", "evaluate_splits",
    "rank_reasons", "top_spans", "score_stream", "dedupe_text", "append_new", "score_with_cache",
    "score_stream_cached",
    # This fits the whole screen (400 rounds); the others load it.
    "fit_screen", "detect_reviews", "base_prob", "token_contributions", "feature_contributions", "explain",
]


def many_files(spark, sf: str, files: int) -> str:
    """A copy of the tables in which each consists of some files."""
    out = tempfile.mkdtemp(prefix="bench-")
    for table in sorted(Path(sf).glob("*.parquet")):
        spark.read.parquet(str(table)).repartition(files).write.parquet(f"{out}/{table.name}")
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        cpus, "bench", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    files = int(os.environ.get("BENCH_FILES", 2 * int(cpus)))
    source = many_files(spark, sf, files) if files else sf
    times = {}
    for name in names:
        start = time.perf_counter()
        if name == "fit_screen":
            screen_of(spark, source)
        else:
            QUERIES[name](spark, source).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall clock", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(sf).name, "files": files,
    }))


if __name__ == "__main__":
    main()
