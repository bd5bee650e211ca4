"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads. Every
query is run to the end, twice, with a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tuneframe.functions.text import LengthLimits  # noqa: E402
from tuneframe.operators.lengths import add_lengths, length_stats  # noqa: E402
from tuneframe.queries import QUERIES  # noqa: E402
from tuneframe.session import build_session  # noqa: E402

HEADLINE = (
    "conversation_length_stats", "prepare_conversations", "prepared_dataset", "render_chat", "qa_to_messages",
    "length_stats", "length_stats_by_source", "exact_tokens", "final_length", "truncate_to", "flag_reasoning",
    "reasoning_share_by_source", "recommendation", "training_plan", "parse_eval_results", "normalise_metrics",
    "primary_metric_leaderboard", "compare", "leaderboard", "suggest_tasks", "limit_per_task", "filter_log_lines",
    "triage_failures", "append_final_step", "loss_health", "list_backups", "cleanup_plan", "missing_outputs",
    "config_violations", "seeded_shuffle", "pack_sequences", "pack_blocks",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first run of a query pays for compiling it; the second is what it costs on data.
    seconds, first = {}, {}
    for timing in (first, seconds):
        for name in HEADLINE:
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            timing[name] = round(time.perf_counter() - start, 3)

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    limits = LengthLimits(1024)
    start = time.perf_counter()
    stats = length_stats(add_lengths(documents, limits), limits).first()
    elapsed = time.perf_counter() - start
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").agg(F.count("*")).first()[0]

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, second run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run_value": round(sum(first.values()), 3),
                "sf": float(scale.group(1)) if scale else None,
                "documents_per_second": round(stats["total"] / elapsed),
                "turns_per_second": round(turns / seconds["conversation_length_stats"]),
                "borderline_share": stats["borderline_pct"] / 100,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
