"""From result files to comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tuneframe.operators.evals import compare, keep_latest, latest_runs, latest_scores, normalise_metrics
from tuneframe.sources.results import RESULT_PATH, list_eval_results, one_file_per_run, parse_eval_results, read_eval_results


def load_scores(
    spark: SparkSession, root: str, skip_empty: bool = False, by: str = "file", layout: str = RESULT_PATH, glob: str = "results*.json"
) -> DataFrame:
    """Metric rows of the base run and the newest fine-tuned run of every model below the root.

    A newest run without scores hides older ones unless ``skip_empty`` is set. Of several
    files in a run the greatest by name counts, or with ``by="modified"`` the newest. Runs and files are chosen from
    the list of paths, and only chosen files are opened.
    """
    files = list_eval_results(spark, root, layout, glob)
    if not skip_empty:
        files = keep_latest(files, latest_runs(files))
    bodies = read_eval_results(spark, root, layout, glob, one_file_per_run(files, by))
    scores = normalise_metrics(parse_eval_results(bodies, "model", "variant", "run_ts"))
    return latest_scores(scores) if skip_empty else scores


def compare_models(
    spark: SparkSession, root: str, skip_empty: bool = False, by: str = "file", layout: str = RESULT_PATH, glob: str = "results*.json"
) -> DataFrame:
    return compare(load_scores(spark, root, skip_empty, by, layout, glob))
