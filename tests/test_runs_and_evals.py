"""Runs, backups, results and artifacts on literal rows and files."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tuneframe.operators import artifacts as A
from tuneframe.operators import evals as B
from tuneframe.operators import logs
from tuneframe.operators import runs as M
from tuneframe.plans.evaluation import compare_models, load_scores
from tuneframe.queries import QUERIES
from tuneframe.sources import listings
from tuneframe.sources import results as S
from tuneframe.sources import runs as R

LOG = "run int, step long, epoch double, loss double, learning_rate double, grad_norm double"


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        (1, 10, 0.1, 2.0, 1e-4, 1.0), (1, 20, 0.2, 1.5, 1e-4, None), (1, 25, 0.25, None, 1e-4, None),
        (2, 10, 0.5, 3.0, 1e-4, 1.0), (2, 20, 1.0, 2.5, 1e-4, 1.0),
        (4, 10, None, None, None, None),
    ]
    return spark.createDataFrame(rows, LOG)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame([(1, 25, 9.0), (2, 20, 9.0), (3, 5, 9.0), (4, 10, None)], "run int, total_steps long, train_loss double")


def test_final_step(log, runs):
    rows = {(r["run"], r["step"]): r["loss"] for r in M.append_final_step(log, runs).collect()}
    assert rows == {(1, 10): 2.0, (1, 20): 1.5, (1, 25): 1.5, (2, 10): 3.0, (2, 20): 2.5}


def test_final_loss(log, runs):
    assert {r["run"]: r["final_loss"] for r in M.final_loss(log, runs).collect()} == {1: 1.5, 2: 2.5, 3: 9.0, 4: None}


@pytest.mark.parametrize("per_run", [False, True])
def test_loss_csv(spark, log, tmp_path, per_run):
    path = str(tmp_path / "loss")
    R.write_loss_history(M.loss_rows(log), path, per_run=per_run)
    back = R.read_loss_history(spark, path).withColumn("run", F.col("run").cast("int"))
    assert sorted(map(str, back.select(*M.loss_rows(log).columns).collect())) == sorted(map(str, M.loss_rows(log).collect()))


def test_run_metrics(spark):
    df = spark.createDataFrame(
        [(164.0, 2, 2, 0, 50, 0.05, 1024**3), (60.0, 2, 4, 7, 50, 0.05, None), (0.0, 1, 1, 0, 59, 0.1, 0)],
        "training_time_seconds double, batch_size int, gradient_accumulation_steps int, warmup_steps int, "
        "total_steps long, warmup_ratio double, max_vram_bytes long",
    )
    got = [
        (r["training_time_minutes"], r["effective_batch_size"], r["actual_warmup_steps"], r["max_vram_gb"])
        for r in M.run_metrics(df).collect()
    ]
    assert got == [(164 / 60, 4, 2, 1.0), (1.0, 8, 7, None), (0.0, 1, 5, None)]


def test_read_runs(spark, tmp_path):
    for name, body in {"a": {"lora_rank": 8, "model_name": "m"}, "b": {}}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "training_metrics.json").write_text(json.dumps(body, indent=2))
        (tmp_path / name / "other.json").write_text("{}")
    rows = {r["run"]: r for r in R.read_runs(spark, str(tmp_path)).collect()}
    assert (rows["a"]["lora_rank"], rows["a"]["model_name"], rows["a"]["batch_size"]) == (8, "m", 2)
    assert (rows["b"]["lora_rank"], rows["b"]["learning_rate"], rows["b"]["max_seq_length"]) == (16, 2e-4, 4096)


def test_loss_health(spark):
    losses = [4.0, 3.0, 2.0, 9.0, 2.0, 4.0, 4.0]
    df = spark.createDataFrame([(1, i, 0.0, v, 0.0, 0.0) for i, v in enumerate(losses)], LOG)
    for slices in (None, 1, 5):
        judged = M.loss_health(df, window=2, slices=slices).orderBy("step").collect()
        assert [r["health"] for r in judged] == ["start", "falling", "falling", "spike", "falling", "falling", "rising"]
        assert [r["best_loss"] for r in judged] == [4.0, 3.0, 2.0, 2.0, 2.0, 2.0, 2.0]


def test_loss_health_of_a_run_with_most_rows(spark):
    rng = random.Random(3)
    rows = [(0, i, 0.0, rng.choice([1.0, 2.0, 5.0]), 0.0, 0.0) for i in range(1500)] + [(r, i, 0.0, float(r + i % 3), 0.0, 0.0) for r in range(1, 90) for i in range(rng.randrange(1, 9))]
    judged = M.loss_health(spark.createDataFrame(rows, LOG).repartition(5), window=4, slices=37)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 0 and "Generate" not in plan  # sorted before, and no blocks that overlap
    got = {(r["run"], r["step"]): (r["previous_loss"], r["best_loss"], r["recent_mean"]) for r in judged.collect()}
    assert len(got) == len(rows)
    for run in {r[0] for r in rows}:
        losses = [r[3] for r in sorted(x for x in rows if x[0] == run)]
        for i, loss in enumerate(losses):
            recent = losses[max(0, i - 4) : i]
            assert got[run, i] == (recent[-1] if recent else None, min(losses[: i + 1]), sum(recent) / len(recent) if recent else None)


def test_backups(spark):
    files = spark.createDataFrame(
        [
            ("m", "20251123_202255_rank32_lr0.0003_loss1.4846", "adapter_config.json", 10),
            ("m", "20251123_202255_rank32_lr0.0003_loss1.4846", "weights", 90),
            ("m", "20251124_000000_current", "adapter_config.json", 5),
            ("m", "no_marker", "adapterXconfig.json", 5),
        ],
        "model string, backup string, name string, length long",
    )
    metrics = spark.createDataFrame([("m", "20251124_000000_current", 0.5)], "model string, backup string, final_loss double")
    rows = M.newest_first(M.list_backups(files, metrics)).collect()
    assert [(r["backup"][:8], r["size"], r["rank"], r["final_loss"]) for r in rows] == [
        ("20251124", 5, "unknown", 0.5), ("20251123", 100, "32", None),
    ]


# ---- results


def write_result(root, model, variant, run, name, results):
    parts = [root, model, "benchmarks", variant] + ([run] if run else []) + ["lm-eval"]
    folder = parts[0].joinpath(*parts[1:])
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(results if isinstance(results, str) else json.dumps({"results": results}))


@pytest.fixture()
def outputs(tmp_path):
    base = {
        "ifeval": {"prompt_level_strict_acc,none": 0.4, "inst_level_strict_acc,none": 0.5, "alias": "ifeval"},
        "gsm8k": {"exact_match,none": 0, "exact_match_stderr,none": "N/A"},
        "only_base": {"acc,none": 0.1},
        "odd": {"acc,none": 0.2, "flag": True, "text": "0.5"},
    }
    tuned = {
        "ifeval": {"prompt_level_strict_acc,none": 0.6, "prompt_level_strict_acc_stderr,none": 0.02},
        "gsm8k": {"exact_match,none": 0.3, "acc,none": 0.9, "acc,none_stderr": 0.01},
        "only_tuned": {"acc,none": 0.1},
        "odd": {"f1,none": 0.7},
    }
    write_result(tmp_path, "one", "base", None, "results_1.json", {"ifeval": {"prompt_level_strict_acc,none": 0.0}})
    write_result(tmp_path, "one", "base", None, "results_2.json", base)
    write_result(tmp_path, "one", "fine-tuned", "2025-01-01T00-00-00", "results_1.json", {"ifeval": {"acc,none": 0.0}})
    write_result(tmp_path, "one", "fine-tuned", "2025-01-02T00-00-00", "results_1.json", tuned)
    write_result(tmp_path, "two", "fine-tuned", "2025-01-01T00-00-00", "results_1.json", {"t": {"acc,none": 0.5}})
    write_result(tmp_path, "two", "fine-tuned", "2025-01-02T00-00-00", "results_1.json", "{broken")
    write_result(tmp_path, "two", "base", None, "other_1.json", {"t": {"acc,none": 0.9}})
    return str(tmp_path)


def test_comparison_from_files(spark, outputs):
    rows = {(r["model"], r["task"]): r for r in compare_models(spark, outputs).collect()}
    assert set(rows) == {("one", "ifeval"), ("one", "gsm8k"), ("one", "odd")}
    ifeval, gsm8k, odd = rows[("one", "ifeval")], rows[("one", "gsm8k")], rows[("one", "odd")]
    assert (ifeval["metric"], ifeval["base_accuracy"], ifeval["finetuned_accuracy"]) == ("prompt_level_strict_acc", 0.4, 0.6)
    assert ifeval["delta"] == 0.6 - 0.4 and ifeval["delta_percent"] == (0.6 - 0.4) / 0.4 * 100
    assert (gsm8k["metric"], gsm8k["delta"], gsm8k["delta_percent"]) == ("exact_match", 0.3, 0.0)
    assert (odd["metric"], odd["base_accuracy"], odd["delta"], odd["delta_percent"]) == (None, 0.0, 0.0, 0.0)


def test_only_chosen_files_are_opened(spark, outputs, tmp_path):
    """Files that cannot be read any more do no harm where they are not chosen, and do where they are."""
    files = S.list_eval_results(spark, outputs)
    chosen = S.one_file_per_run(B.keep_latest(files, B.latest_runs(files)))
    kept = {r["path"] for r in chosen.collect()}
    assert len(kept) == 3 < files.count()
    bodies = S.read_eval_results(spark, outputs, chosen=chosen)
    for r in files.collect():
        if r["path"] not in kept:
            (tmp_path / r["path"].removeprefix("file:")).unlink()
    assert {(r["model"], r["variant"], r["run_ts"]) for r in bodies.collect()} == {("one", "base", None), ("one", "fine-tuned", "2025-01-02T00-00-00"), ("two", "fine-tuned", "2025-01-02T00-00-00")}
    assert S.read_eval_results(spark, outputs, chosen=chosen.limit(0)).isEmpty()


def test_newest_file_by_time(spark, tmp_path):
    root = tmp_path / "a [b] {c}*"
    for name, value, at in (("results_1.json", 0.1, 2_000), ("results_2.json", 0.2, 1_000)):
        write_result(root, "m", "base", None, name, {"t": {"acc,none": value}})
        os.utime(root / "m" / "benchmarks" / "base" / "lm-eval" / name, (at, at))
    place = str(root).replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}").replace("*", "\\*")
    assert [r["value"] for r in load_scores(spark, place).collect()] == [0.2]
    assert [r["value"] for r in load_scores(spark, place, by="modified").collect()] == [0.1]


def test_newest_run_hides_older_ones(spark, outputs):
    models = lambda skip: {r["model"] for r in load_scores(spark, outputs, skip_empty=skip).collect()}
    assert models(False) == {"one"}
    assert models(True) == {"one", "two"}


def test_standard_errors_in_both_spellings(spark, outputs):
    rows = {(r["task"], r["metric"]): r["stderr"] for r in load_scores(spark, outputs).filter("variant = 'fine-tuned'").collect()}
    assert rows[("ifeval", "prompt_level_strict_acc")] == 0.02
    assert rows[("gsm8k", "acc")] == 0.01
    assert rows[("gsm8k", "exact_match")] is None


def test_one_file_per_run(spark):
    files = spark.createDataFrame(
        [("m", "base", None, "results_1.json", 9, "a"), ("m", "base", None, "results_2.json", 5, "b"), ("m", "fine-tuned", "r", "results_1.json", 1, "c")],
        "model string, variant string, run_ts string, file string, modified int, body string",
    )
    assert {r["body"] for r in S.one_file_per_run(files).collect()} == {"b", "c"}
    assert {r["body"] for r in S.one_file_per_run(files, "modified").collect()} == {"a", "c"}


def test_malformed_and_legacy(spark):
    docs = spark.createDataFrame(
        [(1, '{"huggingface": {"t": {"acc,none": 1}}}'), (2, "{broken"), (3, "{}"), (4, '{"results": {"t": {"a": 1.5, "b": null}}}')],
        "id int, body string",
    )
    assert tuple(S.count_malformed(docs).first()) == (4, 1)
    assert sorted(map(tuple, S.parse_eval_results(docs, "id").collect())) == [(1, "t", "acc,none", 1.0), (4, "t", "a", 1.5)]


SCORES = "model string, variant string, run_ts string, task string, key string, metric string, value double, stderr double"


def test_policies(spark):
    values = {"acc": 0.1, "exact_match": 0.2, "accuracy": 0.3, "inst_level_strict_acc": 0.4}
    rows = [("m", "base", None, "t", k + ",none", k, v, None) for k, v in values.items()]
    rows += [("m", "base", None, "u", "zeta", "zeta", 0.9, None), ("m", "base", None, "u", "beta", "beta", 0.8, None)]
    df = spark.createDataFrame(rows, SCORES)
    pick = lambda p: {r["task"]: r["metric"] for r in B.primary_metric(df, p).collect()}
    assert pick("compare") == {"t": "inst_level_strict_acc"}
    assert pick("scores") == {"t": "acc"}
    assert pick("leaderboard") == {"t": "inst_level_strict_acc", "u": "beta"}
    without = df.filter("metric != 'inst_level_strict_acc'")
    pick = lambda p: B.primary_metric(without, p).filter("task = 't'").first()["metric"]
    assert (pick("compare"), pick("leaderboard")) == ("accuracy", "exact_match")


def test_leaderboard(spark):
    rows = [
        ("m", "base", None, "b", "acc,none", "acc", 0.12345, None), ("m", "fine-tuned", "r", "a", "acc,none", "acc", 0.5, None),
        ("base only", "base", None, "a", "acc,none", "acc", 0.5, None),
    ]
    table = B.leaderboard(spark.createDataFrame(rows, SCORES), ["b", "a"])
    assert table.columns == ["model", "variant", "a", "b"]
    assert sorted(map(tuple, table.collect())) == [
        ("m", "base", "-", f"{0.12345:.4f}"), ("m", "fine-tuned", "0.5000", "-"),
    ]


def test_summary_documents(spark, outputs, tmp_path):
    scores = load_scores(spark, outputs, skip_empty=True)
    names = spark.createDataFrame([("one", "org/base")], "model string, base_model_name string")
    docs = S.summary_documents(scores, names, "2025-01-01T00:00:00")
    S.write_benchmark_summary(docs, str(tmp_path / "out"))
    back = {r["model_name"]: r for r in spark.read.schema(docs.schema).json(str(tmp_path / "out")).collect()}
    assert back["one"]["base_model_name"] == "org/base"
    assert back["one"]["base_model"]["results"]["ifeval"]["prompt_level_strict_acc,none"] == 0.4
    assert back["one"]["comparison"]["ifeval"]["delta"] == 0.6 - 0.4
    assert back["two"]["base_model"] is None and back["two"]["comparison"] is None


def test_expected_scores(spark):
    best = spark.createDataFrame([("m", "base", None, "ifeval", "acc", 0.5), ("m", "base", None, "x", "acc", 0.5)],
                                 "model string, variant string, run_ts string, task string, metric string, value double")
    assert {r["task"]: r["gap"] for r in B.baseline_gap(best, B.expected_scores(spark)).collect()} == {"ifeval": 0.5 - 0.45, "x": None}


def test_tasks(spark):
    names = ["ifeval", "gsm8k", "hellaswag", "mmlu", "truthfulqa_mc1", "truthfulqa_mc2", "arc_challenge", "arc_b", "arc_a", "ARC_z"]
    valid = spark.createDataFrame([(n,) for n in names], "task string")
    asked = spark.createDataFrame([(n,) for n in ("ifeval", "truthful", "arc", "zzz", "Arc_")], "task string")
    bad = B.invalid_tasks(asked, valid)
    assert {r["task"] for r in bad.collect()} == {"truthful", "arc", "zzz", "Arc_"}
    found = {}
    for r in B.suggest_tasks(bad, valid).orderBy("task", "rank").collect():
        found.setdefault(r["task"], []).append(r["suggestion"])
    assert found == {
        "truthful": ["truthfulqa_mc1", "truthfulqa_mc2"],
        "arc": ["ARC_z", "arc_a", "arc_b"],
        "Arc_": ["ARC_z", "arc_a", "arc_b"],
    }


def test_task_table(spark):
    lines = ["|Group|Config Location|", "|-----|-----|", "| b_task | x |", "  |a_task|y|", "no table", "||z|", "|  |z|"]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    assert [r["task"] for r in listings.parse_task_table(df).collect()] == ["a_task", "b_task"]


def test_task_list(spark, tmp_path):
    (tmp_path / "tasks.txt").write_text("a\n\n b \na\n")
    assert {r["task"] for r in listings.read_task_list(spark, str(tmp_path / "tasks.txt")).collect()} == {"a", "b"}


def test_triage(spark):
    cases = {
        "x langdetect No module named 'y'": ("langdetect", None),
        "No module named 'rouge'": ("missing_module", "rouge"),
        "No module named rouge": ("missing_module", "unknown"),
        "CUDA out of memory": ("out_of_memory", None),
        "OutOfMemoryError": ("out_of_memory", None),
        "No such file or directory": ("missing_file", None),
        "tokenizer.chat_template is not set": ("no_chat_template", None),
        "langdetect" + "x" * 2000: ("other", None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "log string")
    assert {r["log"]: (r["failure"], r["module"]) for r in logs.triage_failures(df).collect()} == cases
    lines = spark.createDataFrame([("Unable to detect language x",), ("No features in text",), ("ok",), (None,)], "line string")
    assert [r["line"] for r in logs.filter_log_lines(lines).collect()] == ["ok", None]


# ---- artifacts


def artifacts(spark, rows):
    return spark.createDataFrame(rows, "model string, area string, name string, length long")


def test_formats(spark):
    df = artifacts(spark, [
        ("a", "lora", "adapter_config.json", 1), ("b", "lora", "adapterXconfig.json", 1), ("c", "gguf", "x.gguf", 1),
        ("d", "merged_16bit", "config.json", 1), ("e", "gguf", "xgguf", 1), ("f", "merged_16bit", "model.safetensors", 1),
    ])
    got = {r["model"]: [k for k in A.FORMAT_MARKERS if r[k]] for r in A.formats_available(df).collect()}
    assert got == {"a": ["lora"], "c": ["gguf"], "d": ["merged_16bit"]}
    upload = {r["model"] for r in A.formats_available(df, A.UPLOAD_MARKERS).collect()}
    assert upload == {"a", "c", "f"}


def test_cleanup(spark):
    rows = [
        ("m", "lora", "adapter_config.json", 1, False), ("m", "lora", "adapterXconfig.json", 2, False),
        ("m", "lora", "notes.md", 4, False), ("m", "lora", "README.mdx", 8, False), ("m", "lora", "__pycache__", 16, True),
        ("m", "lora", "checkpoint-1", 32, True), ("m", "merged_16bit", "model-00001.safetensors", 64, False),
        ("m", "merged_16bit", "modelXsafetensors", 128, False), ("m", "gguf", "m.gguf", 256, False),
        ("m", "gguf", "tokenizer.json", 512, False), ("m", "merged_4bit", "anything", 1024, False),
    ]
    df = spark.createDataFrame(rows, "model string, area string, name string, length long, is_dir boolean")
    plan = A.cleanup_plan(df)
    assert {r["name"]: r["freed_bytes"] for r in plan.collect()} == {
        "adapterXconfig.json": 2, "README.mdx": 8, "__pycache__": 0, "modelXsafetensors": 128, "tokenizer.json": 512,
    }
    assert {r["area"]: (r["removed"], r["size_mb"]) for r in A.cleanup_summary(plan).collect()} == {
        "lora": (3, 10 / 1024**2), "merged_16bit": (1, 128 / 1024**2), "gguf": (1, 512 / 1024**2),
    }


def test_quants(spark):
    df = artifacts(spark, [
        ("a", "gguf", "a-1B-F16.gguf", 1024**3), ("a", "gguf", "a-1B-Q4_K_M.gguf", 2 * 1024**3), ("b", "gguf", "b-Q8_0.gguf", 0),
        ("b", "gguf", "b-Q2_K.gguf", 0), ("b", "gguf", "model.Q4_K_M.gguf", 0), ("b", "gguf", "b-x.gguf", 0),
    ])
    table = A.quant_table(df)
    got = {r["name"]: (r["quant"], r["quality"].split(",")[0]) for r in table.collect()}
    assert got["a-1B-F16.gguf"] == ("F16", "Full precision (largest)")
    assert got["b-Q2_K.gguf"] == ("Q2_K", "Smallest size")
    assert got["b-x.gguf"] == ("x", "Unknown")
    assert {r["model"]: (r["min_gb"], r["max_gb"]) for r in A.quant_range(table).collect()} == {"a": (1.0, 2.0), "b": (0.0, 0.0)}
    assert {r["model"]: r["file"] for r in A.preferred_quant(table).collect()} == {"a": "a-1B-Q4_K_M.gguf", "b": "b-Q2_K.gguf"}
    assert [r["name"] for r in A.legacy_files(df).collect()] == ["model.Q4_K_M.gguf"]


def test_listing(spark, tmp_path):
    (tmp_path / "m" / "lora" / "sub").mkdir(parents=True)
    (tmp_path / "m" / "lora" / "a.json").write_text("12345")
    (tmp_path / "m" / "lora" / "sub" / "b.bin").write_text("1234567")
    files = listings.split_artifact_path(listings.read_artifacts(spark, str(tmp_path)), str(tmp_path))
    got = sorted((r["model"], r["area"], r["depth"], r["name"], r["length"]) for r in files.collect())
    assert got == [("m", "lora", 0, "a.json", 5), ("m", "lora", 1, "b.bin", 7)]
    assert tuple(A.area_sizes(files, "*.bin").first()) == ("m", "lora", 12, 0)
    assert A.cleanup_plan(files).select("name").collect() == [("a.json",)]


def test_missing_outputs(spark):
    asked = spark.createDataFrame([("m", "gguf_f16"), ("m", "merged_4bit"), ("m", "gguf_q9")], "model string, format string")
    there = spark.createDataFrame([("m", "gguf_f16")], "model string, format string")
    todo = lambda **k: {r["format"]: r["kind"] for r in A.missing_outputs(asked, there, **k).collect()}
    assert todo() == {"merged_4bit": "other", "gguf_q9": "unknown"}
    assert todo(force=True) == {"gguf_f16": "gguf", "merged_4bit": "other", "gguf_q9": "unknown"}


@pytest.mark.parametrize("name", ["primary_metric_compare", "primary_metric_leaderboard", "primary_metric_scores", "leaderboard"])
def test_metrics_are_chosen_without_sorting(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_suggestions_by_grams(spark):
    rng = random.Random(2)
    valid = ["".join(rng.choice("aAbBc_") for _ in range(rng.randrange(1, 9))) for _ in range(300)] + ["mmlu_x", "mmlu_y", "é_mmlu", "MMLU", ""]
    wrong = ["a", "AB", "bc_", "abca", "mmlu", "Mmlu_", "zz", "zzzz", "é_", "TruthfulQA", "ccccccccc"]
    made = B.suggest_tasks(spark.createDataFrame([(x,) for x in wrong], "task string"), spark.createDataFrame([(x,) for x in valid], "task string"))
    got = {}
    for r in sorted(made.collect()):
        got.setdefault(r["task"], []).append((r["rank"], r["suggestion"]))
    for task in wrong[:-2] + wrong[-1:]:
        want = sorted({v for v in valid if task.lower() in v.lower()}, key=lambda v: v.encode())[:3]
        assert [s for _, s in sorted(got.get(task, []))] == want, task
    assert [s for _, s in sorted(got["TruthfulQA"])] == list(B.TRUTHFUL_HINT)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nothing_is_parsed_below_the_sort_of_backups(spark):
    files = spark.createDataFrame([("m", f"2025112{i}_202255_rank32_lr0.0003_loss1.4846", "adapter_config.json", 10) for i in range(9)], "model string, backup string, name string, length long")
    made = M.list_backups(files, newest=True)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Sort [") :]
    assert "regexp" in plan.lower() or "split(" in plan
    assert "split(" not in below and "regexp" not in below.lower()
    assert [r["backup"][7] for r in made.collect()] == list("876543210")
