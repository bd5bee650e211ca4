"""Names, single values, verdicts, recommendations and rules on literal rows."""

import random

import pytest
from pyspark.sql import functions as F

from tuneframe.functions import names as N
from tuneframe.functions import scalars as V
from tuneframe.functions import verdicts
from tuneframe.operators import recommend as C
from tuneframe.operators import rules as U


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_templates_by_name(spark):
    table = {
        "Llama-3.2-1B": "llama-3.1",
        "meta/Llama-3.1-8B": "llama-3.1",
        "Llama-3-8B": "llama3",
        "llama3-chat": "llama3",
        "llama2-7b": "llama",
        "Qwen3-4B": "qwen3",
        "Qwen2.5-7B": "qwen-2.5",
        "Qwen2-1.5B": "qwen-2",
        "Phi-3.5-mini": "phi-3",
        "gemma3-4b": "gemma-3",
        "gemma-2-2b-it": "gemma2",
        "gemma-7b": "gemma",
        "Mistral-7B": "mistral",
        "other": "chatml",
    }
    assert column(spark, list(table), N.template_for_model) == list(table.values())


def test_size_class(spark):
    table = {
        "Qwen3-1.7B": "1.5-2GB", "m-1.5B-x": "1.5-2GB", "m_2B": "2-3GB", "a-4B": "4-5GB", "3B": "4-5GB",
        "a-7B-v1": "7-9GB", "a-13B": "13-16GB", "a-32B": None, "a-14B": None, "a-7b": None, "none": None,
    }
    assert column(spark, list(table), N.model_size_class) == list(table.values())


def test_derived_names(spark):
    assert column(spark, ["GAIR/My_Set", "plain_Set"], N.dataset_slug) == ["my-set", "plain-set"]
    assert column(spark, ["GAIR/lima", "lima"], N.author) == ["GAIR", "Unknown"]
    base = lambda c: N.model_base(c, ("-fast-bnb-4bit", "-fast"))
    assert column(spark, ["o/M-1B-fast-bnb-4bit", "o/M-fast", "M-bnb-4bit"], base) == ["M-1B", "M", "M-bnb-4bit"]
    out = lambda c: N.output_name(c, F.lit("o/M"), F.lit("d/My_Set"))
    assert column(spark, ["auto", "", None, "own"], out) == ["M-my-set", "M-my-set", "M-my-set", "own"]


def test_backup_names(spark):
    df = spark.createDataFrame(
        [
            (0, "2025-11-23 20:22:55", 32, 3e-4, 1.48456),
            (1, "20251123_202255", 16, 3e-5, 0.5),
            (2, None, None, None, None),
            (3, "20251123_202255", 8, 1e-3, 3.34875),
            (4, "20251123_202255", 8, 1.25e-4, 2.0),
        ],
        "i int, d string, r int, lr double, l double",
    )
    name = N.backup_name(F.col("d"), F.col("r"), F.col("lr"), F.col("l"))
    got = [r["n"] for r in df.select("i", name.alias("n")).orderBy("i").collect()]
    assert got == [
        f"20251123_202255_rank32_lr{3e-4}_loss{1.48456:.4f}",
        f"20251123_202255_rank16_lr{3e-5}_loss{0.5:.4f}",
        "_rankunknown_lrunknown_lossunknown",
        f"20251123_202255_rank8_lr{1e-3}_loss{3.34875:.4f}",
        f"20251123_202255_rank8_lr{1.25e-4}_loss{2.0:.4f}",
    ]


def test_backup_parts(spark):
    names = ["20251123_202255_rank32_lr0.0003_loss1.4846", "20251123_202255_current", "x", "2025_1_rank8", "20251123"]
    got = [tuple(r) for r in column(spark, names, N.backup_parts)]
    u = "unknown"
    assert got == [
        ("2025-11-23", "20:22:55", "32", "0.0003", "1.4846"),
        ("2025-11-23", "20:22:55", u, u, u),
        (u, u, u, u, u),
        (u, u, "8", u, u),
        (u, u, u, u, u),
    ]


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_fixed_point_rounds_like_python(spark, digits):
    rng = random.Random(digits)
    values = [0.0, 0.125, 12.25, 12.35, 0.15, 2.5, 1.005, 3.34875, 1152 / 1024, 999.995, 0.00005, 0.05, 0.25, 1e9 + 0.5]
    values += [(2 * rng.randrange(10**6) + 1) / (2 * 10**digits) for _ in range(500)]
    values += [rng.random() * 10 ** rng.randrange(-5, 9) for _ in range(500)]
    values += [-v for v in values]
    got = column(spark, values, lambda c: V.fixed_point(c, digits), "double")
    for value, text in zip(values, got):
        assert text == f"{value:.{digits}f}", value


def test_sizes(spark):
    sizes = [0, 1023, 1024, 1152, 1024**2, 1024**3, 1024**4, 1024**5]
    assert column(spark, sizes, V.human_size, "long") == [
        "0.00 B", "1023.00 B", "1.00 KB", "1.12 KB", "1.00 MB", "1.00 GB", "1.00 TB", "1024.00 TB",
    ]


def test_percent(spark):
    assert column(spark, [12.34, 0.0, -3.21, 0.04], V.signed_percent, "double") == ["+12.3%", "0.0%", "-3.2%", "+0.0%"]


def test_durations(spark):
    table = {"10min": 600, "10m": 600, "30s": 30, "30sec": 30, "600": 600, " 5 M ": 300, "1h": None, "": None, "m": None}
    assert column(spark, list(table), V.parse_duration) == list(table.values())


def test_bools(spark):
    assert column(spark, ["true", "1", "YES", "on", "off", "", None], V.parse_bool) == [True] * 4 + [False] * 3


def test_verdicts(spark):
    points = [10.0, 9.9, 5.0, 4.9, 2.0, 1.9, 0.0, -2.9, -3.0, -5.0, -5.1]
    assert column(spark, points, verdicts.score_verdict, "double") == [
        "excellent", "good", "good", "marginal", "marginal", "weak", "weak", "acceptable loss", "regression",
        "regression", "possible forgetting",
    ]
    df = spark.createDataFrame(
        [(-10.0, 5.0), (-25.0, 5.0), (-17.0, 5.0), (-10.0, -1.0), (3.0, 0.0), (3.0, 1.0)], "g double, t double"
    )
    got = [r["v"] for r in df.select(verdicts.goal_verdict(F.col("g"), F.col("t")).alias("v")).collect()]
    assert got == ["fine", "investigate", "watch", "problem", "investigate", "fine"]


def test_tiers(spark):
    tiers = column(spark, [4999, 5000, 19999, 20000], C.lora_tier, "long")
    assert [tuple(t) for t in tiers] == [(64, 128, 3e-4), (32, 64, 2e-4), (32, 64, 2e-4), (16, 32, 2e-4)]
    quality = lambda c: C.quality_tier(F.lit("d"), c)
    assert column(spark, [800.0, 800.1, None], quality, "double") == ["standard", "high", "standard"]
    assert column(spark, ["GAIR/lima", "x"], lambda c: C.quality_tier(c, F.lit(None).cast("double"))) == ["high", "standard"]
    batches = column(spark, [7.9, 8.0, 12.0, None], C.batch_tier, "double")
    assert [tuple(b) for b in batches] == [(2, 4), (4, 2), (4, 2), (4, 2)]
    advice = column(spark, [3.9, 4.0, 8.0, None], C.gpu_advice, "double")
    assert [a.split(",")[0] for a in advice] == ["batch of one", "balanced", "larger batch", "no gpu"]


def test_overfit_is_strict(spark):
    steps = lambda c: C.overfit_steps(F.lit(800), c, F.lit(8), F.lit(1))
    assert column(spark, [0, 300, 310], steps, "int") == [None, None, 100]


def test_plan(spark):
    plan = column(spark, [1030], lambda c: C.training_plan(c, F.lit(3)), "long")[0]
    assert tuple(plan) == (129, 387, 3096, 387 * 2 / 60, 387 * 4 / 60)
    current = lambda c: C.current_plan(F.lit(1000), c, F.lit(2), F.lit(4), F.lit(2))
    assert [tuple(p) for p in column(spark, [50, 0], current, "int")] == [(50, 400, 0.4), (250, None, 2.0)]


def test_memory_fallbacks(spark):
    options = column(spark, [13.9, 14.0, None], lambda c: C.vram_fallbacks(F.lit(64), F.lit(128), c), "double")
    assert [tuple(o) for o in options[0]] == [
        ("smaller batch", 2, 4, None, None), ("lower rank", None, None, 32, 64), ("lower alpha", None, None, None, 64),
        ("both", 2, None, 32, None),
    ]
    assert options[1] == [] and options[2] == []


def test_scope(spark):
    rows = [
        (0, 10000, 50, 0, 1), (1, 10000, 0, 500, 2), (2, 1234567, 0, 0, 3), (3, None, 0, 0, 2), (4, 100, 50, 0, 1),
        (5, None, 50, 0, 1),
    ]
    df = spark.createDataFrame(rows, "i int, n long, steps int, cap int, epochs int")
    scope = C.training_scope(F.col("n"), F.col("steps"), F.lit(2), F.lit(4), F.col("cap"), F.col("epochs"))
    assert [r["s"] for r in df.select("i", scope.alias("s")).orderBy("i").collect()] == [
        "400/10,000 samples (1 epoch(s))",
        "1,000/10,000 samples (2 epoch(s))",
        "1,234,567 samples (3 epoch(s), full dataset)",
        "2 epoch(s)",
        "100 samples (1 epoch(s), full dataset)",
        "1 epoch(s)",
    ]


def test_rules(spark):
    df = spark.createDataFrame(
        [
            ("ok", 16, 0.0, "sgd", ["merged_16bit"], 1e-4, "vllm"),
            ("bad", 0, 1.1, "lion", ["gguf_q9", "gguf_f16"], 0.0, "cpu"),
            ("empty", None, None, None, None, None, None),
        ],
        "run string, lora_rank int, lora_dropout double, optimizer string, formats array<string>, "
        "learning_rate double, backend string",
    )
    got = sorted(map(tuple, U.config_violations(df, "run").collect()))
    assert got == [
        ("bad", "backend", "choice", "cpu"),
        ("bad", "formats", "choice", "gguf_q9,gguf_f16"),
        ("bad", "learning_rate", "positive", "0.0"),
        ("bad", "lora_dropout", "fraction", "1.1"),
        ("bad", "lora_rank", "positive", "0"),
        ("bad", "optimizer", "choice", "lion"),
    ]


def test_paths(spark):
    docs = ['{"a": {"b": {"c": 5}}}', '{"a": 1}', "broken", None]
    assert column(spark, docs, lambda c: U.get_path(c, "a.b.c", -1, "int")) == [5, -1, -1, -1]
