import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tuneframe.functions import text as X
from tuneframe.operators import lengths as L
from tuneframe.operators import profiling as P
from tuneframe.operators.rendering import NoSamplesLeft, drop_empty, empty_counts, require_samples
from tuneframe.plans.selection import value_at, value_range
from tuneframe.queries import QUERIES
from tuneframe.sources import splits

M = X.LengthLimits(1024)


def test_limits():
    assert (M.lower, M.upper) == (819, 1228)
    assert (X.LengthLimits(2048).lower, X.LengthLimits(2048).upper) == (1638, 2457)


@pytest.mark.parametrize(
    "estimate, zone",
    [(0, "safe"), (818, "safe"), (819, "borderline"), (1228, "borderline"), (1229, "too_long")],
)
def test_zone_bounds(spark, estimate, zone):
    df = spark.createDataFrame([("x" * (4 * estimate + extra),) for extra in range(4)], "text string")
    rows = L.add_lengths(df, M).collect()
    assert {r["estimated_length"] for r in rows} == {estimate}
    assert {r["zone"] for r in rows} == {zone}


def test_borderline_takes_exact_count(spark):
    words = lambda n: " ".join(["abc"] * n)
    df = spark.createDataFrame([(1, words(1024)), (2, words(1025)), (3, None), (4, "")], "id int, text string")
    rows = {r["id"]: r["length"] for r in L.add_lengths(df, M).collect()}
    assert rows == {1: 1024, 2: 1025, 3: 0, 4: 0}
    kept = {r["id"] for r in L.filter_length(L.add_lengths(df, M), M).collect()}
    assert kept == {1, 3, 4}


def test_tokenizer_hook_agrees(spark):
    texts = [("w " * n,) for n in (10, 1700, 2000, 2300, 4000)]
    df = spark.createDataFrame(texts, "text string")
    count = lambda s: s.str.count(X.TOKEN_PATTERN)
    native = sorted(r["length"] for r in L.add_lengths(df, M).collect())
    hooked = sorted(r["length"] for r in L.add_lengths_with(df, M, count).collect())
    assert native == hooked


SAMPLES = ["", " ", "a", "a1 b2", "Ünïcode straße", "emoji 👍👍 end", "tab\tnew\nline\r", "x" * 50, "a-b_c.d", "日本 語"]


def test_token_count_is_pattern_count(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "text string")
    got = df.select("text", X.count_tokens(F.col("text")), F.size(X.token_array(F.col("text"))), F.length("text")).collect()
    for text, count, size, chars in got:
        assert count == size == len(re.findall(X.TOKEN_PATTERN, text))
        assert chars == len(text)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=40))
def test_token_count_on_any_text(spark, texts):
    texts = [t.replace("\x00", "") for t in texts if t.isprintable()] or ["a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, count in df.select("text", X.count_tokens(F.col("text"))).collect():
        assert count == len(re.findall(X.TOKEN_PATTERN, text))


@pytest.mark.parametrize("values", [[5], [5, 1], [1, 2, 3], [4, 1, 3, 2], [7, 7, 1, 1, 9]])
def test_upper_median_and_stats(spark, values):
    df = spark.createDataFrame([(v, "safe") for v in values], "length int, zone string")
    row = L.length_stats(df, X.LengthLimits(4)).first()
    assert row["median_length"] == sorted(values)[len(values) // 2]
    assert row["max_length"] == max(values)
    assert row["avg_length"] == sum(values) / len(values)
    assert row["too_long"] == sum(v > 4 for v in values)


def test_stats_of_nothing(spark):
    row = L.length_stats(spark.createDataFrame([], "length int, zone string"), M).first()
    assert (row["total"], row["max_length"], row["avg_length"], row["median_length"]) == (0, 0, 0.0, 0)
    assert row["suggested_max_length"] is None


def test_advice_over_a_fifth(spark):
    rows = [(10, "safe")] * 8 + [(2000, "too_long")] * 2
    df = spark.createDataFrame(rows, "length int, zone string")
    assert L.length_stats(df, M).first()["suggested_max_length"] is None
    more = spark.createDataFrame(rows + [(1500, "too_long")], "length int, zone string")
    assert L.length_stats(more, M).first()["suggested_max_length"] == 2000


def test_empty_samples(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "text string")
    assert drop_empty(df).count() == 1
    counts = empty_counts(df)
    assert tuple(counts.first()) == (3, 1, 2)
    assert require_samples(counts) == 1
    with pytest.raises(NoSamplesLeft):
        require_samples(empty_counts(df.filter("text = ''")))


def test_truncate(spark):
    df = spark.createDataFrame([("a b, c",)], "text string")
    assert L.truncate_to(df, 3).first()["tokens"] == ["a", "b", ","]


def test_markers(spark):
    texts = [m.upper() + " x" for m in X.REASONING_MARKERS] + ["first step", "", None]
    df = P.flag_reasoning(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"))
    flags = [r["has_reasoning"] for r in df.orderBy("i").collect()]
    assert flags == [True] * 14 + [False] * 3


@pytest.mark.parametrize("marked, expected", [(10, False), (11, True)])
def test_share_is_strict(spark, marked, expected):
    rows = [(i, "<think>" if i < marked else "plain") for i in range(50)] + [(i, "<think>") for i in range(50, 90)]
    df = spark.createDataFrame(rows, "id int, text string")
    row = P.reasoning_share(df, "id").first()
    assert (row["sampled"], row["reasoning_samples"], row["is_reasoning"]) == (50, marked, expected)


def test_share_of_nothing(spark):
    row = P.reasoning_share(spark.createDataFrame([], "id int, text string"), "id").first()
    assert row["reasoning_share"] is None and row["is_reasoning"] is False


def test_compatibility(spark):
    rows = [(m, d, s) for m in (True, False) for d in (True, False) for s in (True, False)]
    df = spark.createDataFrame(rows, "m boolean, d boolean, s boolean")
    got = {tuple(r)[:3]: r["a"] for r in df.withColumn("a", P.compatibility(F.col("m"), F.col("d"), F.col("s"))).collect()}
    assert got[(True, False, True)] == "disable_thinking"
    assert got[(True, False, False)] == "use_chatml"
    assert got[(False, True, True)] == got[(False, True, False)] == "use_reasoning_model"
    assert got[(True, True, True)] == "ok_reasoning_template"
    assert got[(False, False, True)] == "ok_standard_template"


def test_limit_by_key(spark):
    df = spark.range(1000).withColumn("id", (F.col("id") * 37) % 1000)
    for n in (1, 10, 999, 1000, 5000):
        got = {r["id"] for r in splits.limit_samples(df, n, "id").collect()}
        assert got == set(range(min(n, 1000)))
    assert splits.limit_samples(df, 0, "id").count() == 1000
    ties = spark.createDataFrame([(None, 1), (2, 9), (2, 5), (2, 7), (None, 3), (3, 1)], "id int, x int")
    for n, want in ((1, [1]), (2, [1, 3]), (3, [1, 3, 5]), (4, [1, 3, 5, 7]), (5, [1, 3, 5, 7, 9]), (9, [1, 1, 3, 5, 7, 9])):
        assert sorted(r["x"] for r in splits.limit_samples(ties, n, "id").collect()) == want


@pytest.mark.parametrize("by", [[], ["g"]])
def test_value_at_a_position(spark, by):
    # one group holds nearly all distinct values, one a single value, one nulls alone
    rng = random.Random(6)
    rows = [("big", v) for v in rng.sample(range(10**6), 3000)] + [("big", 2**40 + i) for i in range(500)] + [("one", 7)] * 9 + [(None, 5), (None, 6)]
    rows += [("none", None)] * 3
    counts = spark.createDataFrame(rows, "g string, v long").groupBy("g", "v").count() if by else spark.createDataFrame(rows, "g string, v long").groupBy("v").count()
    values = {}
    for g, v in rows:
        if v is not None:
            values.setdefault(g if by else "", []).append(v)
    for part in (0, 0.25, 0.5, 0.99):
        made = value_at(counts, lambda n, part=part: F.floor(n * part), "v", "count", by).collect()  # noqa: B023
        assert {r["g"] if by else "": r["value"] for r in made} == {g: sorted(x)[int(len(x) * part)] for g, x in values.items()}
    assert value_at(counts, lambda n: n, "v", "count", by).isEmpty()


def test_ranges_are_in_order(spark):
    values = sorted({*range(3000), *(2**k + d for k in range(11, 62) for d in (-1, 0, 1))})
    made = spark.createDataFrame([(v,) for v in values], "v long").select(value_range(F.col("v")).alias("r"), "v").orderBy("v").collect()
    assert [r["r"] for r in made] == sorted(r["r"] for r in made) and len({r["r"] for r in made[:1024]}) == 1024


@pytest.mark.parametrize("name", ["length_stats", "conversation_length_stats", "prep_metadata", "length_stats_by_source"])
def test_no_window_over_all_lengths(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_truncation_stops_at_the_limit(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("ab, "), 1_000_000), F.lit("end")).alias("text"))
    assert L.truncate_to(df, 5).first()["tokens"] == ["ab", ",", "ab", ",", "ab"]
    assert L.truncate_to(spark.createDataFrame([(" \t",), (None,), ("a  ",), ("é9x",)], "text string"), 2).collect() == [([],), (None,), (["a"],), (["é", "9x"],)]
    cut = L.truncate_to(df, 100_000).select(F.size("tokens")).first()[0]
    assert cut == 100_000
