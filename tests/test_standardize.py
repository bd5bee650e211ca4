import random

import pytest
from pyspark.sql import functions as F

from tuneframe.functions.templates import SAME_MARKUP, TEMPLATES, ChatTemplate, get_template, without_thinking
from tuneframe.functions.text import LengthLimits, count_tokens
from tuneframe.operators import lengths as L
from tuneframe.operators import standardize as S
from tuneframe.operators.rendering import render_by_template, render_chat, render_switched
from tuneframe.plans.prepare import prepare_samples, prepare_turns

CHAT = "conversations array<struct<role:string,content:string>>"
SHAREGPT = "conversations array<struct<`from`:string,value:string>>"


def messages(df):
    return [None if r["messages"] is None else [(m["role"], m["content"]) for m in r["messages"]] for r in df.collect()]


@pytest.mark.parametrize(
    "schema, expected",
    [
        ("question string, answer string", "qa"),
        ("question string, answer string, conversations array<string>", "qa"),
        ("conversations array<string>", "strings"),
        (CHAT, "chat"),
        (CHAT.replace("conversations", "messages"), "chat"),
        (SHAREGPT, "sharegpt"),
        ("instruction string, output string", "instruction"),
        ("question string", "other"),
        ("conversations string", "other"),
    ],
)
def test_detect_format(spark, schema, expected):
    assert S.detect_format(spark.createDataFrame([], schema).schema) == expected


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        S.to_messages(spark.createDataFrame([], "a string"))


def test_qa(spark):
    df = spark.createDataFrame([("q", "a"), ("q", None), (None, "é👍")], "question string, answer string")
    assert messages(S.to_messages(df)) == [
        [("user", "q"), ("assistant", "a")],
        [("user", "q"), ("assistant", "")],
        [("user", ""), ("assistant", "é👍")],
    ]


def test_strings(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), ([],), (None,)], "conversations array<string>")
    assert messages(S.to_messages(df)) == [[("user", "a"), ("assistant", "b"), ("user", "c")], [], None]


def test_chat_and_unknown_roles(spark):
    df = spark.createDataFrame(
        [([("System", "s"), ("human", "h"), ("GPT", "g"), ("tool", "t")],), ([("input", "i"), ("output", "o")],)], CHAT
    )
    out = S.to_messages(df)
    assert messages(out) == [
        [("system", "s"), ("user", "h"), ("assistant", "g"), (None, "t")],
        [("user", "i"), ("assistant", "o")],
    ]
    assert tuple(S.unknown_roles(out).first()) == (6, 1)


def test_sharegpt(spark):
    df = spark.createDataFrame([([("human", "h"), ("gpt", "g")],)], SHAREGPT)
    assert messages(S.to_messages(df)) == [[("user", "h"), ("assistant", "g")]]


def test_instruction(spark):
    df = spark.createDataFrame(
        [("do", "it", "done"), ("do", "", "done"), ("do", None, None)], "instruction string, input string, output string"
    )
    assert messages(S.to_messages(df)) == [
        [("user", "do\nit"), ("assistant", "done")],
        [("user", "do"), ("assistant", "done")],
        [("user", "do"), ("assistant", "")],
    ]
    short = spark.createDataFrame([("do", "done")], "instruction string, output string")
    assert messages(S.to_messages(short)) == [[("user", "do"), ("assistant", "done")]]


def test_nest_keeps_long_conversations_whole(spark):
    turns = spark.range(2500).select(
        F.lit(1).alias("conv_id"), (F.col("id") * 3 + 7).alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("t"), "id").alias("text"),
    ).repartition(7)
    nested = S.nest_turns(turns)
    assert [len(r["messages"]) for r in nested.collect()] == [2500]
    back = S.unnest_messages(nested, "conv_id").orderBy("turn").collect()
    assert [(r["turn"], r["content"]) for r in back] == [(i, f"t{i}") for i in range(2500)]


@pytest.mark.parametrize("limit", [1024, 60_000])
def test_both_ways_to_prepare_agree(spark, limit):
    """A conversation of 1,500 turns with gaps is one sample: kept whole or not at all."""
    turns = spark.createDataFrame(
        [(1, 5 + 2 * t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(1500)]
        + [(2, t, "user" if t % 2 == 0 else "assistant", "short") for t in range(4)],
        "conv_id long, turn long, role string, text string",
    )
    limits = LengthLimits(limit)
    by_turns = {(r["conv_id"], r["text"]) for r in prepare_turns(turns, limits).collect()}
    by_rows = {(r["conv_id"], r["text"]) for r in prepare_samples(S.nest_turns(turns), limits).collect()}
    assert by_turns == by_rows and {c for c, _ in by_turns} == ({1, 2} if limit > 1024 else {2})


RENDERED = {
    "chatml": "<|im_start|>user\n hi <|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n",
    "llama3": "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nhi<|eot_id|>"
    "<|start_header_id|>assistant<|end_header_id|>\n\nyo<|eot_id|>",
    "phi-3": "<|user|>\n hi <|end|>\n<|assistant|>\nyo<|end|>\n",
    "llama": "<s>[INST] hi [/INST] yo </s><s>",
    "mistral": "<s>[INST] hi [/INST] yo</s>",
    "gemma": "<bos><start_of_turn>user\nhi<end_of_turn>\n<start_of_turn>model\nyo<end_of_turn>\n",
}


RENDERED |= {name: RENDERED[other] for name, other in SAME_MARKUP.items()}


def test_render_by_template(spark):
    rows = [(name, [("user", " hi "), ("assistant", "yo")]) for name in [*TEMPLATES, "unheard-of", None]]
    df = spark.createDataFrame(rows, "template string, " + CHAT.replace("conversations", "messages"))
    got = {r["template"]: r["text"] for r in render_by_template(df).collect()}
    assert got == {**RENDERED, "unheard-of": "", None: ""}


def test_thinking_is_switched_off(spark):
    df = spark.createDataFrame([("disable_thinking", [("user", "hi"), ("assistant", "yo")])], "action string, " + CHAT.replace("conversations", "messages"))
    assert "<|im_start|>assistant\n<think>\n\n</think>\n\nyo<|im_end|>" in render_switched(df, "qwen3").first()["text"]
    assert without_thinking("gemma") == get_template("gemma")


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_templates(spark, name):
    df = spark.createDataFrame([([("user", " hi "), ("assistant", "yo")],)], CHAT.replace("conversations", "messages"))
    assert render_chat(df, name).first()["text"] == RENDERED[name]


def test_unrenderable_is_empty(spark):
    rows = [([],), (None,), ([(None, "x")],), ([("user", None)],), ([("tool", "x")],), ([("user", "x"), ("tool", "y")],)]
    df = spark.createDataFrame(rows, CHAT.replace("conversations", "messages"))
    assert {r["text"] for r in render_chat(df).collect()} == {""}
    own = ChatTemplate("own", {"user": ("<u>", "</u>")})
    system = spark.createDataFrame([([("system", "s"), ("user", "x")],)], CHAT.replace("conversations", "messages"))
    assert render_chat(system, own).first()["text"] == ""


# Families that have no system turns: what a system text looks like before "x" of the user.
FOLDED = {
    "gemma": "<bos><start_of_turn>user\ns x<end_of_turn>\n", "gemma2": "<bos><start_of_turn>user\ns x<end_of_turn>\n",
    "gemma-3": "<bos><start_of_turn>user\ns\n\nx<end_of_turn>\n", "llama": "<s>[INST] <<SYS>>\ns\n<</SYS>>\n\nx [/INST]", "mistral": "<s>[INST] s x [/INST]",
}


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_system_texts(spark, name):
    chats = [[("system", " s "), ("user", "x")], [("user", "a"), ("system", "s"), ("assistant", "b"), ("system", "t"), ("user", "c"), ("user", "d")], [("user", "a"), ("system", "s"), ("system", "t")], [("system", "s")]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(chats)], "i int, " + CHAT.replace("conversations", "messages"))
    got = {r["i"]: r["text"] for r in render_chat(df, name).collect()}
    assert all(got.values())
    shape = TEMPLATES[name]
    if name in FOLDED:
        assert got[0] == FOLDED[name]
        (before, after), (left, right) = shape.roles["user"], shape.system_in_user
        reply = shape.roles["assistant"][0] + "b" + shape.roles["assistant"][1]
        texts = [left + x + right for x in "st"]
        assert got[1] == shape.opening + f"{before}a{after}{reply}{before}{texts[0]}{texts[1]}c{after}{before}d{after}"
        assert got[2] == shape.opening + f"{before}a{after}{before}{texts[0]}{texts[1]}{after}"
        assert got[3] == shape.opening + before + texts[0] + after
    else:
        assert "".join(got[0].split("s", 1)) != got[0] and shape.markup == shape.roles


@pytest.mark.parametrize("name", sorted(FOLDED))
def test_prepared_turns_with_system_texts(spark, name):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["system", "user", "assistant"]), f" w{c} {t}; " * rng.randrange(1, 9)) for c in range(60) for t in range(rng.randrange(1, 7))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    limits = LengthLimits(45)
    texts = render_chat(S.nest_turns(turns), name)
    want = L.add_lengths(texts, limits).select("conv_id", F.length("text").cast("bigint").alias("chars"), "estimated_length", "zone", "length")
    got = L.conversation_lengths(turns, limits, name)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    kept = {r["conv_id"]: r["text"] for r in L.filter_length(L.add_lengths(texts, limits), limits).collect()}
    assert kept == {r["conv_id"]: r["text"] for r in prepare_turns(turns, limits, name).collect()} and 5 < len(kept) < 60


def test_template_lookup():
    with pytest.raises(ValueError):
        get_template("unheard-of")
    with pytest.raises(ValueError):
        ChatTemplate("joined", {"user": ("user: ", "x")})
    own = ChatTemplate("own", {"user": ("<u>", "</u>")})
    assert get_template(own) is own


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_lengths_from_turns_equal_lengths_of_texts(spark, name):
    rows = [(c, t, "assistant" if t % 2 else "user", f"word{c} {t}, ünï " * (c * 3 + t)) for c in range(12) for t in range(4)]
    rows += [(50, 0, "moderator", "x"), (51, 0, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    limits = LengthLimits(200)
    texts = render_chat(S.nest_turns(turns), name)
    want = L.add_lengths(texts, limits).select("conv_id", F.length("text").cast("bigint").alias("chars"), "estimated_length", "zone", "length")
    got = L.conversation_lengths(turns, limits, name)
    assert {r["zone"] for r in got.collect()} == {"safe", "borderline", "too_long"}
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_conversation_is_removed_before_it_is_gathered(spark):
    """A third of all turns lies in one conversation; kept texts do not depend on how it is dropped."""
    small = [(c, t, "user" if t % 2 == 0 else "assistant", f"hello {c} {t}") for c in range(40) for t in range(5)]
    hot = [(99, t, "user", "again and again") for t in range(100)]
    broken = [(98, t, "moderator", "x") for t in range(30)]
    turns = spark.createDataFrame(small + hot + broken, "conv_id long, turn long, role string, text string")
    limits = LengthLimits(150)
    assert len(prepare_turns(turns, limits).collect()) == 40


def test_opening_counts_once(spark):
    opening = TEMPLATES["llama3"].opening
    tokens = spark.range(1).select(count_tokens(F.lit(opening))).first()[0]
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    chars = L.conversation_lengths(turns, LengthLimits(10), "llama3").first()["chars"]
    text = render_chat(S.nest_turns(turns), "llama3").first()["text"]
    assert chars == len(text) and tokens == 9


def test_turns_without_a_conversation_are_measured_like_others(spark):
    """They are one conversation; where it is too long it is dropped before its turns are gathered."""
    limits = LengthLimits(50)
    many = [(None, i, "user", "some words of a turn") for i in range(400)] + [(1, 0, "user", "short")]
    df = spark.createDataFrame(many, "conv_id long, turn long, role string, text string")
    made = prepare_turns(df, limits)
    assert [r["conv_id"] for r in made.collect()] == [1]
    few = spark.createDataFrame(many[:2] + many[-1:], df.schema)
    assert sorted((r["conv_id"] is None, r["conv_id"]) for r in prepare_turns(few, limits).collect()) == [(False, 1), (True, None)]
    gone = made._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" in gone
