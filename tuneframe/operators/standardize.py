"""Every supported input shape turned into ``messages: array<struct<role, content>>``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names under which the three roles appear in public datasets.
ROLE_ALIASES = {
    "system": "system",
    "user": "user",
    "human": "user",
    "input": "user",
    "gpt": "assistant",
    "assistant": "assistant",
    "output": "assistant",
}


def detect_format(schema: T.StructType) -> str:
    """``qa``, ``strings``, ``sharegpt``, ``chat``, ``instruction`` or ``other``, from the schema alone.

    Question/answer columns win over a conversation column.
    """
    names = set(schema.fieldNames())
    if {"question", "answer"} <= names:
        return "qa"
    for column in ("conversations", "messages"):
        if column in names and isinstance(schema[column].dataType, T.ArrayType):
            element = schema[column].dataType.elementType
            if isinstance(element, T.StringType):
                return "strings"
            if isinstance(element, T.StructType):
                fields = set(element.fieldNames())
                if {"from", "value"} <= fields:
                    return "sharegpt"
                if {"role", "content"} <= fields:
                    return "chat"
    if {"instruction", "output"} <= names:
        return "instruction"
    return "other"


def _message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def qa_to_messages(df: DataFrame) -> DataFrame:
    empty = F.lit("")
    messages = F.array(
        _message("user", F.coalesce(F.col("question"), empty)),
        _message("assistant", F.coalesce(F.col("answer"), empty)),
    )
    return df.withColumn("messages", messages).drop("question", "answer")


def strings_to_messages(df: DataFrame, column: str = "conversations") -> DataFrame:
    """Alternating strings, the user first."""
    role = lambda i: F.when(i % 2 == 0, "user").otherwise("assistant")
    return _replace(df, column, F.transform(column, lambda text, i: _message(role(i), text)))


def sharegpt_to_messages(df: DataFrame, column: str = "conversations") -> DataFrame:
    return normalise_roles(
        _replace(df, column, F.transform(column, lambda m: _message(m["from"], m["value"]))), "messages"
    )


def chat_to_messages(df: DataFrame, column: str | None = None) -> DataFrame:
    column = column or ("conversations" if "conversations" in df.columns else "messages")
    return normalise_roles(df, column)


def instruction_to_messages(df: DataFrame) -> DataFrame:
    """An instruction, with its input on the next line where there is one, and its output."""
    parts = [F.col("instruction")]
    if "input" in df.columns:
        parts.append(F.nullif(F.col("input"), F.lit("")))
    messages = F.array(
        _message("user", F.concat_ws("\n", *parts)),
        _message("assistant", F.coalesce(F.col("output"), F.lit(""))),
    )
    return df.withColumn("messages", messages).drop("instruction", "input", "output")


def normalise_roles(
    df: DataFrame, column: str = "messages", aliases: Mapping[str, str] = ROLE_ALIASES
) -> DataFrame:
    """Map role aliases, in any case, to system, user and assistant; unknown ones to null."""
    return _replace(
        df, column, F.transform(column, lambda m: _message(canonical_role(m["role"], aliases), m["content"]))
    )


def canonical_role(role: Column, aliases: Mapping[str, str] = ROLE_ALIASES) -> Column:
    lowered = F.lower(role)
    chosen = F
    for target in dict.fromkeys(aliases.values()):
        chosen = chosen.when(lowered.isin(*[a for a, t in aliases.items() if t == target]), target)
    return chosen.otherwise(F.lit(None).cast("string"))


def unknown_roles(df: DataFrame, column: str = "messages") -> DataFrame:
    """Messages in all and messages without a known role."""
    return df.select(
        F.size(column).alias("n"), F.size(F.filter(column, lambda m: m["role"].isNull())).alias("unknown")
    ).agg(F.sum("n").alias("messages"), F.sum("unknown").alias("unknown_roles"))


_BY_FORMAT: dict[str, Callable[[DataFrame], DataFrame]] = {
    "qa": qa_to_messages,
    "strings": lambda df: strings_to_messages(df, "conversations" if "conversations" in df.columns else "messages"),
    "sharegpt": lambda df: sharegpt_to_messages(df, "conversations" if "conversations" in df.columns else "messages"),
    "chat": chat_to_messages,
    "instruction": instruction_to_messages,
}


def to_messages(df: DataFrame) -> DataFrame:
    """Detect the format from the schema and bring the rows into ``messages`` form."""
    found = detect_format(df.schema)
    if found not in _BY_FORMAT:
        raise ValueError(f"no known conversation columns among {df.columns}")
    return _BY_FORMAT[found](df)


def nest_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation, whole, with its messages in turn order.

    ``(conv, turn)`` is unique; turns may start anywhere and have gaps. A row holds all
    of a conversation, so where conversations can be longer than a row should be, those
    that a length limit drops are removed first: ``plans.prepare.prepare_turns`` does so.
    """
    entry = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    return (
        turns.groupBy(conv)
        .agg(F.sort_array(F.collect_list(entry)).alias("__turns"))
        .select(conv, F.transform("__turns", lambda t: _message(t["role"], t["content"])).alias("messages"))
    )


def unnest_messages(df: DataFrame, *keep: str) -> DataFrame:
    """One row per message; ``turn`` counts from 0."""
    return df.select(*keep, F.posexplode("messages").alias("__pos", "__message")).select(
        *keep,
        F.col("__pos").cast("bigint").alias("turn"),
        F.col("__message.role").alias("role"),
        F.col("__message.content").alias("content"),
    )


def _replace(df: DataFrame, column: str, messages: Column) -> DataFrame:
    out = df.withColumn("messages", messages)
    return out if column == "messages" else out.drop(column)
