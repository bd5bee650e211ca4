"""Chat templates as tables of per-role markup, and their rendering as expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from tuneframe.functions.text import count_tokens, token_count


@dataclass(frozen=True)
class ChatTemplate:
    """Markup before and after the content of each role.

    The markup must begin and end with characters that are no letters or digits. Then
    no token crosses from markup to content or from one message to the next, and the
    lengths of contents can be added up without putting any text together.
    """

    name: str
    roles: Mapping[str, tuple[str, str]] = field(hash=False)
    opening: str = ""
    strip: bool = False
    #: For a family without system turns: what stands around a system text inside the next user turn.
    system_in_user: tuple[str, str] | None = None

    def __post_init__(self) -> None:
        for mark in self.system_in_user or ():
            if mark and (mark[0].isalnum() or mark[-1].isalnum()):
                raise ValueError(f"markup of system texts in {self.name!r} does not part them")
        if self.system_in_user and not self.system_in_user[1]:
            raise ValueError(f"system texts in {self.name!r} have nothing behind them")
        for role, (before, after) in self.roles.items():
            if not before or not after or any(c.isalnum() for c in (before[0], before[-1], after[0], after[-1])):
                raise ValueError(f"markup of role {role!r} in {self.name!r} does not part messages")

    def _body(self, content: Column) -> Column:
        return F.btrim(content, F.lit(" \t\r\n")) if self.strip else content

    @property
    def markup(self) -> Mapping[str, tuple[str, str]]:
        """What stands around a message of each role that can be rendered."""
        return {**self.roles, "system": self.system_in_user} if self.system_in_user else self.roles

    def _by_role(self, role: Column, value: Callable[[str, str], Column]) -> Column:
        chosen = F
        for name, (before, after) in self.markup.items():
            chosen = chosen.when(role == name, value(before, after))
        return chosen.otherwise(F.lit(None))

    def piece(self, role: Column, content: Column) -> Column:
        """One rendered message; null where the role is unknown or the content missing."""
        body = self._body(content)
        return self._by_role(role, lambda before, after: F.concat(F.lit(before), body, F.lit(after)))

    def piece_chars(self, role: Column, content: Column) -> Column:
        """Characters of the rendered message, without rendering it."""
        markup = self._by_role(role, lambda before, after: F.lit(len(before + after)))
        return F.length(self._body(content)).cast("bigint") + markup

    def piece_tokens(self, role: Column, content: Column) -> Column:
        """Tokens of the rendered message, without rendering it; null as for ``piece``."""
        markup = self._by_role(role, lambda before, after: F.lit(token_count(before) + token_count(after)))
        return F.when(content.isNotNull(), count_tokens(self._body(content)).cast("bigint") + markup)

    def loose_system(self, role: Column, turn: Column) -> Column:
        """As an aggregate over a conversation: whether a system text has no user turn behind it, in order of turn, null first."""
        if not self.system_in_user:
            return F.lit(False)
        last = lambda name: F.max(F.when(role == name, turn))
        behind = F.when(last("system").isNull(), F.count_if(role == "user") == 0).when(last("user").isNull(), True)
        return F.coalesce(F.bool_or(role == "system"), F.lit(False)) & behind.otherwise(last("system") > last("user"))

    @property
    def loose_chars(self) -> int:
        """Characters that the user turn of loose system texts adds."""
        return len("".join(self.roles["user"])) if self.system_in_user else 0

    @property
    def loose_tokens(self) -> int:
        return sum(map(token_count, self.roles["user"])) if self.system_in_user else 0

    def join(self, pieces: Column) -> Column:
        """One text of ``array<struct<role, piece>>`` in order, without the opening.

        Where a family has no system turns, their texts wait and go into the next user turn, before
        its own; those without one behind them make a user turn at the end.
        """
        if not self.system_in_user:
            return F.array_join(F.transform(pieces, lambda p: p["piece"]), "")
        before, after = self.roles["user"]
        nothing = F.array().cast("array<string>")
        state = F.struct(nothing.alias("out"), F.lit("").alias("waiting"))

        def step(found: Column, p: Column) -> Column:
            opened = F.concat(F.lit(before), found["waiting"], F.substring(p["piece"], len(before) + 1, 2**31 - 1 - len(before)))
            waits = F.struct(found["out"].alias("out"), F.concat(found["waiting"], p["piece"]).alias("waiting"))
            goes_on = F.struct(F.concat(found["out"], F.array(p["piece"])).alias("out"), found["waiting"].alias("waiting"))
            takes = F.struct(F.concat(found["out"], F.array(opened)).alias("out"), F.lit("").alias("waiting"))
            return F.when(p["role"] == "system", waits).when((p["role"] == "user") & (found["waiting"] != ""), takes).otherwise(goes_on)

        def end(found: Column) -> Column:
            rest = F.when(found["waiting"] != "", F.concat(F.lit(before), found["waiting"], F.lit(after))).otherwise("")
            return F.concat(F.array_join(found["out"], ""), rest)

        return F.aggregate(pieces, state, step, end)

    def render(self, messages: Column) -> Column:
        """All messages in one text; empty if there are none or one cannot be rendered."""
        opening = F.lit(self.opening)
        broken = F.exists(
            messages,
            lambda m: F.coalesce(~m["role"].isin(*self.markup), F.lit(True)) | m["content"].isNull(),
        )
        pieces = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), self.piece(m["role"], m["content"]).alias("piece")))
        text = F.concat(opening, self.join(pieces))
        usable = F.coalesce((F.size(messages) > 0) & ~broken, F.lit(False))
        return F.when(usable, text).otherwise("")


# Public markup of the model families. A family with further rules
# (default system texts) is passed in by the caller.
TEMPLATES = {
    "chatml": ChatTemplate(
        "chatml",
        {
            "system": ("<|im_start|>system\n", "<|im_end|>\n"),
            "user": ("<|im_start|>user\n", "<|im_end|>\n"),
            "assistant": ("<|im_start|>assistant\n", "<|im_end|>\n"),
        },
    ),
    "llama3": ChatTemplate(
        "llama3",
        {
            "system": ("<|start_header_id|>system<|end_header_id|>\n\n", "<|eot_id|>"),
            "user": ("<|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|>"),
            "assistant": ("<|start_header_id|>assistant<|end_header_id|>\n\n", "<|eot_id|>"),
        },
        opening="<|begin_of_text|>",
        strip=True,
    ),
    "phi-3": ChatTemplate(
        "phi-3",
        {
            "system": ("<|system|>\n", "<|end|>\n"),
            "user": ("<|user|>\n", "<|end|>\n"),
            "assistant": ("<|assistant|>\n", "<|end|>\n"),
        },
    ),
    "gemma": ChatTemplate(
        "gemma",
        {
            "user": ("<start_of_turn>user\n", "<end_of_turn>\n"),
            "assistant": ("<start_of_turn>model\n", "<end_of_turn>\n"),
        },
        opening="<bos>",
        strip=True,
        system_in_user=("", " "),
    ),
}


# Further names under which the same markup is known.
SAME_MARKUP = {"llama-3.1": "llama3", "qwen-2": "chatml", "qwen-2.5": "chatml", "qwen3": "chatml", "gemma2": "gemma", "gemma-3": "gemma"}
TEMPLATES |= {name: replace(TEMPLATES[other], name=name) for name, other in SAME_MARKUP.items()}
# Markup without a role for system messages, and what stands around their texts.
TEMPLATES["gemma-3"] = replace(TEMPLATES["gemma-3"], system_in_user=("", "\n\n"))
TEMPLATES |= {
    "llama": ChatTemplate("llama", {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s><s>")}, opening="<s>", strip=True, system_in_user=("<<SYS>>\n", "\n<</SYS>>\n\n")),
    "mistral": ChatTemplate("mistral", {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}, opening="<s>", strip=True, system_in_user=("", " ")),
}
# Fixed value: what an answer begins with where the family's thinking is switched off.
THINKING_OFF = {"qwen3": "<think>\n\n</think>\n\n"}


def without_thinking(template: str | ChatTemplate) -> ChatTemplate:
    """The template with its thinking switched off, or as it is if the family has no switch."""
    found = get_template(template)
    mark = THINKING_OFF.get(found.name)
    if mark is None:
        return found
    before, after = found.roles["assistant"]
    return replace(found, roles={**found.roles, "assistant": (before + mark, after)})


def get_template(template: str | ChatTemplate) -> ChatTemplate:
    if isinstance(template, ChatTemplate):
        return template
    if template not in TEMPLATES:
        raise ValueError(f"no markup for template {template!r}; pass a ChatTemplate (known: {sorted(TEMPLATES)})")
    return TEMPLATES[template]
