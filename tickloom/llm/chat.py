"""Chat formatting: a state machine over roles, a declarative template, text segments with loss flags.

A conversation's turns are sorted by turn number (ties by role, then text). The state machine
says whether the order of roles is the expected one; a conversation out of order is formatted all
the same and marked. The template turns each turn into segments: a header, the escaped text, an end
mark. Only the text of roles that the template names carries the loss flag.

Inside texts, and inside names of roles that the template does not know, the escape character and
the first character of every control string get an escape character in front, so the formatted
string can be read back exactly.

Turns are grouped by conversation, which is the unit of the output; a conversation is one string, so
it has to fit into a task.

Defined cases: null text reads as empty; null role as an empty, unknown role; a null conversation id is a
conversation of its own; repeated rows are repeated turns. An empty table gives no rows. Columns
other than the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Headers per role, the header of other roles (with the role's name escaped in the middle),
    the end mark, the roles under the loss, and the escape character."""

    headers: Mapping[str, str] = field(
        default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
    )
    other: tuple[str, str] = ("### Role <", ">: ")
    end: str = "</turn>\n"
    controls: tuple[str, ...] = ("###", "</turn>", ">: ")
    loss_roles: frozenset = frozenset({"assistant"})
    escape: str = "\\"


@dataclass(frozen=True)
class Segment:
    text: str
    loss: bool


#: state -> role -> next state; a role without an entry is out of order
TURN_ORDER = {
    "start": {"system": "open", "user": "asked"},
    "open": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
FINAL_STATES = frozenset({"asked", "answered"})


def order_error(roles: Sequence[str]) -> str | None:
    """Where the sequence of roles leaves the state machine; null if it does not."""
    state = "start"
    for place, role in enumerate(roles):
        if role not in TURN_ORDER[state]:
            return f"turn {place}: {role or 'no role'} after {state}"
        state = TURN_ORDER[state][role]
    return None if state in FINAL_STATES else f"ends in {state}"


def escaped(text: str, template: Template) -> str:
    """Every escape character, and every first character of a control string, gets one in front."""
    marks = "|".join(re.escape(c[0]) + f"(?={re.escape(c[1:])})" for c in template.controls)
    return re.sub(f"{re.escape(template.escape)}|{marks}", lambda m: template.escape + m[0], text)


def unescaped(text: str, template: Template) -> str:
    return re.sub(re.escape(template.escape) + "(.)", r"\1", text, flags=re.S)


def segments(turns: Sequence[tuple[str, str]], template: Template) -> Iterator[Segment]:
    for role, text in turns:
        if role in template.headers:
            yield Segment(template.headers[role], False)
        else:
            yield Segment(template.other[0] + escaped(role, template) + template.other[1], False)
        yield Segment(escaped(text, template), role in template.loss_roles)
        yield Segment(template.end, False)


def formatted(turns: Sequence[tuple[str, str]], template: Template) -> tuple[str, list[tuple[int, int]]]:
    """The string, and the ranges of its characters that carry the loss."""
    parts, spans, at = [], [], 0
    for s in segments(turns, template):
        if s.loss:
            spans.append((at, at + len(s.text)))
        parts.append(s.text)
        at += len(s.text)
    return "".join(parts), spans


def read_back(text: str, template: Template) -> list[tuple[str, str]]:
    """Roles and texts of a formatted string; raises ValueError where it is none."""
    roles = {h: r for r, h in template.headers.items()}
    heads = "|".join(re.escape(h) for h in sorted(roles, key=len, reverse=True))
    esc = re.escape(template.escape)
    # one step: an escaped character, or one that begins no control string in force
    inner = f"(?:{esc}.|(?!{re.escape(template.end)})[^{esc}])*+"
    name = f"(?:{esc}.|(?!{re.escape(template.other[1])})[^{esc}])*+"
    turn = re.compile(
        f"(?:({heads})|{re.escape(template.other[0])}({name}){re.escape(template.other[1])})({inner}){re.escape(template.end)}",
        re.S,
    )
    out, at = [], 0
    while at < len(text):
        m = turn.match(text, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        role = roles[m[1]] if m[1] is not None else unescaped(m[2], template)
        out.append((role, unescaped(m[3], template)))
        at = m.end()
    return out


def conversations_formatted(
    rows: DataFrame,
    template: Template | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, formatted, loss_spans, order_error``, one row per conversation."""
    template = template or Template()
    kind = rows.schema[conv_id].dataType.simpleString()
    empty = F.lit("")
    turns = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text).cast("string"), empty).alias("text"),
    )
    # ids travel as text: pandas would turn integers beside a null into floats
    grouped = rows.groupBy(F.col(conv_id).cast("string").alias("conv_id")).agg(F.sort_array(F.collect_list(turns)).alias("turns"))
    grouped = grouped.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [formatted(list(zip(r, t)), template) for r, t in zip(frame.roles, frame.texts)]
            yield pd.DataFrame(
                {
                    "conv_id": frame.conv_id,
                    "formatted": [m[0] for m in made],
                    "loss_spans": [[{"start": a, "stop": b} for a, b in m[1]] for m in made],
                    "order_error": [order_error(list(r)) for r in frame.roles],
                }
            )

    out = grouped.mapInPandas(
        build, "conv_id string, formatted string, loss_spans array<struct<start:long,stop:long>>, order_error string"
    )
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))


def digests(outputs: DataFrame, template: Template | None = None) -> DataFrame:
    """What a reader of the formatted strings gets back: turns and the text under the loss."""
    template = template or Template()
    kind = outputs.schema["conv_id"].dataType.simpleString()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            turns = [read_back(text, template) for text in frame.formatted]
            losses = [
                unescaped("".join(text[s["start"] : s["stop"]] for s in spans), template)
                for text, spans in zip(frame.formatted, frame.loss_spans)
            ]
            yield pd.DataFrame(
                {
                    "conv_id": frame.conv_id,
                    "n_turns": [len(t) for t in turns],
                    "turns_sha256": [_sha("".join(f"{r}\n{x}\n" for r, x in t)) for t in turns],
                    "loss_chars": [len(x) for x in losses],
                    "loss_sha256": [_sha(x) for x in losses],
                    "formatted_chars": [len(t) for t in frame.formatted],
                    "order_error": frame.order_error,
                }
            )

    out = outputs.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(
        read,
        "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, order_error string",
    )
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
