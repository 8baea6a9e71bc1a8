"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) turns to a string. It is
rendered for each prefix of a conversation; where the output of n turns starts
with that of n - 1, what was added is the span of turn n. A template that
changes what it wrote before (by dropping old turns, say) is noticed there and
reported. The place of the text within its span comes from one more rendering,
with a sentinel in the text's place.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]
#: Where the characters that may stand in a text's place begin: the private use area.
PRIVATE = 0xE000
SPANS = "array<struct<role:string,start:int,end:int,text_start:int,text_end:int,loss:boolean>>"

_SPANS = pa.list_(pa.struct([("role", pa.string()), *[(n, pa.int32()) for n in ("start", "end", "text_start", "text_end")], ("loss", pa.bool_())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def escape(text: str) -> str:
    """A backslash before each backslash and each `<`: no control string is left in a text."""
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn_template(turns: list[tuple[str, str]]) -> str:
    """Each turn as <turn>role, a line feed, the text and </turn>; roles and texts are escaped."""
    return "".join(f"<turn>{escape(role).replace(chr(10), chr(92) + chr(10))}\n{escape(text)}</turn>\n" for role, text in turns)


def read_role(header: str) -> str:
    """The role from what turn_template puts before a text."""
    return unescape(header.removeprefix("<turn>")[:-1])


def sentinel(turns: list[tuple[str, str]], template: Template) -> str:
    """A character that the template's output for these turns does not hold, and no role or text."""
    taken = {c for role, text in turns for c in role + text} | set(template(turns))
    return next(c for c in map(chr, range(PRIVATE, 0x110000)) if c not in taken)


def locate(turns: list[tuple[str, str]], template: Template) -> tuple[str, list[tuple[int, int, int, int]], int]:
    """The output for all turns, (start, end, text start, text end) of each, and how many prefixes were rewritten.

    Spans hold for a template that only appends; after a rewrite they are those of the last
    rendering in which the turn was new, cut to the common part, and must not be used for a mask.
    """
    before, spans, rewritten, mark = "", [], 0, sentinel(turns, template)
    for n in range(1, len(turns) + 1):
        now = template(turns[:n])
        if now.startswith(before):
            start = len(before)
        else:
            rewritten += 1
            start = next((i for i, (x, y) in enumerate(zip(before, now)) if x != y), min(len(before), len(now)))
        role, text = turns[n - 1]
        probe = template([*turns[: n - 1], (role, mark)])
        at = probe.find(mark, start)
        tail = len(probe) - at - 1
        spans.append((start, len(now), at, len(now) - tail) if at >= 0 else (start, len(now), len(now), len(now)))
        before = now
    return before, spans, rewritten


def format_chats(conversations: DataFrame, template: Template = turn_template, loss_roles: tuple[str, ...] = ("assistant",), id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, spans, rewritten: one row a conversation, its turns in order of turn_col.

    Offsets in spans count code points of `formatted`; `loss` marks the turns of loss_roles, and
    is null in a conversation whose history the template rewrote (`rewritten` > 0), where spans
    can't be trusted. Null roles and texts are empty; null turns come first; rows with the same
    turn go by role and text, and repeated rows are turns of their own. Rows with a null id form a
    conversation. Texts of any length are rendered whole. An empty table gives none; columns
    beside the four named are ignored, whatever their names. A conversation is rendered in one
    task, since a template may look at all of it: memory is bounded by the longest conversation,
    and time by the square of its turns.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    grouped = conversations.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks, changed = [], [], []
            for turns in batch.column(1).to_pylist():
                pairs = [(t["role"], t["text"]) for t in turns]
                out, spans, rewritten = locate(pairs, template)
                texts.append(out)
                marks.append([{"role": role, "start": a, "end": b, "text_start": c, "text_end": d, "loss": None if rewritten else role in loss_roles} for (role, _), (a, b, c, d) in zip(pairs, spans)])
                changed.append(rewritten)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(marks, _SPANS), pa.array(changed, pa.int32())], ["conv_id", "formatted", "spans", "rewritten"])

    kind = dict(conversations.dtypes)[id_col]
    return grouped.mapInArrow(render, f"conv_id {kind}, formatted string, spans {SPANS}, rewritten int")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns, loss_texts, formatted_chars, from the formatted text and the spans alone.

    A conversation without a loss mask has no loss_texts (an empty list). One row for each row of
    format_chats; an empty table has none. Null texts were formatted as empty ones and come back empty.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, loss, sizes = [], [], []
            for out, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = [{"role": read_role(out[s["start"] : s["text_start"]]), "text": unescape(out[s["text_start"] : s["text_end"]])} for s in spans]
                turns.append(found)
                loss.append([t["text"] for t, s in zip(found, spans) if s["loss"]])
                sizes.append(len(out))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(turns, _TURNS), pa.array(loss, pa.list_(pa.string())), pa.array(sizes, pa.int64())], ["conv_id", "turns", "loss_texts", "formatted_chars"])

    kind = dict(formatted.dtypes)["conv_id"]
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(read, f"conv_id {kind}, turns array<struct<role:string,text:string>>, loss_texts array<string>, formatted_chars long")
