"""Chat formatting with a grammar round trip.

A conversation is rendered, read back by a deterministic parser and compared with its source. Turns
that do not come back as they went in get their conflicting content escaped, until all do.

The grammar: ``conversation = {open role close text end}``. A text or role may hold anything that is
not one of the three marks. Escaping puts a backslash into a mark after its first character, and one
more into a mark that already has some, so it can be undone whatever the text holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """The marks of a chat template and the roles whose texts are learned."""

    open: str = "[INST] "
    close: str = " [/INST]"
    end: str = "</s>"
    learned: tuple[str, ...] = ("assistant",)


class Formatter:
    """Renders and parses conversations of one template."""

    def __init__(self, template: Template = Template()):
        self.template = template
        self.marks = [template.open.strip(), template.close.strip(), template.end.strip()]
        if any(len(mark) < 2 or "\\" in mark for mark in self.marks):
            raise ValueError("a mark needs two characters and no backslash")
        bodies = "|".join(
            re.escape(mark[0]) + r"\\*" + re.escape(mark[1:]) for mark in self.marks
        )
        self.alike = re.compile(bodies)
        self.mark = re.compile("|".join(map(re.escape, self.marks)))

    def escape(self, text: str) -> str:
        return self.alike.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.alike.sub(lambda m: m[0][0] + m[0][1:].removeprefix("\\"), text)

    def render(self, turns: list[tuple[str, str]], escaped: set[int]) -> tuple[str, list]:
        """The text of a conversation and the spans of its learned texts."""
        parts, spans, at = [], [], 0
        for i, (role, text) in enumerate(turns):
            if i in escaped:
                role, text = self.escape(role), self.escape(text)
            head = self.template.open + role + self.template.close
            parts += [head, text, self.template.end]
            at += len(head)
            if turns[i][0] in self.template.learned:
                spans.append((at, at + len(text)))
            at += len(text) + len(self.template.end)
        return "".join(parts), spans

    def parse(self, rendered: str) -> list[tuple[str, str]] | None:
        """The turns of a rendered text, or None where it is not in the grammar."""
        turns, at = [], 0
        while at < len(rendered):
            if not rendered.startswith(self.template.open, at):
                return None
            start = at + len(self.template.open)
            closing = rendered.find(self.template.close, start)
            if closing < 0:
                return None
            body = closing + len(self.template.close)
            stop = self.mark.search(rendered, body)
            if stop is None or stop[0] != self.template.end.strip():
                return None
            if self.mark.search(rendered, start, closing):
                return None
            end = rendered.find(self.template.end, body)
            if end != stop.start():
                return None
            turns.append((self.unescape(rendered[start:closing]), self.unescape(rendered[body:end])))
            at = end + len(self.template.end)
        return turns

    def format(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """Render, read back, and escape what conflicts until the turns come back identical."""
        escaped: set[int] = set()
        while True:
            rendered, spans = self.render(turns, escaped)
            if self.parse(rendered) == turns:
                return rendered, spans
            conflicting = {
                i
                for i, turn in enumerate(turns)
                if i not in escaped and self.parse(self.render([turn], set())[0]) != [turn]
            }
            if not conflicting:
                raise ValueError("the template's marks cannot be told apart")
            escaped |= conflicting


FORMATTED = (
    "conv_id bigint, n_turns bigint, formatted string, "
    "loss_spans array<struct<start:bigint,end:bigint>>"
)


def _ordered(rows: DataFrame) -> DataFrame:
    """One row per conversation, with its turns in order."""
    turn = F.struct(
        F.col("turn").isNull().alias("late"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One formatted text per conversation of rows (conv_id, turn, role, text).

    Turns are ordered by ``turn``, rows without one last, ties by role and text; a repeated row is a
    turn of its own. A null text or role counts as empty. Rows with a null conv_id form one
    conversation. An empty table gives no rows; other columns are not read.

    Returns conv_id, ``n_turns``, ``formatted`` and ``loss_spans``: the code points of ``formatted``
    that hold the texts of the learned roles, escapes included.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("n_turns", pa.int64()),
                ("formatted", pa.string()),
                ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ]
        )
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                turns = [(t["role"], t["text"]) for t in row["turns"]]
                text, spans = formatter.format(turns)
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "formatted": text,
                        "loss_spans": [{"start": a, "end": b} for a, b in spans],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _ordered(rows).mapInArrow(convert, FORMATTED)


def parse_conversations(
    formatted: DataFrame, template: Template = Template(), extra: tuple[str, ...] = ()
) -> DataFrame:
    """Read formatted texts back: conv_id, turns and the learned texts, unescaped.

    A text outside the grammar gives null turns; a null text gives no turns. ``extra`` names more
    columns to hand through.
    """
    kept = ["conv_id", *extra]
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        for batch in batches:
            turns, learned = [], []
            texts = batch.column("formatted").to_pylist()
            spans = batch.column("loss_spans").to_pylist()
            for text, marked in zip(texts, spans):
                text = text or ""
                parsed = formatter.parse(text)
                turns.append(
                    None if parsed is None else [{"role": r, "text": t} for r, t in parsed]
                )
                own = [text[s["start"] : s["end"]] for s in marked or []]
                learned.append([formatter.unescape(x) for x in own])
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(turns, pa.list_(turn)), pa.array(learned, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "turns", "learned"])

    types = ", ".join(f"{c} {formatted.schema[c].dataType.simpleString()}" for c in kept)
    wanted = dict.fromkeys([*kept, "formatted", "loss_spans"])
    return formatted.select(*wanted).mapInArrow(
        convert, f"{types}, turns array<struct<role:string,text:string>>, learned array<string>"
    )
