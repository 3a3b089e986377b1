"""Chat formatting with a template that is only ever called, never inspected.

A conversation is rendered one turn further each time. What a rendering adds to
the one before is the span of the new turn; a rendering that does not begin
with the one before shows that the template rewrites history. Two renderings
that differ only in a probe text of the last turn show which part of its span
is text: what they have in common before and after the probe is the template's.

Turns are ordered by turn, nulls first, then by role and text, so ties have one
order; repeated rows are repeated turns. A null role or text is empty. Rows
with a null id form one conversation. Extra columns are not returned. Every
turn is rendered after all turns before it, whatever the template makes of
them, so the cost grows with the square of the turns; only a caller who knows
that a turn depends on no other turn but the one before may ask for blocks. A
conversation must fit a row.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

# Any two texts whose first and last characters differ.
_PROBES = ("x", "y")


@dataclass(frozen=True)
class Span:
    """Where a turn and its text are in the formatted conversation."""

    start: int
    end: int
    text_start: int
    text_end: int


class MarkedTemplate:
    """``### Role: text</turn>`` per turn, control strings escaped by a backslash."""

    _IN_TEXT = re.compile(r"[\\#<]")
    _IN_ROLE = re.compile(r"[\\#<:\n]")
    _ESCAPED = re.compile(r"\\(.)", re.DOTALL)
    _TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*)</turn>\n", re.DOTALL)

    def escape(self, text: str, special: re.Pattern = _IN_TEXT) -> str:
        return special.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return self._ESCAPED.sub(r"\1", text)

    def __call__(self, turns: list[Turn]) -> str:
        return "".join(
            f"### {self.escape(role, self._IN_ROLE)}: {self.escape(text)}</turn>\n"
            for role, text in turns
        )

    def read(self, marked: str) -> Turn:
        """Role and text of one formatted turn."""
        found = self._TURN.fullmatch(marked)
        if found is None:
            raise ValueError(f"not a formatted turn: {marked[:80]!r}")
        return self.unescape(found[1]), self.unescape(found[2])


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def _inside(render: Render, before: list[Turn], role: str, added: str, base: str) -> tuple[int, int]:
    """Where the text begins in ``added``, and how much follows it."""
    x, y = (render([*before, (role, p)])[len(base) :] for p in _PROBES)
    head = min(_common(x, y), len(added))
    tail = _common(x[head:][::-1], y[head:][::-1])
    return head, min(tail, len(added) - head)


def locate(
    render: Render, turns: list[Turn], block_turns: int | None = None
) -> tuple[str, list[Span], list[int]]:
    """The formatted conversation, the span of each turn, and the turns that rewrote history.

    After a rewriting turn the spans follow what its rendering and the one
    before still have in common. With ``block_turns`` each block of so many
    turns is rendered after the last turn of the block before alone, which is
    right only for templates whose turns depend on nothing earlier.
    """
    block_turns = block_turns or max(1, len(turns))
    parts, spans, rewriting, offset = [], [], [], 0
    for first in range(0, len(turns), block_turns):
        context = turns[first - 1 : first] if first else []
        before, base = list(context), render(context) if first else ""
        head = len(base)
        starts, text_at = [], []
        for i, (role, text) in enumerate(turns[first : first + block_turns], first):
            longer = render([*before, (role, text)])
            if not longer.startswith(base):
                rewriting.append(i)
                kept = _common(base, longer)
                starts = [min(s, kept) for s in starts]
                base = longer[:kept]
            at, after = _inside(render, before, role, longer[len(base) :], base)
            starts.append(len(base))
            text_at.append((at, after))
            before.append((role, text))
            base = longer
        ends = [*starts[1:], len(base)]
        for start, end, (at, after) in zip(starts, ends, text_at, strict=True):
            here = offset + start - head
            stop = offset + end - head
            spans.append(Span(here, stop, min(here + at, stop), max(stop - after, min(here + at, stop))))
        parts.append(base[head:])
        offset += len(base) - head
    return "".join(parts), spans, rewriting


def format_conversations(
    df: DataFrame, render: Render, *, block_turns: int | None = None
) -> DataFrame:
    """Per conversation: conv_id, formatted, spans (with roles) and rewriting turns."""
    schema = (
        "conv_id long, formatted string, spans array<struct<role:string,start:long,end:long,"
        "text_start:long,text_end:long>>, rewriting array<long>"
    )
    names = ["conv_id", "formatted", "spans", "rewriting"]

    def formatted(conversation, turns: list[Turn]) -> dict:
        text, spans, rewriting = locate(render, turns, block_turns)
        places = [
            {"role": role, **vars(span)} for (role, _), span in zip(turns, spans, strict=True)
        ]
        return dict(zip(names, (conversation, text, places, rewriting), strict=True))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns, done = None, [], []
        for batch in batches:
            for conversation, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns and conversation != current:
                    done.append(formatted(current, turns))
                    turns = []
                current = conversation
                turns.append((role, text))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if turns:
            yield pa.RecordBatch.from_pylist([formatted(current, turns)], schema=arrow)

    place = pa.struct(
        [("role", pa.string()), *[(n, pa.int64()) for n in ("start", "end", "text_start", "text_end")]]
    )
    arrow = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("formatted", pa.string()),
            ("spans", pa.list_(place)),
            ("rewriting", pa.list_(pa.int64())),
        ]
    )
    turn = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    return (
        df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *turn)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(stream, schema)
    )


def read_back(formatted: DataFrame, template: MarkedTemplate, loss_role: str = "assistant") -> DataFrame:
    """conv_id, turns (role and text) and the text under the loss mask, from the output alone."""
    schema = "conv_id long, n_turns long, turns string, loss string, formatted_chars long"
    arrow = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns", pa.string()),
            ("loss", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = [template.read(text[s["start"] : s["end"]]) for s in row["spans"]]
                masked = (
                    template.unescape(text[s["text_start"] : s["text_end"]])
                    for s in row["spans"]
                    if s["role"] == loss_role
                )
                rows.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns": "".join(f"{role}\n{said}\n" for role, said in turns),
                        "loss": "".join(masked),
                        "formatted_chars": len(text),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return formatted.mapInArrow(read, schema)
