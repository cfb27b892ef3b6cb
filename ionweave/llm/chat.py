"""Chat formatting: a finite-state machine over roles, and a declarative template that emits segments with loss flags.

A turn becomes three segments: header, text, footer. Inside texts and roles every `<`, backslashes, `|` gets one more
backslash, so no control string can arise there; this is undone on reading. Rows of one conversation go through one task
in the order (turn, role, text), as a sorted stream: no conversation is held in memory.

Null texts and roles are empty. A turn order that the machine refuses leaves the conversation formatted, with valid
false from that turn on. Unknown roles have no loss. A null conv_id is a conversation of its own."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings, and for each role whether its text counts for the loss.
TEMPLATE = {"start": "<|im_start|>", "end": "<|im_end|>", "after_role": "\n", "after_turn": "\n", "line_feed": "<|nl|>", "loss": {"assistant": True}}
#: State after a role in a state; a missing entry is an error, and the machine stays in `refused`.
MACHINE = {
    ("begin", "system"): "told", ("begin", "user"): "asked",
    ("told", "user"): "asked",
    ("asked", "assistant"): "answered", ("asked", "tool"): "asked",
    ("answered", "user"): "asked", ("answered", "tool"): "asked",
}
SEGMENTS = "conv_id long, turn long, position long, valid boolean, segments array<struct<text:string,loss:boolean>>"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def segments_of(role: str, text: str, template: dict = TEMPLATE) -> list[tuple[str, bool]]:
    t = template
    name = escape(role).replace("\n", t["line_feed"])
    return [(t["start"] + name + t["after_role"], False), (escape(text), t["loss"].get(role, False)), (t["end"] + t["after_turn"], False)]


def turn_of(formatted: str, template: dict = TEMPLATE) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    t = template
    head, _, rest = formatted.removeprefix(t["start"]).partition(t["after_role"])
    return unescape(head.replace(t["line_feed"], "\n")), unescape(rest.removesuffix(t["end"] + t["after_turn"]))


def _streamed(batches: Iterator[pa.RecordBatch], each: Callable, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, min(batch.num_rows, size * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield from each(batch.slice(at, step))


def format_turns(df: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per turn of df (conv_id, turn, role, text), conversations in order within partitions, as SEGMENTS says."""
    rows = df.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def run(batches):
        held = ["no conversation", "begin", 0]

        def each(batch):
            conv, turn, role, text = (c.to_pylist() for c in batch.columns)
            position, valid, made = [], [], []
            for c, r, x in zip(conv, role, text):
                if held[0] != c:
                    held[:] = [c, "begin", 0]
                held[1] = MACHINE.get((held[1], r), "refused")
                position.append(held[2])
                held[2] += 1
                valid.append(held[1] != "refused")
                made.append([{"text": t, "loss": f} for t, f in segments_of(r, x, template)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(position, pa.int64()), pa.array(valid), pa.array(made, kind)], names=["conv_id", "turn", "position", "valid", "segments"])

        yield from _streamed(batches, each)

    return rows.mapInArrow(run, SEGMENTS)


def digests(turns: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Per conversation, read back from formatted turns as format_turns() leaves them in their partitions.

    The pieces of a conversation are read as one text: a turn ends where the template's footer stands, so a control string
    that had come through unescaped would show as another number of turns and other digests."""
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    footer = template["end"] + template["after_turn"]

    def run(batches):
        held: dict = {}

        def done():
            # what no footer ends is no turn
            return (held["conv"], held["n"], held["all"].hexdigest(), held["loss_chars"], held["loss"].hexdigest(), held["chars"], held["valid"] and not held["open"])

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[p.split()[0] for p in out.split(", ")])

        def each(batch):
            rows = []
            for c, ok, segments in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if not held or held["conv"] != c:
                    if held:
                        rows.append(done())
                    held.update(conv=c, n=0, all=hashlib.sha256(), loss_chars=0, loss=hashlib.sha256(), chars=0, valid=True, open="")
                formatted = "".join(s["text"] for s in segments)
                *turns, held["open"] = (held["open"] + formatted).split(footer)
                for turn in turns:
                    role, text = turn_of(turn + footer, template)
                    held["all"].update(f"{role}\n{text}\n".encode())
                held["n"] += len(turns)
                for s in segments:
                    if s["loss"]:
                        plain = unescape(s["text"])
                        held["loss"].update(plain.encode())
                        held["loss_chars"] += len(plain)
                held["chars"] += len(formatted)
                held["valid"] &= ok
            if rows:
                yield packed(rows)

        yield from _streamed(batches, each)
        if held:
            yield packed([done()])

    return turns.mapInArrow(run, out)
