"""Chat formatting: conversations written by a compiled template, with the stretches that a model is to learn.

A template that writes each message by itself is applied where the rows lie. One that looks at places in the loop, or
has a head or a tail, gets each conversation's rows in order through one task, one row at a time. Control strings
inside texts and roles are escaped, so the output can be read back exactly. A digest of a conversation needs its text
in order; it is worked out row by row, never holding more than one.

Defined results: a null text or role is empty; rows of one turn come in order of their written form; a null turn
comes first; rows with a null conversation form one conversation; repeated rows are written each; an empty table gives
no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .templates import CHAT, compile_template, joined, unescape

FORMATTED = "conv_id long, place long, text string, learned array<struct<start:int,end:int>>"
_LEARNED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_TURN = re.compile(r"<\|im_start\|>((?:(?!<\|).)*?)\n((?:(?!<\|).)*)<\|im_end\|>\n", re.DOTALL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, turns, texts, learned = zip(*rows)
    spans = [[{"start": a, "end": b} for a, b in each] for each in learned]
    arrays = [pa.array(ids, pa.int64()), pa.array(turns, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, _LEARNED)]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", "place", "text", "learned"])


def format_conversations(rows: DataFrame, source: str = CHAT) -> DataFrame:
    """Rows (conv_id, place, text, learned) that make up each conversation in order of place and text.

    The place is the turn where rows are written each by itself, else the number of the row in its conversation.
    """
    compile_template(source)  # a broken template fails here, not in a task
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = compile_template(source)
        for batch in batches:
            if batch.num_rows:
                columns = (batch.column(i).to_pylist() for i in range(4))
                yield _batch([(c, t, *joined(template.one({"role": role, "text": text}, {}))) for c, t, role, text in zip(*columns)])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, out = compile_template(source), []
        source_rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(4))))
        waiting = next(source_rows, None)
        while waiting is not None:
            conv = waiting[0]

            def messages(conv=conv):
                nonlocal waiting
                while waiting is not None and waiting[0] == conv:
                    message = {"role": waiting[2], "text": waiting[3]}
                    waiting = next(source_rows, None)
                    yield message

            for place, pieces in enumerate(template.pieces(messages())):
                out.append((conv, place, *joined(pieces)))
                if len(out) >= 1024:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    if compile_template(source).alone:
        return clean.mapInArrow(by_row, FORMATTED)
    ordered = clean.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(in_order, FORMATTED)


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a stretch of the chat format."""
    out, at = [], 0
    for match in _TURN.finditer(text):
        if match.start() != at:
            raise ValueError("not in the chat format")
        out.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    if at != len(text):
        raise ValueError("not in the chat format")
    return out


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, held = object(), None

        def row() -> tuple:
            return (conv, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4])

        for batch in batches:
            for next_conv, text, learned in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if held is None or next_conv != conv:
                    if held is not None:
                        done.append(row())
                    conv, held = next_conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    held[0] += 1
                    held[1].update(f"{role}\n{said}\n".encode())
                for span in learned:
                    said = unescape(text[span["start"] : span["end"]])
                    held[2] += len(said)
                    held[3].update(said.encode())
                held[4] += len(text)
            if len(done) >= 1024:
                yield _digest_batch(done)
                done = []
        if held is not None:
            done.append(row())
        if done:
            yield _digest_batch(done)

    ordered = formatted.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("place"), "text")
    return ordered.select("conv_id", "text", "learned").mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], [f.split()[0] for f in DIGESTS.split(", ")])
