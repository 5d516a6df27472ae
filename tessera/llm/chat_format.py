"""Chat training examples by prefix-target expansion.

Each turn becomes a segment ``<|im_start|>role\\ntext<|im_end|>\\n``; control
strings inside roles and texts are broken by a backslash after their first
character and backslashes are doubled, which ``unescape`` undoes. Every
assistant turn is exploded into an example of its own: its context is all
segments before it, and only its reply is trainable.

The context of an example is a prefix of its conversation's formatted text,
so examples hold spans (context_end, loss_start, loss_end) into the segments
instead of copies: the output grows with the turns, also where one
conversation holds a third of them. ``render`` inflates chosen examples.

Defined cases: a null text or role is empty; rows of a conversation are
ordered by turn, then role and text (null turns first), repeated rows are
repeated turns; a null conversation id is a conversation of its own; one
without an assistant turn has segments and no example; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import prepare

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of this template and of common others (fixed values).
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
           "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
CHUNK_TURNS = 1024

_BREAK = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)
_SEGMENT = re.compile(re.escape(START) + r"((?:[^\\\n]|\\.)*)\n(.*)" + re.escape(END) + "\n", re.S)


def escape(text: Column, header: bool = False) -> Column:
    """Reversible; the result holds no control string (a header no bare newline)."""
    out = F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), f"({_BREAK})", "$1\\\\")
    return F.replace(out, F.lit("\n"), F.lit("\\\n")) if header else out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(segment: str) -> tuple[str, str]:
    """(role, text) of a segment."""
    m = _SEGMENT.fullmatch(segment)
    if m is None:
        raise ValueError("not a segment")
    return unescape(m[1]), unescape(m[2])


def segments(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position (from 0), segment, char_start and
    char_end in the conversation's formatted text, and for assistant turns
    loss_start and loss_end. Positions and places are running sums within
    chunks of turns with offsets from one row per chunk, so a hot
    conversation is spread over tasks."""
    role, text = escape(F.col("role"), header=True), escape(F.col("text"))
    rows = conversations.select("conv_id", "turn", "role", "text", role.alias("_role"), text.alias("_body"))
    rows = rows.withColumn("segment", F.concat(F.lit(START), "_role", F.lit("\n"), "_body", F.lit(END + "\n")))
    rows = rows.withColumns({"_chars": F.length("segment").cast("long"), "_chunk": F.floor(F.col("turn") / CHUNK_TURNS)})
    chunks = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("_chunk").alias("_of")).agg(
        F.count("*").alias("_n"), F.sum("_chars").alias("_sum"))
    earlier = Window.partitionBy("_conv").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_conv", "_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
                           F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_chars_before"))
    inside = Window.partitionBy("conv_id", "_chunk").orderBy("turn", "role", "text")
    rows = rows.withColumns({"_row": F.row_number().over(inside) - 1,
                             "_to": F.sum("_chars").over(inside.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.join(chunks, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_chunk").eqNullSafe(F.col("_of")))
    end = F.col("_chars_before") + F.col("_to")
    loss_end = end - F.lit(len(END) + 1)
    is_reply = F.col("role") == "assistant"
    return rows.select("conv_id", (F.col("_rows_before") + F.col("_row")).alias("position"), "segment",
                       (end - F.col("_chars")).alias("char_start"), end.alias("char_end"),
                       F.when(is_reply, loss_end - F.length("_body")).alias("loss_start"), F.when(is_reply, loss_end).alias("loss_end"))


def examples(segs: DataFrame) -> DataFrame:
    """One example per assistant turn: its context is the conversation's text
    up to context_end, its own segment follows, and the loss mask covers
    loss_start to loss_end."""
    return segs.where(F.col("loss_start").isNotNull()).select(
        "conv_id", F.col("position").alias("target"), F.col("char_start").alias("context_end"), "loss_start", "loss_end", F.col("char_end").alias("example_end"))


def render(segs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The text of chosen examples: conv_id, target, text, loss_start, loss_end.
    It copies a context into each of its examples."""
    s = segs.select(F.col("conv_id").alias("_conv"), "position", "segment")
    both = chosen.join(s, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("position") <= F.col("target")))
    parts = F.sort_array(F.collect_list(F.struct("position", "segment")))
    return both.groupBy("conv_id", "target").agg(F.first("loss_start").alias("loss_start"), F.first("loss_end").alias("loss_end"),
                                                 F.array_join(parts["segment"], "").alias("text"))


def digests(segs: DataFrame, exs: DataFrame) -> DataFrame:
    """Per conversation, from the written segments and examples: n_turns,
    turns_sha256 (role, newline, text, newline of each turn), loss_chars and
    loss_sha256 (the text under the masks), formatted_chars. Examples are read
    through their spans: the reply is what the mask covers behind the context,
    and a context that isn't all segments before its reply, or an example that
    doesn't end with it, raises ValueError. A digest is
    sequential, so a conversation's rows stream through one task; no more
    than a batch of them is held."""
    prepare(segs.sparkSession)
    masked = exs.select(F.col("conv_id").alias("_conv"), F.col("target").alias("_target"), F.col("loss_start").alias("_from"), F.col("loss_end").alias("_to"),
                        "context_end", "example_end")
    rows = segs.select("conv_id", "position", "segment").join(
        masked, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("position") == F.col("_target")), "left")
    # the loss mask, read from the example and applied to its own part behind the context
    mask = F.expr("substring(segment, cast(_from - context_end + 1 as int), cast(_to - _from as int))")
    rows = rows.select("conv_id", "position", "segment", mask.alias("masked"), "context_end", "example_end").repartition("conv_id").sortWithinPartitions("conv_id", "position")
    none = object()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = none, None

        def row():
            n, turns, chars, loss, formatted = state
            return {"conv_id": now, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": formatted}

        def frame(done):
            out = pd.DataFrame(done)
            out["conv_id"] = pd.array(out["conv_id"].tolist(), "Int64")
            return out

        for f in frames:
            done = []
            for conv, segment, masked, start, end in zip(f["conv_id"], f["segment"], f["masked"], f["context_end"], f["example_end"]):
                conv = None if pd.isna(conv) else int(conv)
                if now is none or conv != now:
                    if now is not none:
                        done.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                before = state[4]
                state[4] += len(segment)
                if masked is not None:
                    if (start, end) != (before, state[4]):
                        raise ValueError(f"conversation {conv}: example {start} to {end} instead of {before} to {state[4]}")
                    reply = unescape(masked)
                    state[2] += len(reply)
                    state[3].update(reply.encode())
            if done:
                yield frame(done)
        if now is not none:
            yield frame([row()])

    return rows.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
