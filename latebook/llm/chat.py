"""Chat formatting with loss masks aligned to the offsets of tokens.

A conversation is rendered as a whole and encoded once. The bytes of the assistant's texts form
sorted spans, the tokens form sorted spans too, and binary search finds for each token the part
of it that lies under the loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.tokens import encoder, token_bytes

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Strings that steer a model, of this template and of others; fixed values.
CONTROL = ("<|", "|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>",
           "<start_of_turn>", "<end_of_turn>")
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_TURN = re.compile(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n((?:\\.|[^\\<]|<(?!\|))*)"
                   + re.escape(CLOSE) + r"\n", re.DOTALL)

FORMATTED = ("conv_id long, formatted string, ids array<int>, loss_start array<int>, "
             "loss_end array<int>")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
          "loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    """No control string is left whole: a backslash breaks it, and backslashes are doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation, and the byte spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body, tail = f"{OPEN}{escape_role(role)}\n", escape(text), f"{CLOSE}\n"
        start = at + len(head.encode())
        stop = start + len(body.encode())
        if role == "assistant":
            spans.append((start, stop))
        parts += [head, body, tail]
        at = stop + len(tail)
    return "".join(parts), spans


def align(lengths: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The part of each token that lies in a span, empty where none does.

    The template's characters between two spans are more than a token holds of them, so that a
    token meets one span at most: the last that begins before the token's end.
    """
    stops = np.cumsum(lengths)
    starts = stops - lengths
    begin = np.array([a for a, _ in spans], np.int64)
    end = np.array([b for _, b in spans], np.int64)
    if not len(spans):
        return starts, starts
    k = np.searchsorted(begin, stops, side="left") - 1
    inside = (k >= 0) & (end[k] > starts)
    lo = np.where(inside, np.maximum(starts, begin[k]), starts)
    hi = np.where(inside, np.minimum(stops, end[k]), starts)
    return lo, hi


def formatter(token_file: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(token_file), token_bytes(token_file)
        for batch in batches:
            done = [render([(t["role"] or "", t["text"] or "") for t in turns])
                    for turns in batch.column(1).to_pylist()]
            ids = list(encode([text for text, _ in done]))
            masks = [align(size[i], spans) for i, (_, spans) in zip(ids, done, strict=True)]
            listed = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in done], pa.string()),
                 pa.array([i.astype(np.int32) for i in ids], listed),
                 pa.array([lo.astype(np.int32) for lo, _ in masks], listed),
                 pa.array([hi.astype(np.int32) for _, hi in masks], listed)],
                ["conv_id", "formatted", "ids", "loss_start", "loss_end"])
    return run


def format_chats(turns: DataFrame, token_file: str | None = None) -> DataFrame:
    """One row per ``conv_id``: the formatted text, its token ids and, for each token, the bytes
    of the formatted text that it has under the loss (``loss_start`` to ``loss_end``).

    Reads ``conv_id, turn, role, text``; other columns are not carried. Turns are in the order
    of ``turn``, null first; equal ones in that of role and text. A null role or text is empty,
    a null ``conv_id`` is a conversation of its own, repeated rows are turns of their own, and no
    rows give no rows. A task holds some whole conversations, each of which must be rendered
    as a whole. The template's control strings in ids are ordinary text.
    """
    turn = F.struct(turns["turn"], turns["role"], turns["text"])
    whole = turns.groupBy(turns["conv_id"].cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.mapInArrow(formatter(token_file), FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def under_loss(formatted: str, starts: list[int], ends: list[int]) -> str:
    """The text under the loss mask, read from the bytes of its tokens."""
    data = formatted.encode()
    return unescape(b"".join(data[a:b] for a, b in zip(starts, ends, strict=True)).decode())


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            turns = parse(row["formatted"])
            text = "".join(f"{r}\n{t}\n" for r, t in turns)
            loss = under_loss(row["formatted"], row["loss_start"], row["loss_end"])
            rows.append({"conv_id": row["conv_id"], "n_turns": len(turns),
                         "turns_sha256": hashlib.sha256(text.encode()).hexdigest(),
                         "loss_chars": len(loss),
                         "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                         "formatted_chars": len(row["formatted"])})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64())]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss, parsed from formatted conversations."""
    return (formatted.select("conv_id", "formatted", "loss_start", "loss_end")
            .mapInArrow(_read_back, DIGEST))


@query("op6_chat_masks")
def op6_chat_masks(spark, sf_dir):
    """All conversations and one of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return read_back(format_chats(turns.union(extra)))
