"""Packing tokens into fixed windows by multiway differencing.

Every document is tokenized and cut into full windows and a remainder. Remainders, cut into
chunks of at most ``CHUNK`` tokens, are dealt to the windows of a batch by Karmarkar-Karp
differencing: each chunk starts as a partial partition of its own, and the two partial
partitions of the greatest imbalance merge, the fullest windows of the one with the emptiest
of the other, until one is left. The window count of a batch starts at its least possible
value and rises while the fullest window exceeds the capacity.

Batches are made of neighbouring documents inside a task, so nothing is shuffled, and a lost
task is computed anew from its own input alone.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.tokens import encoder, tidy

CAPACITY = 1024
CHUNK = 128
#: Windows in a batch; a merge of two partial partitions costs a sort of so many sums.
WINDOWS = 64
#: Tokens by which the mean window stays below the capacity, room for what is not quite equal.
SLACK = 8
END = 0

DIGEST = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def difference(sizes: list[int], windows: int) -> tuple[np.ndarray, list]:
    """Karmarkar-Karp differencing of sizes into windows: their sums, and their members as
    nested pairs (see ``members``). Ties go by position, so results repeat."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        heap.append((-size, i, sums, [None] * (windows - 1) + [i]))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        joined = [x if y is None else y if x is None else (x, y)
                  for x, y in zip(in_a, reversed(in_b), strict=True)]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), serial, sums,
                              [joined[k] for k in order.tolist()]))
        serial += 1
    return heap[0][2], heap[0][3]


def members(tree: object) -> list[int]:
    found, open_ = [], [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            open_ += node
        elif node is not None:
            found.append(node)
    return sorted(found)


def windows_for(sizes: list[int], capacity: int) -> list[list[int]]:
    """Members of each window, none of which exceeds the capacity."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        sums, trees = difference(sizes, count)
        if sums[-1] <= capacity:
            return [m for m in map(members, trees) if m]
        count += max(1, int((sums[-1] - capacity) * count / capacity))


def packer(capacity: int, chunk: int, batch_windows: int, with_ids: bool,
           token_file: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task's side: record batches of (doc_id, text) to record batches of pieces."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(token_file)
        next_sequence = TaskContext.get().partitionId() << 40
        end = np.array([END], "<u4").tobytes()
        goal = batch_windows * max(1, capacity - SLACK)  # tokens of a full batch
        rows: list[tuple] = []      # finished pieces
        waiting: list[tuple] = []   # chunks of the batch: doc_id, start, length, doc_tokens, bytes
        tokens_waiting = 0

        def piece(doc, start, length, total, data, sequence, offset):
            row = (doc, start, length, zlib.crc32(data), total, sequence, offset)
            rows.append((*row, np.frombuffer(data, "<u4").astype(np.int32)) if with_ids else row)

        def close_batch():
            nonlocal next_sequence, tokens_waiting
            for window in windows_for([c[2] for c in waiting], capacity) if waiting else []:
                offset = 0
                for k in joined(window, waiting):
                    doc, start, length, total, data = k
                    piece(doc, start, length, total, data, next_sequence, offset)
                    offset += length
                next_sequence += 1
            waiting.clear()
            tokens_waiting = 0

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                data = ids.tobytes() + end
                total = len(data) // 4
                full = total - total % capacity
                for start in range(0, full, capacity):
                    piece(doc, start, capacity, total, data[4 * start:4 * (start + capacity)],
                          next_sequence, 0)
                    next_sequence += 1
                start = full
                while start < total:
                    stop = min(start + chunk, total, start + goal - tokens_waiting)
                    waiting.append((doc, start, stop - start, total, data[4 * start:4 * stop]))
                    tokens_waiting += stop - start
                    start = stop
                    if tokens_waiting == goal:
                        close_batch()
                if len(rows) >= 20_000:
                    yield to_batch(rows, with_ids)
                    rows.clear()
        close_batch()
        yield to_batch(rows, with_ids)

    return pack


def joined(window: list[int], chunks: list[tuple]) -> Iterator[tuple]:
    """The chunks of a window in order; neighbours of one document become one piece."""
    last = None
    for i in window:
        doc, start, length, total, data = chunks[i]
        if last is not None and i == last_index + 1 and last[0] == doc \
                and start == last[1] + last[2]:
            last = (doc, last[1], last[2] + length, total, last[4] + data)
        else:
            if last is not None:
                yield last
            last = (doc, start, length, total, data)
        last_index = i
    if last is not None:
        yield last


def to_batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    columns = list(zip(*rows, strict=True)) if rows else [()] * (7 + with_ids)
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
    if with_ids:
        arrays.append(pa.array(list(columns[7]), pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, chunk: int = CHUNK,
                   batch_windows: int = WINDOWS, with_ids: bool = True,
                   token_file: str | None = None) -> DataFrame:
    """One row per piece of a document in its window (``sequence_id``).

    Reads ``doc_id`` and ``text`` and returns the columns of ``DIGEST`` and, with ``with_ids``,
    the token ids of the piece; other columns are not carried. An empty or null text is its end
    token alone, repeated rows are packed each for itself, no rows give no rows. A task holds
    one document and one batch of ``batch_windows`` windows at a time.
    """
    schema = DIGEST + (", ids array<int>" if with_ids else "")
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    packed = packer(capacity, chunk, batch_windows, with_ids, token_file)
    return slim.mapInArrow(tidy(packed), schema)


def padding_report(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Windows, tokens and the padding that fills windows up, except at a power of two."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.agg(F.count("*").alias("windows"), F.sum("used").alias("tokens"),
                    F.sum(F.when(~power, capacity - F.col("used")).otherwise(0)).alias("padding"))


@query("op4_pack_differencing")
def op4_pack_differencing(spark, sf_dir):
    """All documents packed into windows of 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False)
