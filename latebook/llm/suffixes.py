"""Removing repeated passages: suffixes in radix order, through ``WINDOW`` bytes only.

Two suffixes that agree in their first 50 bytes are a repeated passage, so suffixes need no order
beyond that depth, and equal groups after the last digit are what is looked for. Digits are taken
from the most significant on, and each pass only orders what the pass before left in a group of
several documents:

1. The first digit of a window of 50 bytes is the least of its 12-byte strings by hash, its
   *anchor*. Equal windows have equal digits. Neighbouring suffixes mostly share the anchor, so a
   *run* of them is one row instead of one for every byte.
2. The second digit is the whole run: all bytes from its first window to its last. Runs that an
   earlier document holds as a whole are repeated.
3. The third digits are the anchor with the 19 bytes to its right, and to its left; a window holds
   one of the two. A run that shares neither with a run of another document is not repeated.
4. What is left are runs that agree with another in part, at the edges of passages. Their single
   windows are the last digit, all 50 bytes of them. The runs of one anchor are ordered in one task
   with their bytes; an anchor with more than ``CROWD`` runs has its windows spread over all tasks.

The bytes of runs are compared by 96 bits of hash, those of spread windows by 128, others as they
are; the third digits only choose what is looked at. Each task first orders the suffixes of its own
texts, so that of equal rows one a task goes on, and a first digit with many unlike runs in one task
has its windows spread at once; a very common passage therefore has few rows a task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain

#: Bytes of a repeated passage; fixed by the result contract.
WINDOW = 50
#: Bytes of the strings of which a window's least one is its first digit.
GRAM = 12
#: Windows that are worked on together; unlike runs of one anchor in a task, runs of one anchor,
#: and windows of a run, beyond which windows are spread. None changes the result.
BLOCK = (1 << 20) - 64
WIDE = 512
CROWD = 10_000
LONG = 256

#: What a row says: still open, repeated, its windows to be looked at with those of its anchor, or
#: spread, and that an anchor has such rows.
OPEN, GONE, APART, SPREAD, MARK = 0, 1, 2, 3, 4
#: Bits of a place in a block, below those of a hash; the third digit of a run without one, and of
#: one whose anchor stands in a window twice.
_PLACE = np.uint64((1 << 20) - 1)
_NONE, _TWICE = 0, 0xFFFF


@functools.cache
def _powers(inverse: bool) -> np.ndarray:
    """Powers of an odd number, or of its inverse, for the places of a block and more."""
    base = int(_ODD[2])
    step = np.uint64(pow(base, -1, 1 << 64) if inverse else base)
    return np.multiply.accumulate(np.concatenate(
        [np.ones(1, np.uint64), np.full(BLOCK + 4096, step, np.uint64)]))
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place, as a number."""
    word = data.astype(np.uint64)
    for bits in (8, 16, 32):
        step = bits // 8
        word = word[:-step] | (word[step:] << np.uint64(bits))
    return word


def mixed(word: np.ndarray, at: np.ndarray | slice, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (eight or more) at places."""
    total = np.uint64(size)
    for step in [*range(0, size - 8, 8), size - 8]:
        here = (word[step + at.start:step + at.stop] if isinstance(at, slice) else word[at + step])
        total = (total ^ here) * _ODD[0]
        total ^= total >> np.uint64(32)
    total = total * _ODD[1]
    return total ^ (total >> np.uint64(29))


def least_within(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return values if have == width else np.minimum(
        values[:have - width], values[width - have:])


def anchors(grams: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor and whether that stands in the window twice.

    The highest 44 bits of a hash decide, so a place fits below them; both are up to the window's
    bytes alone.
    """
    width, place = window - GRAM + 1, np.arange(len(grams), dtype=np.uint64)
    high = grams & ~_PLACE
    first = least_within(high | place, width)
    last = least_within(high | (_PLACE - place), width)
    twice = (first & _PLACE) != _PLACE - (last & _PLACE)
    return (first & _PLACE).astype(np.int64), twice


def runs_of(text: bytes, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """First window, number of windows, first digit, and second and third digits of the runs of
    a text. The latter are one number: 32 bits of the run's bytes, 16 of either side.

    Long texts are cut into blocks; a run that ends at a block's border is only found in part,
    which leaves it to the last pass.
    """
    whole, half = np.frombuffer(text, np.uint8), (window - GRAM) // 2
    for begin in range(0, len(text) - window + 1, BLOCK):
        data = whole[begin:begin + BLOCK + window - 1]
        word = words_at(data)
        grams = mixed(word, slice(0, len(data) - GRAM + 1), GRAM)
        anchor, twice = anchors(grams, window)
        # windows without one place for their anchor are together as long as it is the same
        same = np.where(twice, (grams[anchor] | _PLACE).view(np.int64), anchor)
        at = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
        last = np.append(at[1:], len(same)) - 1
        first, size, mine = at + begin, last - at + 1, anchor[at]
        # a polynomial over the hashes of all strings of the run, from running sums
        sums = np.cumsum(grams * _powers(False)[:len(grams)], dtype=np.uint64)
        run = sums[last + window - GRAM] - np.where(at > 0, sums[at - 1], np.uint64(0))
        run = (run * _powers(True)[at] * _ODD[0]) >> np.uint64(32)
        sides = []
        for place, held in ((mine, mine - last <= window - GRAM - half),
                            (mine - half, mine - at >= half)):
            side = mixed(word, np.where(held, place, 0), GRAM + half) >> np.uint64(48)
            side = np.clip(side, 1, _TWICE - 1) * held
            sides.append(np.where(twice[at], _TWICE, side).astype(np.uint64))
        packed = (run << np.uint64(32)) | (sides[0] << np.uint64(16)) | sides[1]
        yield first, size, grams[mine].view(np.int64), packed.view(np.int64)


def ranks(ids: list) -> np.ndarray:
    """The order of the documents' ids, which are pairs of whether it is null and the id."""
    order = {x: i for i, x in enumerate(sorted({x["id"] for x in ids if not x["no"]}))}
    return np.array([len(order) if x["no"] else order[x["id"]] for x in ids], np.int64)


def settle(key: np.ndarray, run: np.ndarray, rank: np.ndarray,
           wide: int | None) -> tuple[np.ndarray, np.ndarray]:
    """What each row is, as far as the rows at hand tell, and rows that mark a key.

    Rows whose key and run a smaller rank has are ``GONE``. Of the others, those of a key with
    more than ``wide`` unlike runs are ``SPREAD``; one of its smallest and one of its largest rank
    mark it for other tasks.
    """
    state, marks = np.full(len(key), OPEN, np.int8), []
    order = np.lexsort((rank, run, key))
    k, r, d = key[order], run[order], rank[order]
    fresh = np.append(True, (k[1:] != k[:-1]) | (r[1:] != r[:-1]))[:len(k)]
    group = np.cumsum(fresh) - 1
    state[order[d > d[fresh][group]]] = GONE
    if wide is not None and len(k):
        keys = np.append(True, k[1:] != k[:-1])
        family = np.cumsum(keys) - 1
        for f in np.flatnonzero(np.bincount(family, fresh) > wide).tolist():
            mine = order[np.searchsorted(family, f):np.searchsorted(family, f, side="right")]
            state[mine[state[mine] == OPEN]] = SPREAD
            marks += [mine[rank[mine].argmin()], mine[rank[mine].argmax()]]
    return state, np.array(marks, np.int64)


def parts_of(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Where the items of each row begin and end, and the fields of all items; nulls become zero."""
    held = column.fill_null([]) if column.null_count else column
    ends = np.cumsum(pc.list_value_length(held).to_numpy(zero_copy_only=False))
    items = held.flatten()
    return np.append(0, ends), {f.name: items.field(i).fill_null(0).to_numpy(zero_copy_only=False)
                                for i, f in enumerate(items.type)}


def joined(doc: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of windows, in order, with those put together that follow on each other."""
    if not len(doc):
        return doc, first, size
    begin = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (first[1:] != (first + size)[:-1])))
    return doc[begin], first[begin], np.add.reduceat(size, begin)


class _Rows:
    """Rows of one batch, collected text by text and settled together."""

    schema = "key long, run long, state byte, first long, size long"

    def __init__(self, batch: pa.RecordBatch, wide: int | None):
        self.batch, self.wide, self.count = batch, wide, 0
        self.rank = ranks(batch.column("_lb_id").to_pylist())
        self.parts: list[tuple] = []

    def add(self, doc: int, first, size, key, run) -> None:
        self.parts.append((np.full(len(first), doc), first, size, key, run))
        self.count += len(first)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            doc, first, size, key, run = map(np.concatenate, zip(*self.parts, strict=True))
            state, marks = settle(key, run, self.rank[doc], self.wide)
            rows = [(doc[marks], first[marks], size[marks], key[marks], np.zeros_like(marks),
                     np.full(len(marks), MARK, np.int8))]
            for kind in (OPEN, GONE, SPREAD):
                mine = state == kind
                part = (doc[mine], first[mine], size[mine])
                keys = (key[mine], run[mine])
                if kind != OPEN:  # settled rows need no key, but should be spread
                    part = joined(*part)
                    keys = (part[0] * 1_000_003 + part[1], np.zeros_like(part[1]))
                rows.append((*part, *keys, np.full(len(part[0]), kind, np.int8)))
            doc, first, size, key, run, state = map(np.concatenate, zip(*rows, strict=True))
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [self.batch.column("_lb_id").take(at), self.batch.column("_lb_text_id").take(at),
                 *map(pa.array, (key, run, state, first, size))],
                ["_lb_id", "_lb_text_id", "key", "run", "state", "first", "size"])
        self.parts, self.count = [], 0


def _run_rows(texts: DataFrame, window: int) -> DataFrame:
    """The runs of all texts, after a first settlement within each batch."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _Rows(batch, WIDE)
            for doc, text in enumerate(batch.column("_lb_text")):
                for first, size, key, run in runs_of(text.as_py(), window):
                    rows.add(doc, first, size, key, run)
                    if rows.count > BLOCK:
                        yield from rows.flush()
            yield from rows.flush()

    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema
                    if f.name != "_lb_text")
    return texts.mapInArrow(build, f"{ids}, {_Rows.schema}")


def _edge_rows(texts: DataFrame, window: int) -> DataFrame:
    """The runs in ``_lb_runs`` that are ``APART``, with their ``body``, and the single windows of
    those that are ``SPREAD``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows = _Rows(batch, None)
            ends, items = parts_of(batch.column("_lb_runs"))
            texts_, doc_of = batch.column("_lb_text"), np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            alone = np.flatnonzero(items["state"] == APART)
            order = alone[np.lexsort((items["first"][alone], doc_of[alone]))]
            bodies, text, at = [], None, -1
            for doc, first, end in zip(doc_of[order].tolist(), items["first"][order].tolist(), (
                    items["first"] + items["size"] + window - 1)[order].tolist(), strict=True):
                if doc != at:
                    text, at = texts_[doc].as_py(), doc
                bodies.append(text[first:end])
            if bodies:
                row, n = pa.array(doc_of[order]), len(order)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_lb_id").take(row), batch.column("_lb_text_id").take(row),
                     pa.array(items["key"][order], pa.int64()), pa.array(np.zeros(n, np.int64)),
                     pa.array(np.full(n, APART, np.int8)), pa.array(items["first"][order], pa.int64()),
                     pa.array(items["size"][order], pa.int64()), pa.array(bodies, pa.binary())], names)
            wide = np.flatnonzero(items["state"] == SPREAD)
            for i in wide[np.lexsort((items["first"][wide], doc_of[wide]))].tolist():
                doc, begin = int(doc_of[i]), int(items["first"][i])
                text, end = texts_[doc].as_py(), begin + int(items["size"][i])
                for low in range(begin, end, BLOCK):
                    high = min(low + BLOCK, end)
                    found = np.frombuffer(b"".join(
                        [digest(text[j:j + window]) for j in range(low, high)]),
                        np.int64).reshape(-1, 2)
                    rows.add(doc, np.arange(low, high), np.ones(high - low, np.int64),
                             found[:, 0], found[:, 1])
                    if rows.count > BLOCK:
                        yield from map(without_body, rows.flush())
            yield from map(without_body, rows.flush())

    def without_body(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.nulls(batch.num_rows, pa.binary())], names)

    names = ["_lb_id", "_lb_text_id", *(f.split()[0] for f in _Rows.schema.split(", ")), "body"]
    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema
                    if f.name in ("_lb_id", "_lb_text_id"))
    return texts.mapInArrow(build, f"{ids}, {_Rows.schema}, body binary")


def _repeated_edges(rows: DataFrame, window: int) -> DataFrame:
    """Of ``_edge_rows`` the windows that a smaller id has, those that follow on each other joined.

    Rows come ordered by key, run and id, so the first of equal windows is the smallest.
    """
    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema
                    if f.name in ("_lb_id", "_lb_text_id"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen = None, {}   # the anchor at hand, and the first id of its windows
        held = None               # the spread window at hand, and its first id
        for batch in batches:
            state, first, size, key, run = (batch.column(c).to_numpy() for c in (
                "state", "first", "size", "key", "run"))
            ids = batch.column("_lb_id")
            gone = np.flatnonzero(state == GONE)
            found = [(gone, first[gone], size[gone])]
            mine = np.flatnonzero(state == APART)
            edges = []
            for i, k, n, ident, body in zip(
                    mine.tolist(), key[mine].tolist(), size[mine].tolist(),
                    ids.take(pa.array(mine)).to_pylist(),
                    batch.column("body").take(pa.array(mine)).to_pylist(), strict=True):
                ident = tuple(ident.values())
                if k != anchor:
                    anchor, seen = k, {}
                edges += [(i, j) for j in range(n)
                          if seen.setdefault(body[j:j + window], ident) != ident]
            at, step = np.array(edges, np.int64).reshape(-1, 2).T
            found.append((at, first[at] + step, np.ones_like(at)))
            mine = np.flatnonzero(state == OPEN)  # spread windows, whose batch did not settle them
            if len(mine):
                k, r = key[mine], run[mine]
                fresh = np.append(True, (k[1:] != k[:-1]) | (r[1:] != r[:-1]))
                group = np.cumsum(fresh) - 1
                least = ids.take(pa.array(mine[fresh]))
                if held is not None and held[:2] == (k[0], r[0]):
                    least = pa.concat_arrays([held[2], least.slice(1)])
                same = [pc.equal(ids.take(pa.array(mine)).field(x), least.take(pa.array(group)).field(x))
                        .fill_null(True).to_numpy(zero_copy_only=False) for x in (0, 1)]
                later = mine[~(same[0] & same[1])]
                found.append((later, first[later], size[later]))
                held = (k[-1], r[-1], least.slice(len(least) - 1))
            at, first, size = joined(*map(np.concatenate, zip(*found, strict=True)))
            row = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), batch.column("_lb_text_id").take(row),
                 pa.array(first), pa.array(size), pa.array(np.full(len(at), GONE, np.int8))],
                ["_lb_id", "_lb_text_id", "first", "size", "state"])

    return rows.repartition("key").sortWithinPartitions("key", "state", "run", "_lb_id").mapInArrow(
        compare, f"{ids}, first long, size long, state byte")


def _runs_by_text(rows: DataFrame, name: str, *more: str) -> DataFrame:
    return rows.groupBy("_lb_id", "_lb_text_id").agg(
        F.collect_set(F.struct("first", "size", "state", *more)).alias(name))


def with_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with ``_lb_text`` (their bytes) and the windows that repeat: arrays of
    ``first`` and ``size`` (and ``state``, of which only ``GONE`` counts), or null."""
    text = plain(docs["text"]).cast("binary")
    texts = docs.select(F.struct(docs["doc_id"].isNull().alias("no"), docs["doc_id"].alias("id"))
                        .alias("_lb_id"), F.xxhash64(text).alias("_lb_text_id"), text.alias("_lb_text"))
    settled = F.col("state").isin(GONE, SPREAD)
    by_key, by_run = (Window.partitionBy("key", "settled", *more) for more in ((), ("run",)))
    rows = (_run_rows(texts, window).withColumn("settled", settled).repartition("key")
            .withColumn("run_first", F.min("_lb_id").over(by_run))
            .withColumn("key_first", F.min("run_first").over(by_key))
            .withColumn("key_last", F.max("run_first").over(by_key))
            .withColumn("marked", F.max(F.col("state") == MARK).over(by_key)))
    known = (F.when(settled, F.col("state"))
             .when(F.col("run_first") < F.col("_lb_id"), GONE)
             .when((F.col("key_first") < F.col("key_last")) & F.col("marked"), SPREAD)
             .when(F.col("key_first") < F.col("key_last"), OPEN))
    rows = rows.filter(F.col("state") != MARK).withColumn("state", known.cast("byte")).filter(
        F.col("state").isNotNull())
    right = F.shiftright("run", 16).bitwiseAND(F.lit(0xFFFF))
    left = F.col("run").bitwiseAND(F.lit(0xFFFF))
    for name, side in (("right", right), ("left", left)):
        rows = rows.withColumn("side", side)
        by_side = Window.partitionBy("key", "state", "side")
        rows = rows.withColumn(name, (F.col("side") != _NONE) & (
            F.min("run_first").over(by_side) < F.max("run_first").over(by_side)))
    of_key = Window.partitionBy("key", "state")
    rows = (rows.withColumn("crowd", (F.count("*").over(of_key) > CROWD)
                            | (F.max("size").over(of_key) > LONG)))
    state = (F.when(F.col("state") != OPEN, F.col("state"))
             .when((F.col("right") | F.col("left")) & F.col("crowd"), SPREAD)
             .when(F.col("right") | F.col("left"), APART))
    runs = cut(rows.withColumn("state", state.cast("byte")).filter(F.col("state").isNotNull())
               .select("_lb_id", "_lb_text_id", "first", "size", "state",
                       F.when(F.col("state") == APART, F.col("key")).alias("key")))
    spread = texts.repartition("_lb_id", "_lb_text_id")
    keys = ["_lb_id", "_lb_text_id"]
    known = spread.join(_runs_by_text(runs, "_lb_runs", "key"), keys, "left")
    edges = known.filter(F.exists("_lb_runs", lambda r: r["state"].isin(APART, SPREAD)))
    windows = _repeated_edges(_edge_rows(edges, window), window)
    return known.join(_runs_by_text(windows, "_lb_windows"), keys, "left")


def kept_bytes(text: bytes, first: np.ndarray, size: np.ndarray,
               window: int) -> tuple[list[bytes], int, int]:
    """The parts of a text outside of repeated windows, the bytes left out, and the spans."""
    order = np.argsort(first, kind="stable")
    begin = first[order]
    end = np.maximum.accumulate(begin + size[order] + window - 1) if len(order) else begin
    fresh = np.flatnonzero(np.append(True, begin[1:] > end[:-1])[:len(begin)])
    starts = begin[fresh].tolist()
    stops = end[np.append(fresh[1:] - 1, len(end) - 1)].tolist() if len(fresh) else []
    parts = [text[a:b] for a, b in zip([0, *stops], [*starts, len(text)], strict=True)]
    return parts, sum(stops) - sum(starts), len(starts)


def _results(known: DataFrame, schema: str, window: int, result) -> DataFrame:
    """A row for each text of ``with_passages``: its id and what ``result`` makes of the parts."""
    names = [x.split()[0] for x in schema.split(", ")]
    id_type = known.schema["_lb_id"].dataType["id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            gone = []
            for name in ("_lb_runs", "_lb_windows"):
                ends, items = parts_of(batch.column(name))
                mine = items["state"] == GONE
                count = np.append(0, np.cumsum(mine))[ends]
                gone.append((count, items["first"][mine], items["size"][mine]))
            for i, text in enumerate(batch.column("_lb_text")):
                body = text.as_py()
                first, size = (np.concatenate([g[k][g[0][i]:g[0][i + 1]] for g in gone]) for k in (1, 2))
                row = result(body, *kept_bytes(body, first, size, window))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_lb_id").field("id"), *map(pa.array, columns)], ["doc_id", *names])

    return known.select("_lb_id", "_lb_text", "_lb_runs", "_lb_windows").mapInArrow(
        build, f"doc_id {id_type}, {schema}")


def remove_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id`` and ``text`` without each byte that a repeated string of ``window`` bytes covers.

    A string is repeated if it also starts in a document with a smaller id; all strings are judged
    on the input. Ids may have any type with an order; a null id comes after all others, so such
    a document loses what others hold and takes nothing from them or its like. Rows of one id are
    one document and take nothing from each other; each row is returned. A null text is empty,
    a text shorter than the window is kept, an empty table gives no rows. A cut inside of a
    character leaves its other bytes out as well, as text must be valid. Other columns are not
    returned. ``window`` is at least twenty bytes.
    """
    return _results(with_passages(docs, window), "text string", window,
                    lambda body, parts, gone, spans: [b"".join(parts).decode("utf-8", "ignore")])


def passage_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of each document, of
    the bytes that ``remove_passages`` leaves."""
    def result(body: bytes, parts: list[bytes], gone: int, spans: int) -> list:
        digest = hashlib.sha256()
        for part in parts:
            digest.update(part)
        return [len(body), gone, spans, digest.hexdigest()]

    return _results(with_passages(docs, window),
                    "n_bytes long, n_removed long, n_spans long, kept_sha256 string", window, result)


_SQL = f"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
windows AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, {2 * WINDOW}) AS w
  FROM (SELECT doc_id, x, unnest(range(0, n - {WINDOW - 1})) AS i FROM docs WHERE n >= {WINDOW})),
gone AS (
  SELECT w.doc_id, i FROM windows w
  JOIN (SELECT w, min(doc_id) AS first FROM windows GROUP BY w) f ON f.w = w.w AND first < w.doc_id),
steps AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {WINDOW}, true) AS fresh
  FROM gone),
islands AS (
  SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM steps),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + {WINDOW} AS b FROM islands GROUP BY doc_id, island),
borders AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM spans),
parts AS (
  SELECT doc_id, string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS head,
    max(b) AS done, sum(b - a) AS removed, count(*) AS spans
  FROM borders JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(done, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN parts USING (doc_id)"""


@query("op12_repeated_passages", _SQL)
def op12_repeated_passages(spark, sf_dir):
    """What is left of each document without the passages of earlier ones."""
    return passage_digests(table(spark, sf_dir, "documents"))
