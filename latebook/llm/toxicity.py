"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of rows that hashes choose: two of the whole word, so that only
words which share both look alike, and one each of its first three, four and five characters, so
that words of one stem look alike in part. Filters of several widths slide over the words, each keeps its largest
response in the text, and a logistic layer joins them.

The model learns from every labelled row that may be learnt from. The rows are dealt to shards by the
hash of their id; in each round a task descends over the rows of a shard, beginning with the model of
the round before, and the next model is the mean of what the shards changed. Sums are taken in fixed
point, so they do not depend on their order. Only the model, whose size is fixed, and counts by grid
point of the score come to the driver.
"""

from __future__ import annotations

import copy
import string
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain, shuffles_released
from latebook.llm.tokens import slices, tidy

#: Labelled rows of a shard, at least, and shards at most; beyond that shards grow.
SHARD_ROWS = 2000
SHARDS = 128
#: Texts of a step of the descent, and one part of so many whose rows are kept for the calibration.
BATCH = 32
CHECKED = 5
#: Points of the grid on which the logits of these rows are counted, for each unit.
GRID = 256
#: Parts of a unit in which sums over shards are taken.
POINT = 1 << 32
#: The score at and above which a text counts as toxic; fixed by the result contract.
CUT = 0.7
BUCKETS = 1 << 16
PREFIXES = (3, 4, 5)
SIDES = 2 + len(PREFIXES)
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 4
#: How many of the largest responses of a filter count: one toxic word may stand in any text.
POOLED = 3
#: Characters that are read together, and places at which filters respond together.
STEP = 1_000_000
PLACES = 1 << 16

_KEEP = (string.ascii_lowercase + string.digits).encode()
#: Bytes of words: letters and digits in lower case, and all that is not ASCII.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or c in _KEEP else 32 for c in range(256))
#: CRC-32 registers, begun at zero, after one byte; words of more bytes than ``LONGEST`` go one by one.
_CRC = np.array([zlib.crc32(bytes([c]), 0xFFFFFFFF) ^ 0xFFFFFFFF for c in range(256)], np.uint32)
LONGEST = 64


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Words:
    """Texts as numbers: distinct words and, text after text, which of them follow each other.

    Texts are kept apart by as many gaps (index 0) as the widest filter reaches over; an empty
    text has one place of its own.
    """
    hashes: np.ndarray   # (distinct, SIDES), row 0 is the gap's and unused
    at: np.ndarray       # index of each place
    starts: np.ndarray   # first place of each text
    own: np.ndarray      # whether a place is a text's and no gap


def hashed(words: pa.LargeBinaryArray) -> np.ndarray:
    """``SIDES`` buckets of each word: of its CRC-32 from two seeds, and of its prefixes'.

    All words are read together, a byte at a time, in one register that begins at zero; what a seed
    adds to a checksum depends on the length alone.
    """
    found = np.zeros((len(words), SIDES), np.int64)
    if not len(words):
        return found
    offsets, data = (np.frombuffer(b, t) for b, t in zip(words.buffers()[1:], (np.int64, np.uint8), strict=True))
    begin, size = offsets[:len(words)], np.diff(offsets[:len(words) + 1])
    order = np.argsort(-size, kind="stable")  # those that go on come first
    begin, size = begin[order], size[order]
    register, letters = np.zeros(len(words), np.uint32), np.zeros(len(words), np.int64)
    of = {n: np.zeros(len(words), np.uint32) for n in PREFIXES}
    upto = {n: np.zeros(len(words), np.int64) for n in PREFIXES}
    for j in range(min(int(size[0]), LONGEST)):
        live = slice(int(np.searchsorted(-size, -j)))
        byte = data[begin[live] + j]
        register[live] = _CRC[(register[live] ^ byte) & 255] ^ (register[live] >> 8)
        if j < 4 * max(PREFIXES):  # bytes of so many characters at most
            letters[live] += (byte & 0xC0) != 0x80
            for n in PREFIXES:
                inside = letters[live] <= n
                np.copyto(of[n][live], register[live], where=inside)
                upto[n][live] += inside

    def seeded(register: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
        zeros = np.array([zlib.crc32(bytes(k), seed) for k in range(LONGEST + 1)], np.uint32)
        return (register ^ zeros[np.minimum(size, LONGEST)]) % BUCKETS

    for side, seed in enumerate((1, 2)):
        found[order, side] = seeded(register, size, seed)
        for i in order[size > LONGEST]:
            found[i, side] = zlib.crc32(words[int(i)].as_buffer(), seed) % BUCKETS
    for side, n in enumerate(PREFIXES, 2):
        found[order, side] = seeded(of[n], upto[n], n)
    return found


def read_words(texts: list[str]) -> Words:
    gap = max(WIDTHS) - 1
    coded = [t.encode("utf-8", "replace") for t in texts]
    stops = np.cumsum([len(c) + 1 for c in coded], dtype=np.int64)
    flat = np.frombuffer(b"".join([b" ", *(c + b" " for c in coded)]).translate(_TABLE), np.uint8)
    inside = flat != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # words begin and end in turn
    offsets = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])])
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets), pa.py_buffer(flat[inside])]).dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    hashes = np.concatenate([np.zeros((1, SIDES), np.int64), hashed(flat.dictionary)])
    count = np.diff(np.searchsorted(edges[::2], stops), prepend=0)
    starts = np.cumsum(np.maximum(count, 1) + gap) - np.maximum(count, 1) - gap
    at = np.zeros(int((np.maximum(count, 1) + gap).sum()), np.int64)
    at[np.arange(len(codes)) + np.repeat(starts - np.cumsum(count) + count, count)] = codes
    own = np.zeros(len(at) + 1, np.int64)
    np.add.at(own, starts, 1)
    np.add.at(own, starts + np.maximum(count, 1), -1)
    return Words(hashes, at, starts, np.cumsum(own)[:-1] > 0)


@dataclass
class Model:
    """Weights, and the decision thresholds by language (``None`` holds for all others)."""
    rows: np.ndarray                # (SIDES, BUCKETS, DIM)
    filters: dict[int, np.ndarray]  # width: (width, DIM, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    offset: float
    thresholds: dict[str | None, float] = field(default_factory=lambda: {None: CUT})

    @classmethod
    def fresh(cls, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        model = cls(normal(SIDES, BUCKETS, DIM, scale=0.01),
                    {w: normal(w, DIM, FILTERS, scale=0.1) for w in WIDTHS},
                    {w: np.full(FILTERS, -0.3, np.float32) for w in WIDTHS},
                    normal(len(WIDTHS), POOLED, FILTERS, scale=0.1), -1.0)
        for k, w in enumerate(WIDTHS):  # one filter of each width starts on the first dimension
            model.filters[w][:, 0, 0] = 1
            model.out[k, :, 0] = 1 / POOLED
        return model

    def vectors(self, words: Words) -> np.ndarray:
        total = sum(self.rows[side][words.hashes[:, side]] for side in range(SIDES))
        total[0] = 0
        return total

    def responses(self, words: Words, vectors: np.ndarray) -> dict[int, np.ndarray]:
        """For each width the response of its filters at every place."""
        found = {}
        for width in WIDTHS:
            total = np.zeros((len(words.at), FILTERS), np.float32)
            for j in range(width):  # what a distinct word adds is computed once
                adds = vectors @ self.filters[width][j]
                total[:len(words.at) - j] += adds[words.at[j:]]
            total[~words.own] = -np.inf
            found[width] = total
        return found

    def pooled(self, words: Words) -> np.ndarray:
        """The largest responses of each filter to each text, one width and ``PLACES`` places at a
        time: (texts, widths, POOLED, filters)."""
        vectors, features = self.vectors(words), []
        for width in WIDTHS:
            adds = [vectors @ self.filters[width][j] for j in range(width)]
            top = np.full((len(words.starts), POOLED, FILTERS), -np.inf)
            for begin in range(0, len(words.at), PLACES):
                stop = min(begin + PLACES, len(words.at))
                total = adds[0][words.at[begin:stop]]
                for j in range(1, width):
                    later = words.at[begin + j:stop + j]
                    total[:len(later)] += adds[j][later]
                total[~words.own[begin:stop]] = -np.inf
                first = np.searchsorted(words.starts, begin, side="right") - 1
                inside = words.starts[first + 1:np.searchsorted(words.starts, stop)] - begin
                here = slice(first, first + 1 + len(inside))
                both = np.concatenate([top[here], largest(total, np.append(0, inside))[1]], 1)
                top[here] = -np.sort(-both, axis=1)[:, :POOLED]
            features.append(np.maximum(top + self.bias[width], 0))
        return np.stack(features, 1)

    def logits(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return np.einsum("twkf,wkf->t", self.pooled(read_words(texts)), self.out) + self.offset

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -40, 40)))


def largest(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each column's values from start to start the places of the ``POOLED`` largest, in order,
    and these values; where there are fewer, minus infinity."""
    at = np.empty((len(starts), POOLED, values.shape[1]), np.int64)
    top = np.empty(at.shape, values.dtype)
    columns, column = np.ascontiguousarray(values.T), np.arange(values.shape[1])
    for k, (begin, stop) in enumerate(zip(starts, np.append(starts[1:], len(values)), strict=True)):
        mine = columns[:, begin:stop].copy()
        for i in range(POOLED):
            at[k, i] = mine.argmax(1)
            top[k, i] = mine[column, at[k, i]]
            mine[column, at[k, i]] = -np.inf
    return at + np.asarray(starts)[:, None, None], top


def bucket_counts(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """For each class, hash and bucket the texts that hold it."""
    def distinct(values: np.ndarray) -> np.ndarray:
        values = np.sort(values)
        return values[np.diff(values, prepend=-1) > 0]

    counts = np.zeros(2 * SIDES * BUCKETS, np.int64)
    words = read_words(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(words.starts, append=len(words.at)))
    text, word = np.divmod(distinct((text * len(words.hashes) + words.at)[words.at > 0]),
                           len(words.hashes))
    for side in range(SIDES):
        held = distinct(text * BUCKETS + words.hashes[word, side])
        np.add.at(counts, (labels[held // BUCKETS] * SIDES + side) * BUCKETS + held % BUCKETS, 1)
    return counts.reshape(2, SIDES, BUCKETS)


def contrast(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each hash and each bucket, how much more often toxic texts hold it: the difference
    of the two shares over its standard error, so that buckets of rare words stay near zero."""
    share = (counts[0] + counts[1] + 1) / (n.sum() + 2)
    error = np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    return (counts[1] / n[1] - counts[0] / n[0]) / error


class Descent:
    """Gradient descent on the logistic loss; only the places that were pooled pass it on.

    Filters and the logistic layer take AdaGrad's steps. Words take plain ones, so that a word
    moves as far as the texts that hold it agree, and one that few texts hold hardly at all;
    their first dimension starts from ``contrast``.
    """

    def __init__(self, model: Model, rate: float = 0.05, word_rate: float = 0.3):
        self.model, self.rate, self.word_rate = model, rate, word_rate
        self.parts: dict[str, np.ndarray] = {"out": model.out}
        for w in WIDTHS:
            self.parts[f"f{w}"], self.parts[f"b{w}"] = model.filters[w], model.bias[w]
        self.seen = {k: np.full(v.shape, 1e-3, np.float32) for k, v in self.parts.items()}
        self.seen_offset = 1e-3

    def step(self, words: Words, labels: np.ndarray) -> None:
        model = self.model
        vectors = model.vectors(words)
        found = model.responses(words, vectors)
        best, features = {}, []
        for w in WIDTHS:  # (texts, POOLED, filters)
            best[w], top = largest(found[w], words.starts)
            features.append(np.maximum(top + model.bias[w], 0))
        x = np.stack(features, 1)
        z = np.einsum("twkf,wkf->t", x, model.out) + model.offset
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error = ((p - labels) / len(labels)).astype(np.float32)
        back = error[:, None, None, None] * model.out[None] * (x > 0)
        gathered = np.zeros((len(words.hashes), DIM), np.float32)
        changes = []
        for k, w in enumerate(WIDTHS):
            g = back[:, k]
            df = np.zeros_like(model.filters[w])
            for j in range(w):
                place = np.minimum(best[w] + j, len(words.at) - 1)
                ids = words.at[place]
                df[j] = np.einsum("tkfd,tkf->df", vectors[ids], g)
                np.add.at(gathered, ids.ravel(), (
                    g[..., None] * model.filters[w][j].T).reshape(-1, DIM))
            changes += [(f"f{w}", df), (f"b{w}", g.sum((0, 1)))]
        touched = np.flatnonzero(np.abs(gathered).sum(1) > 0)
        touched = touched[touched > 0]
        changes.append(("out", np.einsum("twkf,t->wkf", x, error)))
        for name, gradient in changes:
            self.seen[name] += gradient * gradient
            self.parts[name] -= self.rate * gradient / np.sqrt(self.seen[name])
        for side in range(SIDES):
            np.add.at(model.rows[side], words.hashes[touched, side],
                      -self.word_rate * gathered[touched])
        slope = float(error.sum())
        self.seen_offset += slope * slope
        model.offset -= self.rate * slope / np.sqrt(self.seen_offset)

    def numbers(self) -> np.ndarray:
        """All that a round changes, as rows of ``DIM``: those of words, then everything else."""
        rest = np.concatenate([*(x.ravel() for x in (*self.parts.values(), *self.seen.values())),
                               [self.model.offset, self.seen_offset]])
        rest = np.append(rest, np.zeros(-len(rest) % DIM))
        return np.concatenate([self.model.rows.reshape(-1, DIM), rest.reshape(-1, DIM)])

    def put(self, numbers: np.ndarray) -> None:
        """Take over what ``numbers`` gave."""
        words = SIDES * BUCKETS
        self.model.rows[:] = numbers[:words].reshape(self.model.rows.shape)
        rest, at = numbers[words:].ravel(), 0
        for x in (*self.parts.values(), *self.seen.values()):
            x[:] = rest[at:at + x.size].reshape(x.shape)
            at += x.size
        self.model.offset, self.seen_offset = float(rest[at]), float(rest[at + 1])


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH) -> Model:
    """The descent over texts at hand, without Spark."""
    descent, rng = Descent(Model.fresh()), np.random.default_rng(11)
    n = np.bincount(labels, minlength=2)
    descent.model.rows[:, :, 0] += contrast(bucket_counts(texts, labels), n).astype(np.float32) / 50
    order = rng.permutation(len(texts))
    batches = [order[i:i + batch] for i in range(0, len(order), batch)]
    read = [read_words([texts[i] for i in mine]) for mine in batches]
    for _ in range(epochs):
        for number in rng.permutation(len(batches)):
            descent.step(read[number], labels[batches[number]])
    return descent.model


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, langs: list[str | None],
              weights: np.ndarray) -> None:
    """Shift the logits so that the best border between the classes lies at ``CUT``, then set a
    threshold for each language that has both classes, all from rows the fit has not seen.

    A border's cost is the weighted count of errors; among equal ones the middle of the widest
    gap wins, so that a language with cleanly parted classes keeps room on either side.
    """
    at = border(logits, labels, weights)
    model.offset += float(np.log(CUT / (1 - CUT)) - at)
    scores = 1 / (1 + np.exp(-np.clip(logits - at + np.log(CUT / (1 - CUT)), -40, 40)))
    model.thresholds = {None: CUT}
    for lang in {x for x in langs if x is not None}:
        own = np.array([x == lang for x in langs])
        if len(set(labels[own])) == 2 and weights[own].sum() >= 50:
            cost = ((scores[own] >= CUT) != labels[own]) @ weights[own]
            cut = border(logits[own] - at, labels[own], weights[own])
            moved = 1 / (1 + np.exp(-(cut + np.log(CUT / (1 - CUT)))))
            better = ((scores[own] >= moved) != labels[own]) @ weights[own] < cost
            model.thresholds[lang] = float(moved) if better else CUT


def border(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The logit between the two classes with the least weight of errors."""
    order = np.argsort(logits, kind="stable")
    z, y, w = logits[order], labels[order], weights[order]
    below = np.concatenate([[0], np.cumsum(w * (y == 1))])      # positives left below
    above = np.concatenate([np.cumsum((w * (y == 0))[::-1])[::-1], [0]])
    cost = below + above
    edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    middle, gap = (edges[:-1] + edges[1:]) / 2, np.diff(edges)
    best = np.flatnonzero(cost <= cost.min() + 1e-9)
    return float(middle[best[np.argmax(gap[best])]])


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The text, language and class of all labelled ids that may be learnt from; conflicting labels
    count as toxic, and of repeated ids one row stays. ``_lb_part`` 0 is kept for the calibration."""
    classes = (labels.filter(labels["doc_id"].isNotNull() & labels["toxic"].isNotNull()
                             & ~held_out(labels["doc_id"]))
               .groupBy(labels["doc_id"].alias("_lb_id"))
               .agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    first = F.min(F.struct(plain(docs["text"]).alias("text"), docs["lang"].alias("lang")))
    rows = (docs.select(docs["doc_id"].alias("_lb_id"), docs["text"], docs["lang"])
            .join(classes, "_lb_id"))
    named = F.xxhash64("_lb_id")
    return (rows.groupBy("_lb_id", "toxic").agg(first.alias("first"))
            .select("toxic", "first.*", named.alias("_lb_order"), "_lb_id",
                    F.pmod(named, F.lit(CHECKED)).alias("_lb_part")))


def _counted(rows: DataFrame) -> np.ndarray:
    """``bucket_counts`` of all rows, each task's counted before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIDES * BUCKETS), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                counts += bucket_counts(part.column("text").to_pylist(),
                                        part.column("toxic").to_numpy()).reshape(2, -1)
        key = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, (key, *counts[:, key]))), ["key", "n0", "n1"])

    with shuffles_released(rows.sparkSession):  # a row for each bucket of the model at most
        found = (rows.select("text", "toxic").mapInArrow(tidy(run), "key long, n0 long, n1 long")
                 .groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    counts = np.zeros((2, SIDES * BUCKETS), np.int64)
    for label, name in enumerate(("n0", "n1")):
        counts[label, found.column("key").to_numpy()] = found.column(name).to_numpy()
    return counts.reshape(2, SIDES, BUCKETS)


@contextmanager
def _sent(spark: SparkSession, model: Model | Descent) -> Iterator[Broadcast]:
    """What every task reads, until the driver and the executors drop it at the end."""
    held = spark.sparkContext.broadcast(model)
    try:
        yield held
    finally:
        held.destroy()


def _round(rows: DataFrame, descent: Descent) -> None:
    """One descent over the rows of every shard, and the mean of what those that moved a number
    have changed. Rows come ordered within their shard, so that a repeated task finds the same."""
    def change(mine: Descent) -> pa.RecordBatch:
        before = sent.value.numbers()
        moved = np.rint((mine.numbers() - before) * POINT).astype(np.int64)
        key = np.flatnonzero(moved.any(1))
        return pa.RecordBatch.from_arrays(
            [pa.array(key), *map(pa.array, np.ascontiguousarray(moved[key].T))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, mine, held = None, None, ([], [])

        def learn() -> None:
            if held[0]:
                mine.step(read_words(held[0]), np.array(held[1]))
                held[0].clear()
                held[1].clear()

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                for here, text, toxic in zip(*(part.column(c).to_pylist() for c in (
                        "_lb_shard", "text", "toxic")), strict=True):
                    if here != shard:
                        if mine is not None:
                            learn()
                            yield change(mine)
                        shard, mine = here, copy.deepcopy(sent.value)
                    held[0].append(text)
                    held[1].append(toxic)
                    if len(held[0]) == BATCH:
                        learn()
        if mine is not None:
            learn()
            yield change(mine)

    names = ["key", *(f"d{i}" for i in range(DIM))]
    spark = rows.sparkSession
    with _sent(spark, descent) as sent, shuffles_released(spark):
        ordered = rows.repartition("_lb_shard").sortWithinPartitions("_lb_shard", "_lb_order", "_lb_id")
        # a row for each row of the model at most, in the model's precision
        found = (ordered.select("_lb_shard", "text", "toxic")
                 .mapInArrow(tidy(run), ", ".join(f"{n} long" for n in names)).groupBy("key")
                 .agg(*[(F.sum(n) / F.count("*") / POINT).cast("float").alias(n) for n in names[1:]])
                 .withColumn("key", F.col("key").cast("int")).toArrow())
    after = descent.numbers()
    key = found.column("key").to_numpy()
    for i, name in enumerate(names[1:]):
        after[key, i] += found.column(name).to_numpy()
    descent.put(after)


def _grid(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
    """Logits, classes, languages and counts of rows, by language and grid point."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, done = batch.select(["lang", "toxic"]), 0
            for part in slices(batch.column("text").to_pylist(), STEP):
                points = np.rint(np.clip(sent.value.logits(part), -40, 40) * GRID).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(done, len(part)).columns, pa.array(points)], ["lang", "toxic", "at"])
                done += len(part)

    spark = rows.sparkSession
    with _sent(spark, model) as sent, shuffles_released(spark):
        found = (rows.select("lang", "toxic", "text").mapInArrow(tidy(run), "lang string, toxic int, at long")
                 .groupBy("lang", "toxic", "at").agg(F.count("*").alias("n")).orderBy("lang", "toxic", "at")
                 .collect())  # at most 80 points of the grid a unit, by language and class
    return (np.array([r["at"] / GRID for r in found]), np.array([r["toxic"] for r in found]),
            [r["lang"] for r in found], np.array([float(r["n"]) for r in found]))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled rows that may be learnt from but for a fifth, which calibrates.

    Unless both parts hold rows of both classes the model scores 0.5 for every text.
    """
    rows = cut(learnable(docs, labels))
    counts = {(r["checked"], r["toxic"]): r["n"] for r in rows.groupBy(
        (F.col("_lb_part") == 0).alias("checked"), "toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 4:
        model = Model.fresh()
        model.out[:], model.offset = 0, 0.0
        return model
    n = np.array([counts[False, label] for label in (0, 1)])
    shards = min(SHARDS, max(1, int(n.sum()) // SHARD_ROWS))
    learnt = rows.filter("_lb_part <> 0").withColumn(
        "_lb_shard", F.pmod(F.xxhash64("_lb_id", F.lit("shard")), F.lit(shards)))
    descent = Descent(Model.fresh())
    descent.model.rows[:, :, 0] += contrast(_counted(learnt), n).astype(np.float32) / 50
    for number in range(EPOCHS):
        _round(learnt.withColumn("_lb_order", F.xxhash64("_lb_id", F.lit(number))), descent)
    model = descent.model
    calibrate(model, *_grid(rows.filter("_lb_part = 0"), model))
    return model


def score_texts(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The documents with ``column``: their score (0 to 1), which depends on the text alone.

    All other columns pass through, one of that name is replaced. An empty or null text has the
    score of no words; repeated rows each have theirs. A task holds ``STEP`` characters or one
    text at a time.
    """
    kept = docs.drop(column)
    schema = kept.schema.add(column, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([f.name for f in batch.schema if f.name != "_lb_text"])
            texts, done = batch.column("_lb_text").to_pylist(), 0
            for part in slices(texts, STEP):
                rows = rest.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(model.scores(part))], [*rows.schema.names, column])

    return kept.withColumn("_lb_text", plain(kept["text"])).mapInArrow(tidy(run), schema)


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score stays below the threshold of their language, all columns.

    A null or unknown language has the common threshold, ``CUT``; null and empty texts have the
    score of no words; repeated rows stay or go together; without rows there are none.
    """
    model = train(docs, labels)
    threshold = F.lit(model.thresholds[None])
    for lang, value in sorted((k, v) for k, v in model.thresholds.items() if k is not None):
        threshold = F.when(F.col("lang") == lang, value).otherwise(threshold)
    scored = score_texts(docs, model, "_lb_score")
    return scored.filter(F.col("_lb_score") < threshold).select(*docs.columns)


@query("op10_toxicity_cnn")
def op10_toxicity_cnn(spark, sf_dir):
    """Toxicity scores of all documents, learnt from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
