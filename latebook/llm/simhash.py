"""SimHash near-duplicates found through an inverted index of byte positions.

Two 64-bit fingerprints with at most four differing bits share at least four of their eight
bytes in place. The index posts every distinct fingerprint under its bytes at each choice of
``POSITIONS`` places, so that postings stay short. Inside a posting the shared bytes of each pair
are tallied, pairs that reach the guaranteed minimum are kept and verified bit by bit, each at
the first posting that it shares.

Members of postings longer than ``LONG`` are posted again under one place more, which pairs within
the distance share as well. Postings that are long even so come from large groups of near copies.
Their members are linked without any pairs: each emits all fingerprints within half the distance
of itself; two of them are within the distance if and only if they meet in one of those, and all
that meet there are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebook.llm.components import components
from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain

#: Fixed by the result contract.
SEED = 42
DISTANCE = 4
WORDS = 4
#: Bytes of a posting's key; with three, sixteen million fingerprints meet by chance once each.
POSITIONS = 3
LONG = 128

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 16


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(0, dtype=np.int64)


def majority(counts: np.ndarray, n: int) -> int:
    """The bits that over half of ``n`` hashes have, as a signed number; zero without any."""
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0]) if n else 0


def fingerprint(text: str, words: int = WORDS) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit number."""
    split = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not split:
        return 0
    joined = b" ".join(split)
    stops = np.cumsum([len(w) + 1 for w in split])
    starts = [0, *stops[:-1].tolist()]
    ends = (stops - 1).tolist()
    size = min(words, len(split))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    n = len(split) - size + 1
    for begin in range(0, n, _CHUNK):
        stop = min(begin + _CHUNK, n)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[begin:stop], ends[begin + size - 1:stop + size - 1], strict=True)], "<u8")
        counts += bits_of(hashes)
    return majority(counts, n)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp`` for every row; a null text counts as empty, which has zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())],
                                             ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], plain(docs["text"]).alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp long")


def _pairs(distance: int, long: int, positions: int):
    """Over rows (key, fp) sorted by key: links inside short postings, members of long ones."""
    shared_least = 8 - distance
    places = 8 ** np.arange(positions)[::-1]

    def links(key: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of short postings, by their distance in the list."""
        live = np.arange(len(key))
        for step in range(1, long):
            live = live[live + step < len(key)]
            live = live[key[live] == key[live + step]]
            if not len(live):
                return
            a, b = fp[live], fp[live + step]
            other = (a ^ b)
            same = other.view(np.uint8).reshape(-1, 8) == 0
            # the tally of shared bytes, then the first posting they share, then every bit
            first = np.argsort(~same, axis=1, kind="stable")[:, :positions] @ places
            good = ((same.sum(1) >= shared_least) & (first == key[live] >> (8 * positions))
                    & (np.bitwise_count(other.view(np.uint64)) <= distance))
            yield a[good], b[good]

    def split(key, fp):
        """Rows of short postings, fingerprints of long ones."""
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        in_long = np.repeat(size > long, size)
        return key[~in_long], fp[~in_long], fp[in_long]

    def batch_of(a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key = held_fp = np.zeros(0, np.int64)
        hot = None  # the key of a long posting that has been seen to be one
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                key, fp, keep = held_key, held_fp, len(held_key)
            else:
                key = np.concatenate([held_key, batch.column(0).to_numpy()])
                fp = np.concatenate([held_fp, batch.column(1).to_numpy()])
                keep = int(np.searchsorted(key, key[-1])) if len(key) else 0
                if len(key) - keep > long:  # the last posting goes on and is long already
                    hot, keep = int(key[-1]), len(key)
            held_key, held_fp = key[keep:], fp[keep:]
            key, fp = key[:keep], fp[:keep]
            if not len(key):
                continue
            if hot is not None:
                mine = key == hot
                yield batch_of(fp[mine], np.full(mine.sum(), None))
                key, fp = key[~mine], fp[~mine]
            if len(key):
                key, fp, many = split(key, fp)
                if len(many):
                    yield batch_of(many, np.full(len(many), None))
                for a, b in links(key, fp):
                    if len(a):
                        yield batch_of(a, b)

    return run


def _posted(distinct: DataFrame, distance: int, long: int, positions: int) -> DataFrame:
    """Links ``a``, ``b`` inside the short postings of so many places, members of long ones."""
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    keys = []
    for at in itertools.combinations(range(8), positions):
        key = F.lit(sum(x * 8 ** (positions - 1 - i) for i, x in enumerate(at))).cast("long")
        for x in at:
            key = key * 256 + byte[x]
        keys.append(key)
    posted = (distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")
              .repartition("key").sortWithinPartitions("key", "fp"))
    return cut(posted.mapInArrow(_pairs(distance, long, positions), "a long, b long"))


def links_of(distinct: DataFrame, distance: int = DISTANCE, long: int = LONG) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` whose components are those of all
    pairs at most ``distance`` bits apart."""
    fp = F.col("fp")
    found = _posted(distinct, distance, long, POSITIONS)
    near = found.filter("b is not null")
    crowded = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    if POSITIONS < 8 - distance:
        found = _posted(crowded, distance, long, POSITIONS + 1)
        near = near.union(found.filter("b is not null"))
        crowded = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    half = distance // 2
    masks = [sum(1 << i for i in bits) for k in range(half + 1)
             for bits in itertools.combinations(range(64), k)]
    masks = F.lit([m - (1 << 64) if m >= 1 << 63 else m for m in masks])
    met = (crowded.withColumn("mask", F.explode(masks))
           .select("fp", fp.bitwiseXOR(F.col("mask")).alias("centre")))
    least = met.groupBy("centre").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    ball = (met.join(least.filter("low < high").select("centre", "low"), "centre")
            .filter("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct())
    return near.union(ball)


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest ``doc_id`` reachable) of every row.

    Rows of equal fingerprint are linked, whatever their texts; those without words have zero.
    Null ids take part and are never the smallest, unless a component has no other (then null).
    Repeated rows stay. Reads ``doc_id`` and ``text`` only. No rows give no rows.
    """
    marked = cut(fingerprints(docs, words))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    groups = components(links_of(distinct.select("fp")))
    named = (distinct.join(groups, distinct["fp"] == groups["node"], "left")
             .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    named = cut(named)
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_fp = named.join(least, "component").select("fp", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "fp", "component_id")


@query("op3_simhash_bytes")
def op3_simhash_bytes(spark, sf_dir):
    """Fingerprints and components of all documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
