"""Near copies by exact similarity of word shingles, found through two indexes.

The first is the byte-position index of ``simhash``, over fingerprints of the same shingles: what it
links is checked exactly and grouped. Fingerprints of texts alike at 0.8 may differ in ten bits and
more, so a prefix index that loses none follows; of the pairs that it finds, those that are in one
group already need no check.

All shingles have one order: frequent ones last, the others by hash. Two sets with a similarity
of 0.8 or more share a shingle among the first fifth (and one) of both, whatever the order is;
the frequent ones are guessed from a sample and only keep postings short. Pairs that meet are
held against the bounds of size and position and the parity of their shingles by bucket, none of
which can exceed what 0.8 allows, and then against each other's whole sets.

Postings longer than ``LONG`` come from large groups of near copies. Their members meet
``LEADERS`` of their own first; only what these do not link to a posting's largest group is
paired with all others of the posting.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latebook.llm.components import components
from latebook.llm.simhash import bits_of, links_of, majority
from latebook.llm.text import cut, plain
from latebook.llm.tokens import tidy

SEED = 42
LONG = 64
LEADERS = 8
#: One text of so many is counted; shingles found in ``OFTEN`` of them are frequent, at most
#: ``MOST`` of them (8 bytes each). None of the three changes the result.
SAMPLE = 16
OFTEN = 2
MOST = 500_000
PARITY_BITS = 1024

_CHUNK = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """The hashes of a text's shingles, repeats included; of a shorter text its only one."""
    split = text.encode("utf-8", "replace").translate(_LOWER).split()
    size = min(words, len(split))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(b" ".join(split[i:i + size]), SEED)
                     for i in range(len(split) - size + 1 if size else 0)], np.uint64)


def shingle_set(text: str, words: int) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    return np.unique(shingle_hashes(text, words))


def signature(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set; the empty set is zero."""
    if not len(shingles):
        return 0
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Sorted shingles that several texts of a sample hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in batch.column(0).to_pylist()]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sets).view(np.int64))], ["token"])

    text = plain(docs["text"])
    sample = docs.select(text.alias("text")).filter(F.xxhash64("text") % SAMPLE == 0).distinct()
    counted = sample.mapInArrow(tidy(run), "token long").groupBy("token").agg(F.count("*").alias("c"))
    found = counted.filter(F.col("c") >= OFTEN).orderBy(F.desc("c"), "token").limit(MOST)
    return np.sort(found.select("token").toArrow().column(0).to_numpy().view(np.uint64))


def marked_sets(docs: DataFrame, words: int, often: np.ndarray) -> DataFrame:
    """``doc_id``, ``text_hash`` and, of the shingles, ``sig``, ``n``, ``prefix``, ``parity`` and
    ``fp``, their SimHash."""
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, sig long, "
              "n int, prefix array<long>, parity binary, fp long")

    def row(text: str):
        every = shingle_hashes(text, words)
        counts = sum((bits_of(every[i:i + _CHUNK]) for i in range(0, len(every), _CHUNK)),
                     np.zeros(64, np.int64))
        mine = np.unique(every)
        at = np.searchsorted(often, mine)
        late = np.zeros(len(mine), bool)
        inside = at < len(often)
        late[inside] = often[at[inside]] == mine[inside]
        prefix = np.concatenate([mine[~late], mine[late]])[:len(mine) // 5 + 1]
        odd = np.bincount((mine % PARITY_BITS).astype(np.int64), minlength=PARITY_BITS) & 1
        return (signature(mine), len(mine), prefix.view(np.int64),
                np.packbits(odd.astype(bool)).tobytes(), majority(counts, len(every)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(t) for t in batch.column(2).to_pylist()]
            sig, n, prefix, parity, fp = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sig, pa.int64()),
                 pa.array(n, pa.int32()), pa.array(list(prefix), pa.list_(pa.int64())),
                 pa.array(parity, pa.binary()), pa.array(fp, pa.int64())],
                ["doc_id", "text_hash", "sig", "n", "prefix", "parity", "fp"])

    text = plain(docs["text"])
    return docs.select(docs["doc_id"], F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(tidy(run), schema)


def _can_be_alike(na, pa_, nb, pb):
    """Whether sizes, and the places of the first shingle shared, allow a similarity of 0.8."""
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (5 * np.minimum(na, nb) >= 4 * np.maximum(na, nb)) & (9 * most >= 4 * (na + nb))


def _meetings(long: int):
    """Over rows (token, sig, n, pos) sorted by token: pairs inside short postings as (a, b),
    members of long ones with their token, n and pos and no b."""
    def pairs(token, sig, n, pos):
        live = np.arange(len(token))
        for step in range(1, long):
            live = live[live + step < len(token)]
            live = live[token[live] == token[live + step]]
            if not len(live):
                return
            other = live + step
            good = _can_be_alike(n[live], pos[live], n[other], pos[other])
            yield sig[live[good]], sig[other[good]]

    def batch_of(a, b=None, token=None, n=None, pos=None) -> pa.RecordBatch:
        none = np.full(len(a), None)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(none if b is None else b, pa.int64()),
             pa.array(none if token is None else token, pa.int64()),
             pa.array(none if n is None else n, pa.int32()),
             pa.array(none if pos is None else pos, pa.int32())], ["a", "b", "token", "n", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32)]
        hot = None  # the token of a long posting that has been seen to be one
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                rows, keep = held, len(held[0])
            else:
                rows = [np.concatenate([h, c.to_numpy()])
                        for h, c in zip(held, batch.columns, strict=True)]
                keep = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0
                if len(rows[0]) - keep > long:  # the last posting goes on and is long already
                    hot, keep = int(rows[0][-1]), len(rows[0])
            held = [r[keep:] for r in rows]
            token, sig, n, pos = (r[:keep] for r in rows)
            if not len(token):
                continue
            begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.append(begin, len(token)))
            many = np.repeat(size > long, size)
            if hot is not None:
                many |= token == hot
            if many.any():
                yield batch_of(sig[many], None, token[many], n[many], pos[many])
            for a, b in pairs(token[~many], sig[~many], n[~many], pos[~many]):
                if len(a):
                    yield batch_of(np.minimum(a, b), np.maximum(a, b))

    return run


def _parity_allows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose odd buckets differ in no more than the shingles that 0.8 lets them differ in."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64)
                .reshape(batch.num_rows, -1) for i in (4, 5))
        differ = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
        total = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(9 * differ <= total))


def alike(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """The pairs ``a``, ``b`` of signatures whose sets have a similarity of 0.8 or more."""
    of = [distinct.select(F.col("sig").alias(s), F.col("n").alias(f"n{s}"),
                          F.col("parity").alias(f"p{s}")) for s in "ab"]
    joined = pairs.distinct().join(of[0], "a").join(of[1], "b")
    left = cut(joined.select("a", "b", "na", "nb", "pa", "pb")
               .mapInArrow(_parity_allows, "a long, b long"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = [shingle_set(t, words) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([signature(m) for m in mine], pa.int64()),
                 pa.array([m.view(np.int64) for m in mine], pa.list_(pa.int64()))], ["s", "g"])

    asked = left.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    wanted = distinct.join(asked, "sig").select("text_hash", "sig")
    text = plain(docs["text"])
    texts = docs.select(text.alias("text"), F.xxhash64(text).alias("text_hash"))
    few = texts.join(wanted.select("text_hash"), "text_hash", "left_semi").select("text")
    held = cut(few.dropDuplicates(["text"]).mapInArrow(tidy(sets), "s long, g array<long>")
               .dropDuplicates(["s"]))
    both = (left.join(held.select(F.col("s").alias("a"), F.col("g").alias("ga")), "a")
            .join(held.select(F.col("s").alias("b"), F.col("g").alias("gb")), "b"))
    same = F.size(F.array_intersect("ga", "gb"))
    return both.filter(9 * same >= 4 * (F.size("ga") + F.size("gb"))).select("a", "b")


def fingerprint_links(marked: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of signatures that the byte-position index links: each with the smallest
    of its fingerprint, and the smallest of linked fingerprints with each other."""
    named = marked.select("fp", "sig").distinct()
    least = cut(named.groupBy("fp").agg(F.min("sig").alias("low")))
    of = [least.select(F.col("fp").alias(s), F.col("low").alias(f"low_{s}")) for s in "ab"]
    linked = links_of(least.select("fp")).distinct().join(of[0], "a").join(of[1], "b").select(
        "low_a", "low_b")
    pairs = named.join(least, "fp").select("sig", "low").union(linked).toDF("x", "y")
    return pairs.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that are not in one group yet."""
    of = [groups.select(F.col("node").alias(s), F.col("component").alias(f"g{s}")) for s in "ab"]
    found = pairs.join(of[0], "a", "left").join(of[1], "b", "left")
    return found.filter(F.coalesce(F.col("ga") != F.col("gb"), F.lit(True))).select("a", "b")


def near_copies(docs: DataFrame, words: int, long: int = LONG) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``component`` of every row: rows are linked if the sets of
    their word shingles have a similarity (shared over all) of 0.8 or more.

    Texts without words are alike. Null ids take part and repeated rows stay. Reads ``doc_id``
    and ``text`` only. No rows give no rows.
    """
    marked = cut(marked_sets(docs, words, frequent(docs, words)))
    distinct = cut(marked.groupBy("sig").agg(
        F.min("text_hash").alias("text_hash"), F.first("n").alias("n"),
        F.first("parity").alias("parity"), F.first("prefix").alias("prefix")))
    posted = (distinct.select("sig", "n", F.posexplode("prefix").alias("pos", "token"))
              .select("token", "sig", "n", "pos")
              .repartition("token").sortWithinPartitions("token"))
    met = cut(posted.mapInArrow(tidy(_meetings(long)), "a long, b long, token long, n int, pos int"))
    short = met.filter("b is not null").select("a", "b")
    crowd = met.filter("b is null").select("token", F.col("a").alias("sig"), "n", "pos")
    order = [F.xxhash64("sig", F.lit(k)) for k in range(LEADERS)]
    leaders = crowd.groupBy("token").agg(F.array_distinct(F.array(
        *[F.min_by("sig", o) for o in order])).alias("leaders"))
    led = (crowd.join(leaders, "token").select("sig", F.explode("leaders").alias("l"))
           .filter("sig <> l").select(F.least("sig", "l").alias("a"), F.greatest("sig", "l").alias("b")))
    first = cut(alike(cut(fingerprint_links(marked)), distinct, docs, words))
    more = apart(short.union(led).distinct(), components(first))
    links = cut(first.union(alike(more, distinct, docs, words)))
    groups = components(links)
    rest = cut(_unled(crowd, groups))
    if not rest.isEmpty():
        groups = components(links.union(alike(rest, distinct, docs, words)))
    named = marked.join(groups, marked["sig"] == F.col("node"), "left")
    return named.select("doc_id", "text_hash", F.coalesce("component", "sig").alias("component"))


def _unled(crowd: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs inside long postings that are in different groups so far; of a posting's largest
    group no two members are paired."""
    placed = cut(crowd.join(groups, crowd["sig"] == groups["node"], "left")
                 .select("token", "sig", "n", "pos", F.coalesce("component", "sig").alias("g")))
    sizes = placed.groupBy("token", "g").agg(F.count("*").alias("c"))
    main = sizes.groupBy("token").agg(F.max_by("g", F.struct("c", "g")).alias("main"))
    x = placed.join(main, "token").filter("g <> main").drop("main").alias("x")
    y = placed.alias("y")
    most = 1 + F.least(F.expr("x.n - x.pos - 1"), F.expr("y.n - y.pos - 1"))
    return (x.join(y, F.expr("x.token = y.token and x.g <> y.g")
                   & (5 * F.least("x.n", "y.n") >= 4 * F.greatest("x.n", "y.n"))
                   & (9 * most >= 4 * F.expr("x.n + y.n")))
            .select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")))


def one_of_each(docs: DataFrame, words: int, long: int = LONG) -> DataFrame:
    """One document of each component of near copies, with all columns: that of the smallest id
    (a null one comes last), of several texts with that id the one of the least hash, and of
    rows that agree in both the one whose other columns have the least hash. So every component
    keeps a row, whatever ids its rows share with those of others."""
    found = near_copies(docs, words, long)
    ident = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"))
    first = found.groupBy("component").agg(
        F.min(F.struct(ident.alias("id"), F.col("text_hash").alias("hash"))).alias("f")).select(
        F.col("f.id").alias("_lb_first"), F.col("f.hash").alias("_lb_of"))
    mine = docs.withColumns({"_lb_id": ident, "_lb_hash": F.xxhash64(plain(docs["text"]))})
    kept = mine.join(first, (mine["_lb_id"] == first["_lb_first"])
                     & (mine["_lb_hash"] == first["_lb_of"]), "left_semi")
    order = Window.partitionBy("_lb_id", "_lb_hash").orderBy(F.xxhash64(*docs.columns))
    return (kept.withColumn("_lb_n", F.row_number().over(order)).filter("_lb_n = 1")
            .select(*docs.columns))
