"""Phrase collocations by stripes: each prefix keys an associative counter of its next words.

A stripe is one row: a language, a prefix of up to three words, the next words with spaces between
them, and how often each follows, as 32-bit numbers. Tasks build the stripes of a slice of texts, the shuffle brings equal prefixes
together and their counters are added elementwise. One level is one pass over the texts: the empty
prefix counts words, a one-word prefix counts pairs, and so on. A phrase can only be frequent if
the two phrases one word shorter inside it are, so a level drops what its predecessor's frequent
phrases rule out: a bitmap of their hashes, of bounded size, lets through all of them and perhaps
others, whose counts then show what they are. Results do not depend on its size.

From the merged stripes come a phrase's extensions (a prefix's entries), the totals of all its
prefixes and suffixes (carried from level to level) and the most frequent phrase one word longer
that holds it; any longer phrase is no more frequent than that one, so it decides subsumption.

The stripes of prefixes made of very common words only, and of the empty one, are split by a hash of
the next word (``PARTS``), so that their counters are spread over tasks. A stripe comes to its task
at most once a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain

#: Fixed by the result contract.
LEAST = 30
LONGEST = 4
SCALE = 2_000_000
TOP = 2000

#: Parts of the stripe of a common prefix, and the words that make it one: those that occur more
#: than once in so many words, of which there are at most as many.
PARTS = 64
COMMON = 2000
#: Entries of stripes that a task merges at a time.
MERGED = 1_000_000
#: Bytes of text that are counted together.
SLICE = 8_000_000
#: The bitmap of frequent phrases takes 32 bits a phrase, at most these (16 MB).
MOST_BITS = 1 << 27

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: 1: between words (space and tab), 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

_STRIPE = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("part", pa.int32()),
                     ("next", pa.string()), ("times", pa.binary())])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of neighbouring texts as numbers, in order, with the piece and language of each."""

    def __init__(self, data: np.ndarray, firsts: np.ndarray, langs: np.ndarray):
        kind, first = _KIND[data], np.zeros(len(data), bool)
        first[firsts] = True
        inside = kind == 0
        start = inside.copy()
        start[1:] &= ~inside[:-1] | first[1:]
        at = np.flatnonzero(start)
        ends = np.append((np.cumsum(inside, dtype=np.int32)[at] - 1), inside.sum(dtype=np.int32))
        coded = pa.Array.from_buffers(pa.string(), len(at), [
            None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(_LOWER[data[inside]])
        ]).dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = coded.dictionary
        self.piece = np.cumsum((kind == 2) | first, dtype=np.int32)[at]
        self.lang = langs[np.searchsorted(firsts, at, side="right") - 1]

    def hashes(self, n: int, langs: list[str]) -> np.ndarray:
        """A hash of each phrase of n words; phrases that run out of a piece have one, too."""
        word = np.array([xxhash.xxh64_intdigest(w) for w in self.words.to_pylist()], np.uint64)
        own = np.array([xxhash.xxh64_intdigest(x) for x in langs], np.uint64)
        size = max(0, len(self.code) - n + 1)
        total = own[self.lang[:size]]
        for j in range(n):
            total = _mixed(total, word[self.code[j:j + size]])
        return total


def _mixed(total: np.ndarray, word: np.ndarray) -> np.ndarray:
    total = (total ^ word) * _ODD
    return total ^ (total >> np.uint64(29))


def slices(langs: pa.Array, texts: pa.Array, size: int = SLICE) -> Iterator[tuple]:
    """Bytes of neighbouring texts, cut only between pieces, with where texts begin and their
    languages; a piece is the largest unit."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][:len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    firsts, stops = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    full = stops > firsts
    firsts, codes = firsts[full], langs[full]
    begin, end = int(offsets[0]), int(offsets[-1])
    borders = np.union1d(np.flatnonzero(_KIND[data[begin:end]] == 2) + begin + 1,
                         np.append(firsts, end))
    while begin < end:
        near = np.searchsorted(borders, begin + size, side="right") - 1
        stop = int(borders[max(near, np.searchsorted(borders, begin, side="right"))])
        low = np.searchsorted(firsts, begin, side="right") - 1
        high = np.searchsorted(firsts, stop, side="left")
        yield data[begin:stop], np.maximum(firsts[low:high] - begin, 0), codes[low:high]
        begin = stop


def stripes_of(words: Words, langs: list[str], n: int, bitmap: np.ndarray | None,
               common: frozenset[str]) -> pa.RecordBatch:
    """The stripes of all prefixes of n - 1 words, of phrases that the bitmap does not rule out."""
    size = len(words.code) - n + 1
    at = np.arange(max(size, 0))
    if n > 1 and size > 0:
        shorter = frequent(words.hashes(n - 1, langs), bitmap)
        at = np.flatnonzero((words.piece[:size] == words.piece[n - 1:])
                            & shorter[:size] & shorter[1:size + 1])
    names = words.words.to_pylist()
    vocabulary = max(1, len(names))
    part = np.array([xxhash.xxh32_intdigest(w) % PARTS for w in names], np.int64)
    is_common = np.array([w in common for w in names], bool)
    prefix, split = words.lang[at].astype(np.int64), np.ones(len(at), bool)
    for j in range(n - 1):
        prefix = np.unique(prefix * vocabulary + words.code[at + j], return_inverse=True)[1]
        split &= is_common[words.code[at + j]] if len(at) else split
    last = words.code[at + n - 1]
    group = prefix * PARTS + (np.where(split, part[last], 0) if len(last) else 0)
    key, one, times = np.unique(group * vocabulary + last, return_index=True, return_counts=True)
    group = key // vocabulary
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    place = at[one]
    ends = pa.array(np.append(begin, len(key)), pa.int32())
    head = place[begin]
    joined = [words.words.take(pa.array(words.code[head + j])) for j in range(n - 1)]
    text = (pc.binary_join_element_wise(*joined, " ") if joined
            else pa.array([""] * len(head), pa.string()))
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()).take(pa.array(words.lang[head])), text,
        pa.array(group[begin] % PARTS, pa.int32()),
        pc.binary_join(pa.ListArray.from_arrays(
            ends, words.words.take(pa.array(words.code[place + n - 1]))), " "),
        pa.Array.from_buffers(pa.binary(), len(head), [
            None, pa.py_buffer((4 * np.append(begin, len(key))).astype(np.int32)),
            pa.py_buffer(times.astype("<u4"))])], schema=_STRIPE)


def merge(parts: list[tuple]) -> tuple:
    """Counters of (language, prefix, next word) added elementwise."""
    lang, prefix, word = (pa.chunked_array([p[i] for p in parts], pa.string())
                          .combine_chunks().dictionary_encode() for i in range(3))
    times = np.concatenate([p[3] for p in parts])
    codes = [x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lang, prefix, word)]
    key = (codes[0] * max(1, len(prefix.dictionary)) + codes[1]) * max(1, len(word.dictionary)) + codes[2]
    order = np.argsort(key, kind="stable")
    begin = np.flatnonzero(np.diff(key[order], prepend=-1))
    one = pa.array(order[begin])
    return (lang.take(one).cast(pa.string()), prefix.take(one).cast(pa.string()),
            word.take(one).cast(pa.string()),
            np.add.reduceat(times[order], begin) if len(begin) else times)


def frequent(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which hashes the bitmap holds."""
    bit = hashes & np.uint64(len(bitmap) * 32 - 1)
    return (bitmap[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 == 1


def entries_of(batch: pa.RecordBatch) -> tuple:
    """The entries of stripes, each with its language and prefix."""
    words = pc.split_pattern(batch.column("next"), " ")
    row = pa.array(np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy()))
    times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
    return (batch.column("lang").take(row), batch.column("prefix").take(row), words.flatten(), times)


def level(texts: DataFrame, n: int, bitmap, common: frozenset[str], least: int) -> DataFrame:
    """``lang``, ``prefix``, ``next`` and ``f`` of the phrases of n words that occur ``least`` times."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else bitmap.value
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            langs = coded.dictionary.to_pylist()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            for part in slices(codes, batch.column("text")):
                yield stripes_of(Words(*part), langs, n, bits, common)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            held.append(entries_of(batch))
            waiting += len(held[-1][3])
            if waiting > MERGED and len(held) > 1:
                held, waiting = [merge(held)], 0
        if held:
            lang, prefix, word, times = merge(held)
            yield pa.RecordBatch.from_arrays([lang, prefix, word, pa.array(times, pa.int64())],
                                             ["lang", "prefix", "next", "f"]
                                             ).filter(pa.array(times >= least))

    stripes = texts.mapInArrow(
        build, "lang string, prefix string, part int, next string, times binary")
    return stripes.repartition("lang", "prefix", "part").mapInArrow(
        add, "lang string, prefix string, next string, f long")


def bitmap_of(phrases: DataFrame):
    """A broadcast bitmap of the hashes of ``lang`` and ``phrase``, of at most ``MOST_BITS``."""
    bits = 1 << 16
    while bits < min(MOST_BITS, 32 * phrases.count()):
        bits <<= 1

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            split = [p.split(" ") for p in batch.column("phrase").to_pylist()]
            total = np.array([digest(x) for x in batch.column("lang").to_pylist()], np.uint64)
            for j in range(len(split[0]) if split else 0):
                total = _mixed(total, np.array([digest(w[j]) for w in split], np.uint64))
            bit = (total & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bit >> 5), pa.array(np.int64(1) << (bit & 31))], ["slot", "mask"])

    found = (phrases.select("lang", "phrase").mapInArrow(slots, "slot long, mask long")
             .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow())  # bits / 32 rows
    bitmap = np.zeros(bits // 32, np.uint32)
    bitmap[found["slot"].to_numpy()] = found["mask"].to_numpy().astype(np.uint32)
    return phrases.sparkSession.sparkContext.broadcast(bitmap)


def mine_phrases(docs: DataFrame, least: int = LEAST, keep: float | None = 0.8) -> DataFrame:
    """All phrases of two to four words that occur ``least`` times or more in a language.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends and into words at
    spaces and tabs. Columns: ``lang`` (null: ``und``), ``phrase``, ``a`` (its occurrences within
    pieces, overlaps included), ``l`` and ``r`` (those of the two parts of its lowest-scoring
    cut), ``score`` (of that cut, ``floor(2000000 a / (l + r))``), ``n`` (all words of the
    language). A phrase goes if one longer phrase holds it in ``keep`` of its occurrences or more
    (exact to a hundredth; None keeps all). Null and empty texts have no words, repeated rows
    count again, an empty table has no phrases; other columns are not read, so ids may be null.
    """
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                        plain(docs["text"]).cast("binary").alias("text"))
    words = cut(level(texts, 1, None, frozenset(), 1))
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    every = words.agg(F.sum("f")).first()[0] or 0
    often = words.filter(F.col("f") * COMMON > every).select("next")  # fewer than COMMON rows
    common = frozenset(r["next"] for r in often.collect())
    none = F.array().cast("array<bigint>")
    last = cut(words.filter(F.col("f") >= least).select(
        "lang", F.col("next").alias("phrase"), "f", none.alias("lefts"), none.alias("rights")))
    levels = []
    for n in range(2, LONGEST + 1):
        bitmap = bitmap_of(last)
        found = level(texts, n, bitmap, common, least).withColumn(
            "phrase", F.concat_ws(" ", "prefix", "next"))
        found = found.withColumn("suffix", F.expr("substring(phrase, instr(phrase, ' ') + 1)"))
        left = last.select("lang", F.col("phrase").alias("prefix"),
                           F.concat("lefts", F.array("f")).alias("lefts"))
        right = last.select("lang", F.col("phrase").alias("suffix"),
                            F.concat(F.array("f"), "rights").alias("rights"))
        last = cut(found.join(left, ["lang", "prefix"]).join(right, ["lang", "suffix"])
                   .select("lang", "phrase", "prefix", "suffix", "f", "lefts", "rights"))
        bitmap.unpersist()
        levels.append(last)
    mined = None
    for shorter, longer in zip(levels, [*levels[1:], None], strict=True):
        if longer is not None and keep is not None:
            most = (longer.select("lang", F.col("prefix").alias("phrase"), "f")
                    .union(longer.select("lang", "suffix", "f"))
                    .groupBy("lang", "phrase").agg(F.max("f").alias("most")))
            held = F.col("most").cast("decimal(20,0)") * 100
            bound = F.col("f").cast("decimal(20,0)") * round(100 * keep)
            shorter = (shorter.join(most, ["lang", "phrase"], "left")
                       .filter(F.col("most").isNull() | (held < bound)))
        rows = shorter.select("lang", "phrase", F.col("f").alias("a"), _lowest_cut().alias("cut"))
        mined = rows if mined is None else mined.union(rows)
    return mined.join(total, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _lowest_cut():
    """The cut of least score, the smallest of several; its products are decimals of 38 digits."""
    return F.expr(f"""array_min(transform(lefts, (l, i) -> struct(
        (cast(f as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + rights[i]) as score,
        i as k, l as l, rights[i] as r)))""")


def best_phrases(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score, then occurrences, then bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (mine_phrases(docs).withColumn("rank", F.row_number().over(order).cast("long"))
            .filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w
  FROM pieces),
grams AS (
  SELECT lang, size, list_slice(w, i, i + size - 1) AS p
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
f AS (
  SELECT lang, size, array_to_string(p, ' ') AS phrase, any_value(p) AS p, count(*)::HUGEINT AS f
  FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE size > 1 AND f >= {LEAST}),
cuts AS (
  SELECT lang, phrase, size, p, f, k, array_to_string(list_slice(p, 1, k), ' ') AS first,
    array_to_string(list_slice(p, k + 1, size), ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.size, c.f AS a, l.f AS l, r.f AS r, c.k,
    ({SCALE}::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.first
    JOIN f r ON r.lang = c.lang AND r.phrase = c.rest),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(list_slice(p, i, i + s - 1), ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(1, size - s + 2)) AS i
        FROM candidates, (SELECT unnest([2, 3]) AS s) WHERE s < size) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM best JOIN total USING (lang) LEFT JOIN inside i USING (lang, phrase)
WHERE i.f IS NULL OR 100 * i.f < 80 * a
QUALIFY rank <= {TOP}"""


@query("op11_phrase_stripes", _SQL)
def op11_phrase_stripes(spark, sf_dir):
    """The first 2000 phrases of each language of all documents."""
    return best_phrases(table(spark, sf_dir, "documents"))
