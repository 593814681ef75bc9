"""Spelling variants: words one edit apart, by composing automata.

The pairs of words that differ by one inserted, deleted or replaced character are what the
composition of three automata accepts: the minimised acceptor of the vocabulary, a transducer that
makes one edit, and the acceptor again. Before the edit both copies of the acceptor are in one
state, after it they read the same rest, so a pair is a path to a state, an edit there, and a word
of the intersection of what two states accept. States are shared by all words with equal rests, so
edits and intersections are worked out once a state, not once a word.

The composition is partitioned by its initial states. A pair has a shorter length m and an edit at
a place t; the places 0 to m are cut into intervals, and words that may have their edit in [a, b)
agree in their first a and last m - b characters, which are the key of a partition. Each pair lies
in one partition. Partitions of more than ``MOST`` words or of a wide interval are halved by their
interval, and their words by the longer keys that follow; an interval of one place leaves a word
at most one other for each character of the alphabet. So no key collects unboundedly.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain

#: Fixed by the result contract: words, and how much more frequent a form is.
LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10
DROPPED = 31

#: Words of a partition, and places of its interval, beyond which it is halved.
MOST = 20_000
WIDEST = 256
#: Bytes of text that are read together.
SLICE = 8_000_000

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: U+00C0 to U+00FF are this byte and one more.
_LEAD = 0xC3

State = tuple[bool, dict[str, int]]


def runs_of(data: np.ndarray, firsts: np.ndarray, least: int) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters with so many letters or more, and the text each is in."""
    lead = data == _LEAD
    letter = _LETTER[data] | lead
    letter[1:] |= lead[:-1]
    first = np.zeros(len(data), bool)
    first[firsts] = True
    start = letter.copy()
    start[1:] &= ~letter[:-1] | first[1:]
    at = np.flatnonzero(start)
    single = letter & ~lead  # the last byte of each character
    letters = np.append(np.cumsum(single, dtype=np.int32)[at] - single[at], single.sum())
    ends = np.append(np.cumsum(letter, dtype=np.int32)[at] - 1, letter.sum()).astype(np.int32)
    runs = pa.Array.from_buffers(pa.string(), len(at), [
        None, pa.py_buffer(ends), pa.py_buffer(_LOWER[data[letter]])])
    long = np.flatnonzero(np.diff(letters) >= least)
    return runs.take(pa.array(long)), np.searchsorted(firsts, at[long], side="right") - 1


def misspelt(doc: str, run: str) -> str:
    """The run, less one character if the checksum of document and run says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc.encode() + b":"))
    return run if h % DROPPED else run[:(k := h % len(run))] + run[k + 1:]


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """``word`` and ``n``: the words of so many letters or more and their occurrences.

    A null text has no words and a null id is written as nothing; repeated rows count again.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:][:len(texts) + 1]
            body = texts.buffers()[2]
            data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
            ids, begin = batch.column("doc_id").to_pylist(), 0
            while begin < len(ids):
                stop = max(begin + 1, int(np.searchsorted(
                    offsets, offsets[begin] + SLICE, side="right")) - 1)
                stop = min(stop, len(ids))
                low = int(offsets[begin])
                full = np.flatnonzero(np.diff(offsets[begin:stop + 1]))
                runs, at = runs_of(data[low:int(offsets[stop])],
                                   offsets[begin:stop][full].astype(np.int64) - low, least_letters)
                yield _counted(runs, full[at] + begin, ids, least_letters)
                begin = stop

    texts = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("doc_id"),
                        plain(docs["text"]).cast("binary").alias("text"))
    return (texts.mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _counted(runs: pa.Array, text: np.ndarray, ids: list[str], least: int) -> pa.RecordBatch:
    coded = runs.dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary.to_pylist()
    key, times = np.unique(text * max(1, len(names)) + word, return_counts=True)
    total = np.zeros(len(names), np.int64)
    dropped: dict[str, int] = {}
    raw = [name.encode() for name in names]
    crc = zlib.crc32
    text_of, word_of = np.divmod(key, max(1, len(names)))
    heads = {t: crc(ids[t].encode() + b":") for t in np.unique(text_of).tolist()}
    for t, w, n in zip(text_of.tolist(), word_of.tolist(), times.tolist(), strict=True):
        if crc(raw[w], heads[t]) % DROPPED:
            total[w] += n
        else:
            left = misspelt(ids[t], names[w])
            if len(left) >= least:
                dropped[left] = dropped.get(left, 0) + n
    kept = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([
        pa.concat_arrays([coded.dictionary.take(pa.array(kept)), pa.array(list(dropped), pa.string())]),
        pa.concat_arrays([pa.array(total[kept]), pa.array(list(dropped.values()), pa.int64())])],
        ["word", "n"])


def acceptor(rests: list[str]) -> tuple[list[State], int]:
    """The minimised acceptor of sorted distinct strings: its states, and the initial one.

    Strings are added in order; a state is finished once no further string runs through it, and
    is shared if an equal one exists.
    """
    states: list[State] = []
    known: dict[tuple, int] = {}
    open_: list[list] = [[False, {}]]
    last = ""

    def close(to: int) -> None:
        while len(open_) - 1 > to:
            final, edges = open_.pop()
            same = (final, tuple(edges.items()))
            if same not in known:
                known[same] = len(states)
                states.append((final, edges))
            open_[-1][1][last[len(open_) - 1]] = known[same]

    for rest in rests:
        shared = 0
        for x, y in zip(last, rest):  # noqa: B905  (one may be longer)
            if x != y:
                break
            shared += 1
        close(shared)
        open_.extend([False, {}] for _ in rest[shared:])
        open_[-1][0] = True
        last = rest
    close(0)
    states.append((open_[0][0], open_[0][1]))
    return states, len(states) - 1


def both_accept(states: list[State], p: int, q: int, but: str = "") -> list[str]:
    """The strings that both states accept, except those that begin with ``but``."""
    found, stack = [], [(p, q, "")]
    while stack:
        a, b, read = stack.pop()
        (final, edges), (other_final, other) = states[a], states[b]
        if final and other_final:
            found.append(read)
        if len(other) < len(edges):
            edges, other = other, edges
        for c, _ in edges.items():
            if c in other and not (c == but and not read):
                stack.append((states[a][1][c], states[b][1][c], read + c))
    return found


def one_edit_pairs(rests: list[str], length: int, last: bool) -> Iterator[tuple[str, str]]:
    """The accepted pairs among sorted strings of ``length`` or one more characters.

    A replaced character leaves both at ``length``. A deleted one is the last of its run of equal
    characters; one at the very end belongs here only if this is the ``last`` interval.
    """
    states, initial = acceptor(rests)
    edits: dict[int, list] = {}
    stack = [(initial, "")]
    while stack:
        p, read = stack.pop()
        edges = states[p][1]
        if p not in edits:
            edits[p] = [(c, d, z) for c, d in itertools.combinations(edges, 2)
                        for z in both_accept(states, edges[c], edges[d])]
            edits[p] += [(c, "", z) for c in edges for z in both_accept(states, edges[c], p, c)]
        for c, d, rest in edits[p]:
            if d:
                if len(read) + 1 + len(rest) == length:
                    yield read + c + rest, read + d + rest
            elif len(read) + len(rest) == length and (rest or last):
                yield read + c + rest, read + rest
        stack.extend((q, read + c) for c, q in edges.items())


def _partitions(words: DataFrame) -> DataFrame:
    """Words by initial states: ``m``, the interval [``low``, ``high``) and the hash of the key."""
    spread = F.explode(F.array(*[F.struct(
        (F.length("word") - less).alias("m"), (half if upper else F.lit(0)).alias("low"),
        (F.length("word") - less if upper else half).alias("high"))
        for less in (0, 1) for upper in (False, True)
        for half in [F.floor((F.length("word") - less) / 2).cast("int")]]))
    rows = words.select("word", "n", spread.alias("at")).select("word", "n", "at.*")
    # the longer word of a pair is one character longer than m, the least length has no shorter
    rows = cut(_keyed(rows.filter(F.col("m") >= LEAST_LETTERS)))
    done = None
    while True:
        size = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(
            F.col("high") - F.col("low")).alias("width")).filter("size > 1")
        sized = cut(rows.join(size, "key"))
        halved = ((F.col("size") > MOST) & (F.col("width") > 1)) | (F.col("width") > WIDEST)
        large = sized.filter(halved)
        small = sized.filter(~halved).select(*rows.columns)
        done = small if done is None else done.union(small)
        if large.isEmpty():
            return done
        half = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        parts = F.explode(F.array(F.struct(F.col("low"), half.alias("high")),
                                  F.struct(half.alias("low"), F.col("high"))))
        rows = cut(_keyed(large.filter("low < high").select("word", "n", "m", parts.alias("at"))
                          .select("word", "n", "m", "at.*")))


def _keyed(rows: DataFrame) -> DataFrame:
    head = F.expr("substring(word, 1, low)")
    tail = F.expr("substring(word, length(word) - (m - high) + 1)")
    return rows.withColumn("key", F.xxhash64("m", "low", "high", head, tail))


def near_words(words: DataFrame) -> DataFrame:
    """For each of the distinct ``word`` with a near word: ``n_near``, and ``best_n`` and
    ``best``, the near word of largest ``n`` (ties: the smallest in code-point order)."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(
            *(batch.column(c).to_pylist() for c in ("key", "m", "low", "high", "word", "n")),
            strict=True))
        found: dict[str, list] = {}
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            parts: dict[tuple, dict[str, tuple[str, int]]] = {}
            for _, m, low, high, word, n in group:  # unlike keys may share a hash
                stop = len(word) - (m - high)
                own = (m, low, high, word[:low], word[stop:])
                parts.setdefault(own, {})[word[low:stop]] = (word, n)
            for (m, low, high, *_), mine in parts.items():
                for x, y in one_edit_pairs(sorted(mine), high - low, high == m):
                    for (word, _), (near, n) in ((mine[x], mine[y]), (mine[y], mine[x])):
                        best = found.setdefault(word, [0, 0, ""])
                        best[0] += 1
                        if n > best[1] or (n == best[1] and near < best[2]):
                            best[1:] = n, near
            if len(found) > 50_000:
                yield _near(found)
                found = {}
        if found:
            yield _near(found)

    pairs = _partitions(words).repartition("key").sortWithinPartitions("key").mapInArrow(
        compose, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return (pairs.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
            .select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best"))


def _near(found: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(list(found), pa.string()), pa.array([v[0] for v in found.values()], pa.int64()),
        pa.array([v[1] for v in found.values()], pa.int64()),
        pa.array([v[2] for v in found.values()], pa.string())],
        ["word", "n_near", "best_n", "best"])


def spelling_groups(docs: DataFrame) -> DataFrame:
    """Words of seven letters or more that occur twice or more, and what they are variants of.

    Columns: ``word``, ``n``; ``n_near`` (words one edit away); ``form`` and ``form_n``, the most
    frequent of these if it is ten times as frequent, else null; ``root``, where forms lead to (the
    word itself without one). Null texts have no words, an empty table gives no rows, repeated rows
    count again, columns besides ``doc_id`` and ``text`` are not read.
    """
    words = cut(count_words(docs).filter(F.col("n") >= LEAST_COUNT))
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    found = cut(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    return found.join(_roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(found: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words with a form; each round doubles the steps taken, and as each
    step multiplies the count by ten, five rounds reach the end of any."""
    up = found.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(up.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        up = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return up


@query("op13_spelling_forms")
def op13_spelling_forms(spark, sf_dir):
    """Spelling variants among the words of all documents."""
    return spelling_groups(table(spark, sf_dir, "documents"))
