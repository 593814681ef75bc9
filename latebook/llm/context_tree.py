"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, the nodes of a tree of its leading bits. Every node has a
Krichevsky-Trofimov estimator in each context of 0 to ``DEPTH`` bytes before it, and a node of
a context mixes its own estimate with what the contexts one byte longer say of it, weighted by
how well either has predicted the training bytes. All of this follows from how often each run
of ``DEPTH`` + 1 bytes occurs, so the corpus is counted once:

* every task counts its runs, and sums by run give one table, which grows with the corpus;
* the runs that share their last two context bytes are one subtree and are weighted together;
  contexts of fewer bytes need only sums over the subtrees, at most 256 x 255 nodes;
* texts are dealt into blocks; a block asks once for each of its distinct runs and words, and
  is scored with the answers, so that no model of the whole corpus sits in any task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from latebook.llm.lines import sent_if_small
from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain
from latebook.llm.tokens import give_back, tidy

DEPTH = 4
#: Context bytes that a subtree shares; its runs are at most 256 ** (DEPTH - 2 + 1).
SHARED = 2
#: Bytes of text in a block, in a step of a task (eighty bytes of memory or so for each) and in
#: what has its words numbered together, runs that a task counts before it merges them, and runs
#: weighted together.
BLOCK = 16 << 20
STEP = 1 << 18
NUMBERED = 2 << 20
HELD = 1 << 18
BUNDLE = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GAP = bytes(DEPTH)
_LN10 = math.log(10)


def held_out(doc_id: Column) -> Column:
    """Texts that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def lowered(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "replace").translate(_LOWER) for t in texts]


def steps(texts: pa.Array | pa.ChunkedArray, size: int = STEP) -> Iterator[slice]:
    """Neighbouring rows together, up to ``size`` bytes or one text, so that only the texts of
    one step need to be Python's at a time."""
    total = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    first = 0
    while first < len(total):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + size, "right")))
        yield slice(first, last)
        first = last


def tidied(run: Callable[..., pa.Table], *tables: pa.Table) -> pa.Table:
    """What a group's function makes of its tables; the memory that it has freed is given back."""
    try:
        return run(*tables)
    finally:
        give_back()


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The runs of the texts, each followed by an end (byte 0) and led by ``DEPTH`` zeros, and
    where those of each text begin.

    A run is one number: the latest context byte first, the coded byte last, so that runs of one
    subtree are neighbours.
    """
    data = np.frombuffer(_GAP + _GAP.join(texts) + _GAP, np.uint8).astype(np.int64)
    length = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(length + DEPTH - 1) - (length + DEPTH - 1)
    n = len(data) - DEPTH
    runs = np.zeros(n, np.int64)
    for back in range(1, DEPTH + 1):
        runs |= data[DEPTH - back:DEPTH - back + n] << (8 * (DEPTH + 1 - back))
    runs |= data[DEPTH:]
    # between two texts lie the end of one and DEPTH - 1 zeros that are not coded
    coded = np.ones(n, bool)
    gaps = (starts + length)[:, None] + np.arange(DEPTH - 1)[None, :]
    coded[gaps[gaps < n]] = False
    return runs[coded], np.cumsum(length) - length


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    both, n = np.concatenate(keys), np.concatenate(counts)
    distinct, where = np.unique(both, return_inverse=True)
    return distinct, np.bincount(where, n, len(distinct)).astype(np.int64)


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (text, held_out) batches and how often texts that may be learnt from have them."""
    keys, counts, held = [], [], 0

    def batch_of(distinct, n):
        return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n)], ["run", "n"])

    for batch in batches:
        for rows in steps(batch.column(0)):
            texts = lowered(batch.column(0)[rows].to_pylist())
            out = batch.column(1)[rows].to_pylist()
            for learn in (True, False):
                part = [t for t, o in zip(texts, out, strict=True) if o != learn]
                if not part:
                    continue
                distinct, n = np.unique(runs_of(part)[0], return_counts=True)
                keys.append(distinct)
                counts.append(n if learn else np.zeros(len(n), np.int64))
                held += len(n)
                if held > 2 * HELD:
                    distinct, n = merged(keys, counts)
                    keys, counts, held = [distinct], [n], len(n)
                    if held > HELD:
                        yield batch_of(distinct, n)
                        keys, counts, held = [], [], 0
    if keys:
        yield batch_of(*merged(keys, counts))


# -- weighting ---------------------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers, by Stirling's series from 8 on."""
    x = np.asarray(x, np.float64)
    low = x < 8
    z = np.where(low, x + 8, x)
    value = ((z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi)
             + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7))
    if low.any():
        product = np.ones_like(x)
        for k in range(8):
            product = product * np.where(low, x + k, 1)
        value = value - np.where(low, np.log(product), 0)
    return value


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives to all of its training decisions."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi)
            - log_gamma(zeros + ones + 1))


@dataclass
class Level:
    """The nodes of one depth: for each run and bit the node's number, and what nodes know."""
    node: np.ndarray      # (runs of this depth, 8)
    zeros: np.ndarray
    ones: np.ndarray
    own: np.ndarray       # log probability by the estimator
    mixed: np.ndarray     # log probability weighted over this and all longer contexts
    weight: np.ndarray    # share of the own estimate in the mixture

    def chance(self, node: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """What the estimators of the nodes say of the decisions ``bits``."""
        hit = np.where(bits == 1, self.ones[node], self.zeros[node])
        return (hit + 0.5) / (self.zeros[node] + self.ones[node] + 1)


def bits_of(symbols: np.ndarray) -> np.ndarray:
    return (symbols[:, None] >> np.arange(7, -1, -1)) & 1


def nodes_of(symbols: np.ndarray) -> np.ndarray:
    """For each symbol the eight nodes it passes: a leading one, then the bits before."""
    return (256 | symbols[:, None]) >> np.arange(8, 0, -1)


def level_of(contexts: np.ndarray, symbols: np.ndarray, n: np.ndarray,
             below: np.ndarray | None) -> Level:
    """``below``: for each (context, node) pair in order, the sum of the longer contexts'
    mixtures; none at full depth."""
    pair = contexts[:, None] * 256 + nodes_of(symbols)
    distinct, node = np.unique(pair, return_inverse=True)
    node = node.reshape(pair.shape)
    weights = np.repeat(n, 8).astype(np.float64)
    ones = np.bincount(node.ravel(), weights * bits_of(symbols).ravel(), len(distinct))
    zeros = np.bincount(node.ravel(), weights, len(distinct)) - ones
    own = log_kt(zeros, ones)
    if below is None:
        return Level(node, zeros, ones, own, own, np.ones(len(distinct)))
    mixed = np.logaddexp(own, below) - math.log(2)
    return Level(node, zeros, ones, own, mixed, 1 / (1 + np.exp(np.clip(below - own, -700, 700))))


@dataclass
class Subtrees:
    levels: list[Level]            # depths SHARED to DEPTH
    at: list[np.ndarray]           # for each run of full depth its run of that depth
    contexts: np.ndarray           # runs of depth SHARED: context, symbol, count
    symbols: np.ndarray
    counts: np.ndarray


def subtrees(runs: np.ndarray, n: np.ndarray) -> Subtrees:
    """All nodes of some whole subtrees, from the deepest contexts up."""
    symbols = runs & 255
    context = runs >> 8  # the latest byte is the highest; shorter contexts drop low bytes
    at, kept = [np.arange(len(runs))], [(context, symbols, n)]
    for depth in range(DEPTH - 1, SHARED - 1, -1):
        key = (context >> (8 * (DEPTH - depth))) << 8 | symbols
        distinct, where = np.unique(key, return_inverse=True)
        at.append(where)
        kept.append((distinct >> 8, distinct & 255, np.bincount(where, n, len(distinct))))
    levels: list[Level] = []
    for k, (contexts, syms, counts) in enumerate(kept):
        below = None
        if levels:
            pair = contexts[:, None] * 256 + nodes_of(syms)
            mine = np.unique(pair)
            # every node of the depth below adds its mixture to its parent, once
            last, (long_context, long_symbol, _) = levels[-1], kept[k - 1]
            parent = np.zeros(len(last.mixed), np.int64)
            parent[last.node] = np.searchsorted(
                mine, (long_context >> 8)[:, None] * 256 + nodes_of(long_symbol))
            below = np.bincount(parent, last.mixed, len(mine))
        levels.append(level_of(contexts, syms, counts, below))
    contexts, syms, counts = kept[-1]
    return Subtrees(levels[::-1], at[::-1], contexts, syms, counts)


def summary(bundle: pa.Table) -> pa.Table:
    """For the contexts of one byte: counts by symbol, and sums of mixtures by node."""
    tree = subtrees(bundle["run"].to_numpy(), bundle["n"].to_numpy())
    byte = tree.contexts >> (8 * (SHARED - 1))
    top = tree.levels[0]
    owner = np.zeros(len(top.mixed), np.int64)
    owner[top.node] = byte[:, None] * 256 + nodes_of(tree.symbols)
    keys, where = np.unique(owner, return_inverse=True)
    sums = np.bincount(where, top.mixed, len(keys))
    pairs, where = np.unique(byte * 256 + tree.symbols, return_inverse=True)
    counts = np.bincount(where, tree.counts, len(pairs))
    return pa.table({
        "kind": pa.array([0] * len(keys) + [1] * len(pairs), pa.int32()),
        "key": pa.array(np.concatenate([keys, pairs])),
        "value": pa.array(np.concatenate([sums, counts]).astype(np.float64))})


@dataclass
class Top:
    """The contexts of no byte and of one: estimates of a one, and weights of the estimates."""
    root: np.ndarray
    root_weight: np.ndarray
    byte: np.ndarray        # (256, 256)
    byte_weight: np.ndarray


def top_of(rows: list[tuple[int, int, float]]) -> Top:
    mixtures, counts = np.zeros((256, 256)), np.zeros((256, 256))
    for kind, key, value in rows:
        (counts if kind else mixtures)[key >> 8, key & 255] = value
    symbols = np.arange(256)
    nodes, bits = nodes_of(symbols), bits_of(symbols)
    ones, zeros = np.zeros((256, 256)), np.zeros((256, 256))
    for k in range(8):
        np.add.at(ones.T, nodes[:, k], (counts * bits[:, k]).T)
        np.add.at(zeros.T, nodes[:, k], (counts * (1 - bits[:, k])).T)
    own = log_kt(zeros, ones)
    mixed = np.logaddexp(own, mixtures) - math.log(2)
    root_own = log_kt(zeros.sum(0), ones.sum(0))
    below = mixed.sum(0)

    def share(a, b):
        return 1 / (1 + np.exp(np.clip(b - a, -700, 700)))

    return Top((ones.sum(0) + 0.5) / (zeros.sum(0) + ones.sum(0) + 1), share(root_own, below),
               (ones + 0.5) / (zeros + ones + 1), share(own, mixtures))


def weigher(top: Top):
    def weigh(bundle: pa.Table) -> pa.Table:
        """The log10 probability of the last byte of each run after the others."""
        runs = bundle["run"].to_numpy()
        tree = subtrees(runs, bundle["n"].to_numpy())
        symbols = runs & 255
        bits, nodes = bits_of(symbols), nodes_of(symbols)
        chance = None
        for level, at in reversed(list(zip(tree.levels, tree.at, strict=True))):
            node = level.node[at]
            own, weight = level.chance(node, bits), level.weight[node]
            chance = own if chance is None else weight * own + (1 - weight) * chance
        byte = (runs >> (8 * DEPTH))[:, None]
        for one, weight in ((top.byte[byte, nodes], top.byte_weight[byte, nodes]),
                            (top.root[nodes], top.root_weight[nodes])):
            own = np.where(bits == 1, one, 1 - one)
            chance = weight * own + (1 - weight) * chance
        return pa.table({"run": bundle["run"], "f": pa.array(np.log(chance).sum(1) / _LN10)})
    return weigh


def train(texts: DataFrame) -> DataFrame:
    """``run`` and ``f``, its log10 probability, for all runs of ``text``, learnt from those of
    the rows that are not ``held_out``."""
    counted = cut(texts.select("text", "held_out").mapInArrow(tidy(count_runs), "run long, n long")
                  .groupBy("run").agg(F.sum("n").alias("n")))
    bundles = max(1, -(-counted.count() // BUNDLE))
    subtree = F.shiftright("run", 8 * (DEPTH + 1 - SHARED))
    dealt = counted.withColumn("bundle", F.pmod(F.xxhash64(subtree), F.lit(bundles)))
    sums = (dealt.groupBy("bundle")
            .applyInArrow(lambda t: tidied(summary, t), "kind int, key long, value double")
            .groupBy("kind", "key").agg(F.sum("value").alias("value")))
    top = top_of([tuple(r) for r in sums.collect()])  # at most 2 * 256 * 256 rows
    weigh = weigher(top)
    return cut(dealt.groupBy("bundle").applyInArrow(lambda t: tidied(weigh, t), "run long, f double"))


# -- scoring -----------------------------------------------------------------------------------

def words_in(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts, an end (no bytes) after each text's, and how many each has."""
    split = [t.split() for t in texts]
    return (pa.array([w for words in split for w in (*words, b"")], pa.binary()),
            np.array([len(words) + 1 for words in split], np.int64))


def coded_words(texts: pa.ChunkedArray) -> tuple[pa.Array, list[np.ndarray], list[np.ndarray]]:
    """The distinct words of all texts; by step, the number of each word among them and how many
    words each text has."""
    coded, lengths = [], []
    for rows in steps(texts):
        words, length = words_in(lowered(texts[rows].to_pylist()))
        coded.append(words.dictionary_encode())
        lengths.append(length)
    coded = pa.chunked_array(coded).unify_dictionaries()
    return coded.chunk(0).dictionary, [c.indices.to_numpy() for c in coded.chunks], lengths


def ask_words(block: pa.Table) -> pa.Table:
    """The distinct words of a block, and how often it has them in texts to learn from."""
    total = None
    for rows in steps(block["text"], NUMBERED):
        dictionary, codes, lengths = coded_words(block["text"][rows])
        learn = np.repeat(~block["held_out"][rows].to_numpy(), np.concatenate(lengths))
        n = np.bincount(np.concatenate(codes)[learn], minlength=len(dictionary))
        found = pa.table({"word": dictionary, "n": n})
        total = found if total is None else pa.concat_tables([total, found]).group_by(
            "word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
        give_back()
    blk = pa.array(np.full(len(total), block["block"][0].as_py(), np.int64))
    return pa.table({"block": blk, "word": total["word"], "n": total["n"]})


def ask_runs(block: pa.Table) -> pa.Table:
    """The distinct runs of a block."""
    runs, held, limit = [], 0, HELD
    for rows in steps(block["text"]):
        runs.append(np.unique(runs_of(lowered(block["text"][rows].to_pylist()))[0]))
        held += len(runs[-1])
        if held > 2 * limit:
            runs = [np.unique(np.concatenate(runs))]
            held = len(runs[0])
            limit = max(limit, held)
    distinct = np.unique(np.concatenate(runs))
    blk = pa.array(np.full(len(distinct), block["block"][0].as_py(), np.int64))
    return pa.table({"block": blk, "run": pa.array(distinct)})


SCORED = ("doc_id {id}, held_out boolean, n_tokens long, n_known long, word_logs double, "
          "score double, n_bytes long, part_tokens long, part_words long")


def score_block(schema: pa.Schema):
    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        """One row per text, and one without ``n_tokens`` for the block's share of the training
        words: how many it has, and of how many distinct ones it speaks for all blocks."""
        is_run = pc.is_valid(answers["run"])
        known = answers.select(["run", "f"]).filter(is_run)
        order = np.argsort(known["run"].to_numpy())
        run, value = known["run"].to_numpy()[order], known["f"].to_numpy()[order]
        about = answers.select(["word", "n", "c", "own"]).filter(pc.invert(is_run))
        rows = {name: [] for name in ("n_tokens", "n_known", "word_logs", "score", "n_bytes")}
        vocabulary, counts = about["word"].combine_chunks(), about["c"].to_numpy()
        for many in steps(block["text"], NUMBERED):
            texts = block["text"][many]
            dictionary, codes, lengths = coded_words(texts)
            count = counts[pc.index_in(dictionary, vocabulary).to_numpy()]
            for part, code, length in zip(steps(texts), codes, lengths, strict=True):
                low = lowered(texts[part].to_pylist())
                runs, starts = runs_of(low)
                rows["score"].append(np.add.reduceat(value[np.searchsorted(run, runs)], starts))
                c = count[code]
                first = np.cumsum(length) - length
                rows["n_tokens"].append(length)
                rows["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), first))
                rows["word_logs"].append(np.add.reduceat(np.log10(c + 0.5), first))
                rows["n_bytes"].append(np.array([len(t) for t in low], np.int64))
            give_back()
        flat = {k: np.concatenate(v) for k, v in rows.items()}
        n = len(block)
        mine = about.filter(pc.and_(about["own"], pc.greater(about["c"], 0)))
        columns = {"doc_id": block["doc_id"], "held_out": block["held_out"], **{
            k: pa.array(v) for k, v in flat.items()}}
        out = pa.table({f.name: columns[f.name].cast(f.type) if f.name in columns
                        else pa.nulls(n, f.type) for f in schema})
        share = {"part_tokens": pc.sum(about["n"]).as_py() or 0, "part_words": len(mine)}
        return pa.concat_tables([out, pa.table({
            f.name: pa.array([share.get(f.name)], f.type) for f in schema})])
    return score


def score_documents(docs: DataFrame, depth_bytes: int = BLOCK) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of
    every row: the unigram score of its words and the context-tree score of its bytes, both in
    log10 and over the text with A-Z in lower case and one end.

    Reads ``doc_id`` and ``text``. A null text is empty; an empty one is its end alone, with no
    ``bits_per_byte``. Repeated rows each count and each have a row, a null id is learnt from,
    and no rows give no rows. A task holds a block of about ``depth_bytes`` or one text.
    """
    ident = docs["doc_id"]
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // depth_bytes))
    texts = docs.select(ident.alias("doc_id"), plain(docs["text"]).alias("text"),
                        held_out(ident).alias("held_out"))
    model = train(texts)
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    asked = dealt.groupBy("block").applyInArrow(
        lambda t: tidied(ask_words, t), "block long, word binary, n long")
    by_word = Window.partitionBy("word")  # a row for each block at most
    words = asked.select("block", "word", "n", F.sum("n").over(by_word).alias("c"),
                         (F.row_number().over(by_word.orderBy("block")) == 1).alias("own"))
    runs = (dealt.groupBy("block")
            .applyInArrow(lambda t: tidied(ask_runs, t), "block long, run long")
            .join(sent_if_small(model, 24), "run"))
    none = {"run": "long", "f": "double", "word": "binary", "n": "long", "c": "long",
            "own": "boolean"}

    def answer(df: DataFrame) -> DataFrame:
        return df.select("block", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c)
                                    for c, t in none.items()])

    kind = docs.schema["doc_id"].dataType
    schema = SCORED.format(id=kind.simpleString())
    empty = docs.sparkSession.createDataFrame([], schema)
    score = score_block(to_arrow_schema(empty.schema))
    scored = cut(dealt.groupBy("block").cogroup(answer(words).union(answer(runs)).groupBy("block"))
                 .applyInArrow(lambda b, a: tidied(score, b, a), schema))
    total, distinct = scored.agg(F.sum("part_tokens"), F.sum("part_words")).first()
    scale = math.log10((total or 0) + 0.5 * ((distinct or 0) + 1))
    bits = -F.col("score") * math.log2(10) / F.col("n_bytes")
    return scored.filter("n_tokens is not null").select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(total or 0).cast("long").alias("train_tokens"),
        (F.col("word_logs") - F.col("n_tokens") * scale).alias("base_score"), "score",
        F.when(F.col("n_bytes") > 0, bits).alias("bits_per_byte"))


@query("op2_context_tree")
def op2_context_tree(spark, sf_dir):
    """Unigram and context-tree scores of all documents."""
    return score_documents(table(spark, sf_dir, "documents"))
