"""Benchmark decontamination: item-sized windows, SimHash blocks, exact verification.

A text holds a benchmark item if some window of as many words as the item has reaches a
similarity of ``SIMILARITY`` with it: the sum of the smaller over the sum of the larger counts
of their shingles of ``SHINGLE`` words. Such a window shares most of its shingles with the item,
and moving it to the first shared one loses none; so the windows that begin at shared shingles
and hold enough of them include the best one of every match. Their SimHashes go through blocks
that any two fingerprints within ``RADIUS`` have in common, and what remains is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import NOT_ALNUM, cut, plain, words_of

SHINGLE = 5
SIMILARITY = 0.8
#: Shingles alike at ``SIMILARITY`` give fingerprints about ten bits apart; this is far beyond.
RADIUS = 23
BITS = 64
#: Item shingles up to this many bytes are sent to every task; more are joined by shuffle.
SMALL = 64 << 20


def word_hashes(text: Column) -> Column:
    words = words_of(F.lower(plain(text)), NOT_ALNUM)
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    return F.when(F.size(hashes) < size, F.array().cast("array<long>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)])))


def items_of(benchmark: DataFrame, shingle: int) -> DataFrame:
    """``item_id, text_hash, n`` (words), ``m`` (words of a shingle: fewer for items that are
    shorter) and their shingles ``g``; items without words match nothing. Items are told apart
    by id and text."""
    words = (benchmark.select("item_id", F.xxhash64(plain(benchmark["text"])).alias("ih"),
                              word_hashes(benchmark["text"]).alias("w"))
             .dropDuplicates(["item_id", "ih"]).withColumn("n", F.size("w")).filter("n > 0"))
    sized = words.withColumn("m", F.least(F.col("n"), F.lit(shingle)))
    by_size = F.array().cast("array<long>")
    for m in range(1, shingle + 1):
        by_size = F.when(F.col("m") == m, shingles(F.col("w"), m)).otherwise(by_size)
    return sized.withColumn("g", by_size).select("item_id", "ih", "n", "m", "g")


def simhash(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One fingerprint ``fp`` for the hashes of each key: a bit is set if most have it set.

    Sums of the bits are combined before they are shuffled.
    """
    sums = [F.sum(F.shiftrightunsigned(column, b).bitwiseAND(F.lit(1))).alias(f"b{b}")
            for b in range(BITS)]
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n_shingles"), *sums)
    fp = F.lit(0).cast("long")
    for b in range(BITS):
        weight = F.lit((1 << b) if b < 63 else -(1 << 63)).cast("long")
        fp = fp.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col("n_shingles"), weight)
                          .otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, fp.alias("fp"))


def blocks(radius: int) -> Column:
    """``radius`` + 1 parts of a fingerprint, one of which two within the radius share."""
    count = radius + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return F.array(*[F.struct(
        F.lit(i).alias("block"),
        F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))])


def find_items(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
               shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``text_hash``, ``item_id``, the best
    ``similarity`` and ``start``, the first word of the first such window.

    Words are runs of letters and digits in lower case; other columns are not read. Windows of a
    text shorter than the item are the whole text. Null or empty texts and items match nothing,
    null ids are ids, repeated rows of one id and text give one result, and no rows give none.
    """
    items = cut(items_of(benchmark, shingle))
    posted = cut(items.select("item_id", "ih", "n", "m", F.explode("g").alias("sh"))
                 .groupBy("item_id", "ih", "n", "m", "sh").agg(F.count("*").alias("c")))
    sizes = [r["m"] for r in items.select("m").distinct().collect()]  # at most SHINGLE rows
    hashed = docs.select("doc_id", F.xxhash64(plain(docs["text"])).alias("dh"),
                         word_hashes(docs["text"]).alias("w"))
    lookup = posted.select("item_id", "ih", "n", "m", "sh")
    if lookup.count() * 48 <= SMALL:
        lookup = F.broadcast(lookup)
    hits = None
    for m in sizes:
        at = hashed.select("doc_id", "dh", F.size("w").alias("words"),
                           F.posexplode(shingles(F.col("w"), m)).alias("pos", "sh"))
        found = at.join(lookup.filter(F.col("m") == m), "sh")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, "
            f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, "
            "similarity double, start int")
    keys = ["doc_id", "dh", "item_id", "ih", "n", "m", "words"]
    windows = cut(starts(hits, keys, similarity))
    parts = cut(window_shingles(docs, windows))
    of_window = ["doc_id", "dh", "item_id", "ih", "start"]
    # written one by one: as one plan it is planned anew, whole, after each of its seventeen exchanges
    near = cut(within_radius(cut(simhash(parts, of_window, "sh")), items, radius))
    return verified(parts, near, posted, of_window, similarity)


def starts(hits: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """Starts of windows, from hit to hit, that hold enough hits to reach the similarity."""
    width = F.least("n", "words") - F.col("m") + 1
    least = F.ceil(similarity / (1 + similarity) * (width + F.col("n") - F.col("m") + 1)
                   - 1e-9).cast("int")
    listed = (hits.groupBy(*keys).agg(F.sort_array(F.collect_set("pos")).alias("at"))
              .withColumns({"width": width, "least": least})
              .filter(F.size("at") >= F.col("least")))
    enough = F.filter(F.sequence(F.lit(0), F.size("at") - F.col("least")), lambda i: F.get(
        F.col("at"), i + F.col("least") - 1) <= F.get(F.col("at"), i) + F.col("width") - 1)
    last = F.greatest(F.col("words") - F.col("n"), F.lit(0))
    return (listed.withColumn("start", F.explode(F.array_distinct(F.transform(
        enough, lambda i: F.least(F.get(F.col("at"), i), last)))))
        .select("doc_id", "dh", "item_id", "ih", "m", "width", "start"))


def window_shingles(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """All shingles of the windows, from the texts of the few documents that have any."""
    dh = F.xxhash64(plain(docs["text"]))
    # texts are joined to what is left of them, not to every window
    few = windows.select("doc_id", "dh").distinct()
    texts = (docs.select(docs["doc_id"].alias("d"), docs["text"], dh.alias("h"))
             .join(few, F.col("d").eqNullSafe(few["doc_id"]) & (F.col("h") == few["dh"]), "left_semi")
             .dropDuplicates(["d", "h"]).select("d", "h", word_hashes(F.col("text")).alias("w")))
    joined = windows.join(texts, windows["doc_id"].eqNullSafe(texts["d"])
                          & (windows["dh"] == texts["h"])).drop("d", "h")
    part = F.slice("w", F.col("start") + 1, F.col("width") + F.col("m") - 1)
    sized = joined.withColumn("part", part)
    out = F.array().cast("array<long>")
    for m in range(1, SHINGLE + 1):
        out = F.when(F.col("m") == m, shingles(F.col("part"), m)).otherwise(out)
    return sized.select("doc_id", "dh", "item_id", "ih", "start", "width",
                        F.explode(out).alias("sh"))


def within_radius(found: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """Windows whose fingerprint is within the radius of their item's, by shared blocks."""
    item_fp = cut(simhash(items.select("item_id", "ih", F.explode("g").alias("sh")),
                          ["item_id", "ih"], "sh"))
    mine = found.select("*", F.explode(blocks(radius)).alias("b"))
    theirs = item_fp.select(F.col("item_id").alias("j"), F.col("ih").alias("jh"),
                            F.col("fp").alias("item_fp"), F.explode(blocks(radius)).alias("ib"))
    met = mine.join(theirs, mine["item_id"].eqNullSafe(theirs["j"]) & (mine["ih"] == theirs["jh"])
                    & (mine["b.block"] == theirs["ib.block"])
                    & (mine["b.value"] == theirs["ib.value"]))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius
    return met.filter(close).select("doc_id", "dh", "item_id", "ih", "start").distinct()


def verified(parts: DataFrame, near: DataFrame, posted: DataFrame, of_window: list[str],
             similarity: float) -> DataFrame:
    """The exact similarity of windows, and the best window of each document and item."""
    counts = parts.groupBy(*of_window, "width", "sh").agg(F.count("*").alias("have"))
    theirs = posted.select(F.col("item_id").alias("j"), F.col("ih").alias("jh"), "n", "m",
                           F.col("sh").alias("item_sh"), "c")
    shared = (counts.join(theirs, counts["item_id"].eqNullSafe(theirs["j"])
                          & (counts["ih"] == theirs["jh"]) & (counts["sh"] == theirs["item_sh"]))
              .groupBy(*of_window, "width", "n", "m")
              .agg(F.sum(F.least("have", "c")).alias("both")))
    either = F.col("width") + F.col("n") - F.col("m") + 1 - F.col("both")
    scored = shared.withColumn("similarity", F.col("both") / either).filter(
        F.col("similarity") >= similarity)
    same = [scored[k].eqNullSafe(near[k]) for k in of_window]
    kept = scored.join(near, same, "left_semi")
    best = kept.groupBy("doc_id", "dh", "item_id", "ih").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("neg"))).alias("best"))
    return best.groupBy("doc_id", F.col("dh").alias("text_hash"), "item_id").agg(
        F.max("best").alias("best")).select(
        "doc_id", "text_hash", "item_id", "best.similarity", (-F.col("best.neg")).alias("start"))


def without_items(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = cut(find_items(docs, benchmark, similarity).select(
        F.col("doc_id").alias("_lb_id"), F.col("text_hash").alias("_lb_hash")).distinct())
    mine = F.xxhash64(plain(docs["text"]))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_lb_id"])
                     & (mine == found["_lb_hash"]), "left_anti")


SQL = r"""
WITH i0 AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS m FROM i0 WHERE len(w) > 0),
p AS (SELECT item_id, n, m, array_to_string(w[k:k + m - 1], ' ') AS sh
      FROM (SELECT *, unnest(range(1, n - m + 2)) AS k FROM i)),
c AS (SELECT item_id, n, m, sh, count(*) AS c FROM p GROUP BY ALL),
d AS (SELECT DISTINCT doc_id, text, regexp_extract_all(lower(text),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, text, len(w) AS words, m, k - 1 AS pos, array_to_string(w[k:k + m - 1], ' ') AS sh
      FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM c))),
h AS (SELECT g.doc_id, g.text, g.words, g.pos, c.* FROM g JOIN c ON g.sh = c.sh AND g.m = c.m),
s AS (SELECT DISTINCT doc_id, text, item_id, least(pos, greatest(words - n, 0)) AS start FROM h),
x AS (SELECT s.doc_id, s.text, s.item_id, s.start, h.words, h.n, h.m, h.sh,
             least(count(*), any_value(h.c)) AS alike
      FROM s JOIN h ON s.doc_id IS NOT DISTINCT FROM h.doc_id AND s.text = h.text
                   AND s.item_id IS NOT DISTINCT FROM h.item_id
                   AND h.pos BETWEEN s.start AND s.start + least(h.n, h.words) - h.m
      GROUP BY ALL),
y AS (SELECT doc_id, text, item_id, start, sum(alike) AS alike,
             any_value(least(n, words) - m + 1 + n - m + 1) AS total FROM x
      GROUP BY ALL),
z AS (SELECT doc_id, item_id, start, CAST(alike AS DOUBLE) / CAST(total - alike AS DOUBLE) AS similarity FROM y)
SELECT doc_id, item_id, max(similarity) AS similarity,
       CAST(arg_min(start, -similarity * 1e6 + start * 1e-3) AS INT) AS start
FROM z WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""


@query("op9_decontaminate_windows", SQL)
def op9_decontaminate_windows(spark, sf_dir):
    """Benchmark items found in all documents."""
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start")
