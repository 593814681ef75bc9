"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier line has the same words, or words within one edit (a word changed,
put in or left out) and both have ``LEAST`` words or more. Equal lines meet by their hash. Lines
one edit apart meet in a variant: both without the changed word, or the longer without the one
that the other lacks. A variant's hash is the exclusive or of hashes of (word, place), so that
all variants of a line come from running sums over its words.

One edit leaves the first or the last words of a line as they are. Only lines that share those
with another line emit variants, which loses none. Of the lines that meet in a variant only the
earliest matters, so that large groups of near copies are a minimum, combined before it is
shuffled, and no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import cut, plain, spaced, word_count

#: Words a line must have to be compared by edits; one of five is a similarity of 0.8.
LEAST = 5
#: Tables of at most so many bytes are sent to every task instead of shuffling texts to them.
SMALL = 32 << 20


def sent_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A written table, to be broadcast if its rows are few; larger ones are joined by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= SMALL else df


def identity(docs: DataFrame) -> Column:
    """Tells texts of one id apart; rows that agree in id and text are one document."""
    return F.xxhash64(docs["doc_id"].isNull(), plain(docs["text"]))


def as_bits(rows: DataFrame, name: str) -> DataFrame:
    """The line numbers of each document as an array of words of 64 bits."""
    words = rows.groupBy("_lb_doc", "_lb_hash", F.shiftright("_lb_no", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                 F.col("_lb_no").bitwiseAND(F.lit(63)))).alias("bits"))
    held = words.groupBy("_lb_doc", "_lb_hash").agg(
        F.max("word").alias("last"), F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("of"))
    return held.select("_lb_doc", "_lb_hash", F.transform(
        F.sequence(F.lit(0), "last"), lambda i: F.coalesce(F.element_at("of", i), F.lit(0).cast("long")),
    ).alias(name))


def has_bit(bits: str, no: Column) -> Column:
    word = F.coalesce(F.get(F.col(bits), F.shiftright(no, 6)), F.lit(0).cast("long"))
    return F.call_function("shiftrightunsigned", word, no.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1


def lines_of(docs: DataFrame) -> DataFrame:
    """Every line with a word: ``_lb_doc, _lb_hash, _lb_no``, its words ``_lb_line`` in lower case
    with one space between them, its bytes and its key of 128 bits."""
    # On the raw line: a filter on the finished one would be pushed down and compute it twice.
    worded = F.ltrim("_lb_raw", F.lit(" \t\n\x0b\f\r")) != ""
    return (docs.select(docs["doc_id"].alias("_lb_doc"), identity(docs).alias("_lb_hash"),
                        F.posexplode(F.split(plain(docs["text"]), "\n"))
                        .alias("_lb_no", "_lb_raw"))
            .filter(worded)
            .withColumn("_lb_low", F.lower("_lb_raw"))
            .select("_lb_doc", "_lb_hash", "_lb_no", spaced(F.col("_lb_low")).alias("_lb_line"))
            .withColumns({"_lb_k1": F.xxhash64("_lb_line"),
                          "_lb_k2": F.xxhash64(F.lit("second"), "_lb_line")}))


def end_size(n: Column) -> Column:
    """The largest power of two in half of ``n`` words."""
    return F.pow(F.lit(2.0), F.floor(F.log2(n) + 1e-9) - 1).cast("int")


def end_keys(line: Column, n: Column, q: Column) -> Column:
    """Hashes of the first and of the last ``q`` words of a line, ``end_size`` of its words. A
    length that is a power of two has half of that too, as the line one word shorter has."""
    def both(count: Column) -> list[Column]:
        ends = [F.call_function("substring_index", line, F.lit(" "), k) for k in (count, -count)]
        return [F.xxhash64(F.lit(side), count, end)
                for side, end in zip(("first", "last"), ends, strict=True)]

    return F.when(n < LEAST, F.array().cast("array<long>")).when(
        2 * q == n, F.array(*both(q), *both(F.shiftright(q, 1)))).otherwise(F.array(*both(q)))


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per distinct line: its first occurrence, how many there are, and its end keys."""
    n = word_count(F.col("_lb_line"))
    # One step each, so that no number is computed for every use of it.
    keyed = (lines.withColumn("n", n).withColumn("q", end_size(F.col("n")))
             .withColumn("_lb_ends", end_keys(F.col("_lb_line"), F.col("n"), F.col("q"))))
    keys = [F.max(F.get("_lb_ends", i)).alias(f"_lb_e{i}") for i in range(4)]
    return keyed.groupBy("_lb_k1", "_lb_k2").agg(
        F.min(F.struct("_lb_doc", "_lb_hash", "_lb_no")).alias("first"),
        F.count("*").alias("copies"), F.max("n").alias("n"), *keys)


def suspects(distinct: DataFrame) -> DataFrame:
    """First occurrences of the lines that share an end with another line, by document."""
    ends = F.array_compact(F.array(*[f"_lb_e{i}" for i in range(4)]))
    by_end = distinct.select("first", F.explode(ends).alias("end"))
    shared = cut(by_end.groupBy("end").agg(F.count("*").alias("c")).filter("c > 1").select("end"))
    return as_bits(by_end.join(sent_if_small(shared, 16), "end").select("first.*"), "_lb_at")


def texts_of(docs: DataFrame, by_doc: DataFrame) -> DataFrame:
    """The lines at the places ``_lb_at`` of documents, read again from their texts."""
    by_doc = by_doc.select(F.col("_lb_doc").alias("d"), F.col("_lb_hash").alias("h"), "_lb_at")
    few = sent_if_small(cut(by_doc), 64)
    rows = docs.select(docs["doc_id"].alias("_lb_doc"), identity(docs).alias("_lb_hash"),
                       plain(docs["text"]).alias("_lb_text"))
    found = rows.join(few, F.col("_lb_doc").eqNullSafe(F.col("d")) & (F.col("_lb_hash") == F.col("h")))
    lines = found.select("_lb_doc", "_lb_hash", "_lb_at",
                         F.posexplode(F.split("_lb_text", "\n")).alias("_lb_no", "_lb_raw"))
    return (lines.filter(has_bit("_lb_at", F.col("_lb_no")))
            .select("_lb_doc", "_lb_hash", "_lb_no", spaced(F.lower("_lb_raw")).alias("_lb_line"))
            .dropDuplicates(["_lb_doc", "_lb_hash", "_lb_no"]))


def variants(lines: DataFrame) -> DataFrame:
    """``key, at, first``: every line whole (``at`` -1) and without each of its words.

    The key is a hash of the words that are left and their number. Running exclusive ors give
    all variants of a line in one pass over its words.
    """
    words = lines.select(F.struct("_lb_doc", "_lb_hash", "_lb_no").alias("first"),
                         F.transform(F.split("_lb_line", " "), lambda w: F.xxhash64(w)).alias("w"))
    zero = F.lit(0).cast("long")

    def total(shift: int) -> Column:
        return F.aggregate(F.transform("w", lambda w, i: F.xxhash64(w, i - shift)), zero,
                           lambda a, h: a.bitwiseXOR(h))

    whole = words.withColumns({"n": F.size("w"), "all": total(0), "shifted": total(1)})
    order = Window.partitionBy("first").orderBy("i")
    each = (whole.select("first", "n", "shifted", F.posexplode("w").alias("i", "h"))
            .withColumns({"here": F.xxhash64("h", "i"), "left": F.xxhash64("h", F.col("i") - 1)})
            .withColumns({"before": F.bit_xor("here").over(order),
                          "upto": F.bit_xor("left").over(order)})
            .select(F.xxhash64(F.col("before").bitwiseXOR(F.col("here"))
                               .bitwiseXOR(F.col("shifted")).bitwiseXOR(F.col("upto")),
                               F.col("n") - 1).alias("key"), F.col("i").alias("at"), "first",
                    (F.col("n") - 1).alias("len")))
    return each.union(whole.select(F.xxhash64("all", "n"), F.lit(-1), "first", "n"))


def earlier_by_edit(lines: DataFrame) -> DataFrame:
    """``first`` of lines with an earlier line one edit away, and that line, ``witness``."""
    rows = variants(lines)
    by_place = (rows.groupBy("key", "at").agg(F.min("first").alias("least"),
                                              F.count("*").alias("c"),
                                              F.max("len").alias("len")))
    met = cut(by_place.groupBy("key").agg(
        F.sum("c").alias("c"), F.max("len").alias("kept"),
        F.min(F.when(F.col("at") < 0, F.col("least"))).alias("whole"),
        F.min(F.when(F.col("at") >= 0, F.col("least"))).alias("shortened"),
        F.map_from_entries(F.collect_list(F.when(F.col("c") > 1, F.struct("at", "least"))))
        .alias("places")).filter("c > 1 and (whole is not null or size(places) > 0)"))
    # each line looks at those before it: changed at the same place, or one word shorter or longer
    changed = F.when(F.col("at") >= 0, F.get(F.filter(F.map_entries("places"), lambda e:
                                                      e["key"] == F.col("at")), F.lit(0))["value"])
    other = F.when(F.col("kept") >= LEAST,
                   F.when(F.col("at") >= 0, F.col("whole")).otherwise(F.col("shortened")))
    seen = rows.join(sent_if_small(met, 128), "key").select(
        "first", F.least(changed, other).alias("witness"))
    return (seen.filter("witness < first").groupBy("first")
            .agg(F.min("witness").alias("witness")))


def one_edit_apart(a: Column, b: Column) -> Column:
    """Exactly: what two arrays of words have in common at both ends leaves one word at most."""
    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(differs == 0, F.least(F.size(x), F.size(y))).otherwise(differs - 1)

    longer = F.greatest(F.size(a), F.size(b))
    ends = common(a, b) + common(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (ends >= longer - 1)


def verified(found: DataFrame, lines: DataFrame) -> DataFrame:
    """Those lines whose words are one edit from those of their witness."""
    text = lines.select(F.struct("_lb_doc", "_lb_hash", "_lb_no").alias("place"), "_lb_line")
    mine = found.join(text, found["first"].eqNullSafe(text["place"])).select(
        "first", "witness", F.col("_lb_line").alias("mine"))
    both = mine.join(text, mine["witness"].eqNullSafe(text["place"]))
    return both.filter(one_edit_apart(F.split("mine", " "), F.split("_lb_line", " "))).select(
        "first.*", F.lit(True).alias("_lb_near"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """``_lb_doc, _lb_hash, _lb_no, _lb_near`` of every line that goes: near copies, and equal
    ones after the first."""
    lines = lines_of(docs)
    distinct = cut(distinct_lines(lines))
    copied = cut(distinct.filter("copies > 1").select("_lb_k1", "_lb_k2", "first"))
    again = lines.select("_lb_doc", "_lb_hash", "_lb_no", "_lb_k1", "_lb_k2").join(
        sent_if_small(copied, 64), ["_lb_k1", "_lb_k2"])
    equal = again.filter(F.struct("_lb_doc", "_lb_hash", "_lb_no") != F.col("first")).select(
        "_lb_doc", "_lb_hash", "_lb_no", F.lit(False).alias("_lb_near"))
    compared = cut(texts_of(docs, suspects(distinct)))
    near = verified(cut(earlier_by_edit(compared)), compared)
    return equal.union(near.select("_lb_doc", "_lb_hash", "_lb_no", "_lb_near"))


def with_removed(docs: DataFrame) -> DataFrame:
    """The documents with the numbers of the lines that go, and those of near copies, as bits:
    ``_lb_gone`` and ``_lb_near``, null for a document that loses none."""
    gone = cut(removed_lines(docs))
    near = as_bits(gone.filter("_lb_near"), "_lb_near").select(
        F.col("_lb_doc").alias("d"), F.col("_lb_hash").alias("h"), "_lb_near")
    bits = as_bits(gone, "_lb_gone")
    both = cut(bits.join(near, bits["_lb_doc"].eqNullSafe(near["d"])
                         & (bits["_lb_hash"] == near["h"]), "left")
               .select(F.col("_lb_doc").alias("_lb_d"), F.col("_lb_hash").alias("_lb_h"),
                       "_lb_gone", "_lb_near"))
    return (docs.withColumn("_lb_id", identity(docs))
            .join(sent_if_small(both, 128),
                  docs["doc_id"].eqNullSafe(F.col("_lb_d")) & (F.col("_lb_id") == F.col("_lb_h")),
                  "left")
            .drop("_lb_id", "_lb_d", "_lb_h"))


def bits_set(bits: str) -> Column:
    """How many line numbers the bits hold."""
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda n, x: n + F.bit_count(x)), F.lit(0))


def numbers(bits: str) -> Column:
    """The line numbers that the bits hold, in order."""
    held = F.flatten(F.transform(bits, lambda x, i: F.transform(F.filter(
        F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function(
            "shiftrightunsigned", x, b).bitwiseAND(F.lit(1)) == 1), lambda b: i * 64 + b)))
    return F.coalesce(held, F.array().cast("array<int>"))


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """The documents without lines that an earlier line equals or is one edit away from.

    Lines are earlier by ``doc_id`` (null first), then by a hash of the text, then by number;
    they are compared by their words in lower case, and lines without words always stay. All
    columns pass through; ``n_chars``, if there is one, is counted anew where a line has gone.
    Documents of whose words nothing is left go; empty and null texts stay as they are. Repeated
    rows keep the same lines. No rows give no rows.
    """
    found = with_removed(docs)
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~has_bit("_lb_gone", i)), "\n")
    changed = F.col("_lb_gone").isNotNull()
    out = found.withColumn("_lb_new", F.when(changed, kept).otherwise(F.col("text")))
    out = out.filter(~changed | F.col("_lb_new").rlike(r"[^\x20\x09-\x0D]"))
    columns = {"text": F.col("_lb_new")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("_lb_new").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumns(columns).select(*docs.columns)


SQL = r"""
WITH l AS (SELECT doc_id, i - 1 AS no, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
                        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
                 FROM documents)),
o AS (SELECT doc_id, no, line, row_number() OVER (ORDER BY doc_id, no) AS r FROM l WHERE line <> ''),
d AS (SELECT line, min(r) AS r, string_split(line, ' ') AS w, len(string_split(line, ' ')) AS n
      FROM o GROUP BY line),
v AS (SELECT r, n, k, array_to_string(w[:k - 1] || w[k + 1:], ' ') AS v
      FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM d WHERE n >= 5)),
near AS (SELECT a.r FROM v a JOIN v b ON a.v = b.v AND a.k = b.k AND b.r < a.r
         UNION SELECT a.r FROM v a JOIN d b ON a.v = b.line AND b.n >= 5 AND b.r < a.r
         UNION SELECT b.r FROM v a JOIN d b ON a.v = b.line AND b.n >= 5 AND a.r < b.r),
gone AS (SELECT o.doc_id, o.no, near.r IS NOT NULL AS near
         FROM o JOIN d USING (line) LEFT JOIN near ON near.r = o.r
         WHERE o.r > d.r OR near.r IS NOT NULL),
g AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (near) AS n_near,
             string_agg(no, ',' ORDER BY no) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS n_lines,
       coalesce(n_removed, 0) AS n_removed, coalesce(n_near, 0) AS n_near,
       coalesce(removed, '') AS removed
FROM documents LEFT JOIN g USING (doc_id)
"""


@query("op1_line_dedup", SQL)
def op1_line_dedup(spark, sf_dir):
    """Per document the lines that go, numbered from 0, and how many of them are near copies."""
    found = with_removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size(F.split(plain(F.col("text")), "\n")).alias("n_lines"),
                        bits_set("_lb_gone").alias("n_removed"), bits_set("_lb_near").alias("n_near"),
                        F.array_join(numbers("_lb_gone").cast("array<string>"), ",").alias("removed"))
