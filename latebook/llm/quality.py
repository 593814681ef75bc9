"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import count_of, plain, words_of

#: Fixed by the result contract.
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_upper", "n_exclaim")


@dataclass(frozen=True)
class Rule:
    """A named failure; its position in ``RULES`` is its bit and never changes."""
    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("exclamations", "2 * n_exclaim > n_words"),
    Rule("capitals", "10 * n_upper > 3 * word_chars"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("long_words", "word_chars > 14 * n_words"),
    Rule("no_words", "n_words = 0"),
)

#: Policies name their rules; a new version is a new entry.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "1": tuple(r.name for r in RULES if r.name != "long_words"),
}


def mask(policy: str) -> int:
    return sum(1 << i for i, r in enumerate(RULES) if r.name in POLICIES[policy])


#: Up to so many repeated windows, looking each word's window up among them is cheaper than
#: sorting all windows with their places; either way gives the same words.
LOOK_UP = 64


def covered_words(windows: Column, repeated: Column, size: int) -> Column:
    """Words inside windows of ``size`` words whose hash is among the ``repeated``.

    The places of those windows, in order, cover ``size`` words each or as many as the gap to
    the one before.
    """
    looked_up = F.filter(F.sequence(F.lit(0), F.size(windows) - 1),
                         lambda i: F.array_contains(repeated, F.get(windows, i)))
    places = F.when(F.size(repeated) <= LOOK_UP, looked_up).otherwise(_places_sorted(windows))
    start = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(places, start, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(size), i - a["last"])).alias("n")),
        lambda a: a["n"])


def _places_sorted(windows: Column) -> Column:
    """Places of windows that occur more than once: sorting (hash, place) brings equal windows
    together, and those with an equal neighbour keep their place."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def of(pairs: Column) -> Column:
        same = F.zip_with(pairs, F.slice(pairs, F.lit(2), F.size(pairs)),
                          lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        return F.transform(F.array(same), lambda s: F.zip_with(
            pairs, F.zip_with(s, F.concat(F.array(F.lit(False)), s),
                              lambda after, before: F.coalesce(after, F.lit(False)) | before),
            lambda p, m: F.when(m, p["i"])))[0]

    # transform over an array of one binds a value, so that it is computed once
    places = F.transform(F.array(placed), of)[0]
    return F.sort_array(F.filter(places, lambda i: i.isNotNull()))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``MEASURES``; a null text measures as an empty one."""
    raw = plain(docs[text])
    lines = F.transform(F.filter(F.split(raw, "\n"), lambda x: x.rlike(WORD)),
                        lambda x: F.xxhash64(x))
    step = docs.withColumns({"_lb_split": words_of(raw), "_lb_lines": lines})
    step = step.withColumn("_lb_words", F.transform("_lb_split", lambda w: F.xxhash64(w)))
    words, none = F.col("_lb_words"), F.array().cast("array<long>")
    step = step.withColumn("_lb_windows", F.when(F.size(words) < 3, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
            F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))))
    windows = F.col("_lb_windows")
    step = step.withColumn("_lb_sorted", F.sort_array(windows))
    ordered = F.col("_lb_sorted")
    step = step.withColumn("_lb_repeated", F.array_distinct(F.filter(
        F.zip_with(ordered, F.slice(ordered, F.lit(2), F.size(ordered)),
                   lambda a, b: F.when(a == b, a)), lambda h: h.isNotNull())))
    repeated = F.col("_lb_repeated")
    return step.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join("_lb_split", "")).cast("long"),
        "n_symbols": count_of(raw, SYMBOLS).cast("long"),
        "n_exclaim": count_of(raw, "!").cast("long"),
        "n_upper": (F.length(raw) - F.length(F.regexp_replace(raw, r"\p{Lu}+", ""))).cast("long"),
        "n_lines": F.size("_lb_lines").cast("long"),
        "n_dup_lines": (F.size("_lb_lines") - F.size(F.array_distinct("_lb_lines"))).cast("long"),
        "n_repeat_words": F.when(F.size(repeated) == 0, 0)
        .otherwise(covered_words(windows, repeated, 3)).cast("long"),
    }).drop("_lb_split", "_lb_lines", "_lb_words", "_lb_windows", "_lb_sorted", "_lb_repeated")


def quality_ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their measurements and ``failures``, one bit for each failed rule.

    All columns pass through, except that those named as a measurement or ``failures`` are
    replaced. Every row stands for itself: repeated rows and null ids stay, an empty or null
    text fails the rules on few words, and no rows give no rows.
    """
    bits = [F.shiftleft(F.expr(r.fails).cast("int"), i) for i, r in enumerate(RULES)]
    clean = docs.drop("failures", *[m for m in MEASURES if m != text])
    return measured(clean, text).withColumn("failures", sum(bits, F.lit(0)))


def kept(policy: str = "1") -> Column:
    """Whether a row of a ledger passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy))) == 0


def ablation(ledger: DataFrame, policy: str = "1") -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that fail nothing else of
    it, which the policy without this rule would keep. Masks are counted once, at most
    ``2**len(RULES)`` of them, and then read for every rule."""
    masks = ledger.groupBy("failures").agg(F.count("*").alias("n"))
    held = F.col("failures").bitwiseAND(F.lit(mask(policy)))
    rows = [F.struct(F.lit(r.name).alias("rule"),
                     F.when(held.bitwiseAND(F.lit(1 << i)) != 0, F.col("n")).otherwise(0)
                     .alias("failed"),
                     F.when(held == (1 << i), F.col("n")).otherwise(0).alias("alone"))
            for i, r in enumerate(RULES) if r.name in POLICIES[policy]]
    return (masks.select(F.explode(F.array(*rows)).alias("x")).groupBy("x.rule")
            .agg(F.sum("x.failed").alias("failed"), F.sum("x.alone").alias("alone")))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM d),
g AS (SELECT r, i, w[i:i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
f AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
v AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM f)
      GROUP BY r),
m AS (SELECT d.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l.l) - len(list_distinct(l.l)) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
             len(l.l) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaim,
             length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_upper
      FROM d JOIN w USING (r) JOIN l USING (r) LEFT JOIN v USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_exclaim > n_words OR 10 * n_upper > 3 * word_chars
            OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""


@query("op8_quality_ledger", SQL)
def op8_quality_ledger(spark, sf_dir):
    """The ledger of all documents and the verdict of policy 1."""
    ledger = quality_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", (~kept("base")).alias("base_failed"),
                         kept("1").alias("kept"))
