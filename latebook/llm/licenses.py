"""License scan: ordered signature rules gated by keywords, overlaps resolved by intervals."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import NOT_ALNUM, plain, word_count, words_of

#: Fixed by the result contract: phrases of words and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Families: a label, the keyword without which no rule of it is tried, and how texts of words
#: name it. Earlier families have priority over later ones in equal intervals, so the narrower
#: comes first.
FAMILIES = (
    ("agpl-3", "affero", r"(?:gnu )?affero general public license(?: v| version )?(?: ?3(?: 0)?)?"),
    ("lgpl-3", "lesser", r"(?:gnu )?lesser general public license(?: v| version )? ?3(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: v| version )? ?2(?: 1)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    ("gpl-3", "general", r"(?:gnu )?general public license(?: v| version )? ?3(?: 0)?"),
    ("gpl-2", "general", r"(?:gnu )?general public license(?: v| version )? ?2(?: 0)?"),
    ("gpl", "general", r"gnu general public license"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license(?: version 1 \d)?"),
    ("agpl-3", "agpl", r"agpl(?: ?v?3(?: 0)?)?"),
    ("lgpl", "lgpl", r"lgpl(?: ?v?[23](?: [01])?)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl ?v?3(?: 0)?"),
    ("gpl-3", "gplv3", r"(?:gnu )?gplv3"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl ?v?2(?: 0)?"),
    ("gpl-2", "gplv2", r"(?:gnu )?gplv2"),
    ("apache-2", "apache", r"apache(?: software)? license(?: v| version)? ?2(?: 0)?"),
    ("apache-2", "apache", r"apache 2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: v| version)? ?1 1"),
    ("apache", "apache", r"apache(?: software)? license"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?"),
    ("0bsd", "0bsd", r"0bsd|zero clause bsd"),
    ("bsd", "bsd", r"bsd(?: style)? license"),
    ("mit-0", "mit", r"mit (?:no attribution|0)(?: license)?"),
    ("mit", "mit", r"mit license"),
    ("x11", "x11", r"x11 license"),
    ("mit", "expat", r"expat license"),
    ("isc", "isc", r"isc license"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("mpl-2", "mozilla", r"mozilla public license(?: v| version)? ?2(?: 0)?"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: v| version)? ?1 1"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("mpl-2", "mpl", r"mpl ?v?2(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?: v| version)? ?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license(?: v| version)? ?1(?: 0)?"),
    ("epl", "eclipse", r"eclipse public license"),
    ("cddl", "distribution", r"common development and distribution license(?: version 1 [01])?"),
    ("artistic-2", "artistic", r"artistic license(?: version)? ?2(?: 0)?"),
    ("artistic", "artistic", r"artistic license"),
    ("bsl-1", "boost", r"boost software license(?: version)?(?: 1 0)?"),
    ("busl-1.1", "business", r"business source license(?: version)?(?: 1 1)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("python-2", "python", r"python software foundation license(?: version 2)?"),
    ("ruby", "ruby", r"ruby license"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("ofl-1.1", "font", r"(?:sil )?open font license(?: version)?(?: 1 1)?"),
    ("eupl", "european", r"european union public licen[cs]e(?: v| version)?(?: ?1 \d)?"),
    ("odbl", "database", r"open database license(?: version)?(?: ?1 0)?"),
    ("odc-by", "commons", r"open data commons attribution license"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: \d \d)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: \d \d)?"),
    ("cc-by-nc", "cc", r"cc by nc(?: \d \d)?"),
    ("cc-by-nd", "cc", r"cc by nd(?: \d \d)?"),
    ("cc-by-sa", "cc", r"cc by sa(?: \d \d)?"),
    ("cc-by", "cc", r"cc by(?: \d \d)?"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial"),
    ("cc-by-nc-sa", "commercial", r"creative commons attribution non commercial share ?alike"),
    ("cc-by-nc", "commercial", r"creative commons attribution non commercial"),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike"),
    ("cc-by-sa", "alike", r"creative commons attribution share alike"),
    ("cc-by", "creative", r"creative commons attribution(?: \d \d)?(?: international)?"),
    ("public-domain", "domain", r"public domain"),
    ("all-rights-reserved", "reserved", r"all rights reserved"),
)

#: What a license is called where the words around it say that it is one: its SPDX id as words, or
#: its bare name. Only ``SHORT_FORMS`` apply. The longer ids come first.
SHORT = (
    ("agpl-3", "agpl", r"agpl 3 0(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl", r"lgpl 2 [01](?: only| or later)?"),
    ("gpl-3", "gpl", r"gpl 3 0(?: only| or later)?"),
    ("gpl-2", "gpl", r"gpl 2 0(?: only| or later)?"),
    ("gfdl", "gfdl", r"gfdl 1 \d(?: only| or later)?"),
    ("apache-1.1", "apache", r"apache 1 1"),
    ("bsd-2-clause", "bsd", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause"),
    ("0bsd", "0bsd", r"0bsd"),
    ("bsd", "bsd", r"bsd"),
    ("mit-0", "mit", r"mit 0"),
    ("mit", "mit", r"mit"),
    ("x11", "x11", r"x11"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib"),
    ("mpl-2", "mpl", r"mpl 2 0"),
    ("mpl-1.1", "mpl", r"mpl 1 1"),
    ("epl-2", "epl", r"epl 2 0"),
    ("epl-1", "epl", r"epl 1 0"),
    ("cddl", "cddl", r"cddl 1 [01]"),
    ("artistic-2", "artistic", r"artistic 2 0"),
    ("artistic", "artistic", r"artistic 1 0"),
    ("bsl-1", "bsl", r"bsl 1 0"),
    ("busl-1.1", "busl", r"busl 1 1"),
    ("python-2", "psf", r"psf 2 0"),
    ("python-2", "python", r"python 2 0"),
    ("ruby", "ruby", r"ruby"),
    ("postgresql", "postgresql", r"postgresql"),
    ("ofl-1.1", "ofl", r"ofl 1 1"),
    ("eupl", "eupl", r"eupl 1 \d"),
    ("odbl", "odbl", r"odbl 1 0"),
    ("odc-by", "odc", r"odc by 1 0"),
    ("ms-pl", "ms", r"ms pl"),
)

SHORT_FORMS = (
    ("spdx license identifier", r"spdx license identifier {}", 1.0),
    ("under", r"(?:dual |multi )?licen[cs]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{}",
     0.95),
    ("licen", r"{} licen[cs]ed", 0.9),
)

#: What licenses and their headers say without their name; such a text is a rule of its own.
BODIES = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "purpose", r"permission to use copy modify and(?: or)? distribute this software for any "
     r"purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without "
     r"modification are permitted"),
    ("zlib", "implied", r"this software is provided as is without any express or implied warranty "
     r"in no event will the authors be held liable"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    *((label, "either version", rf"{name} general public license(?: as published by the free "
       rf"software foundation)? either version {version}(?: 0)?(?: of the license)?")
      for label, name, version in (
          ("agpl-3", "gnu affero", "3"), ("lgpl-3", "gnu lesser", "3"),
          ("lgpl-2.1", "gnu lesser", "2 1"), ("gpl-3", "gnu", "3"), ("gpl-2", "gnu", "2"))),
)

#: How a text grants, names or identifies a license: the words around the name, and how sure a
#: detection is, after a hint that the form cannot do without. Longer contexts contain shorter ones, which interval containment then drops.
FORMS = (
    ("spdx license identifier", r"spdx license identifier {}", 1.0),
    ("under", r"(?:dual |multi )?licen[cs]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{}",
     0.95),
    ("under", r"(?:released|distributed|published|available|provided) under (?:the )?"
     r"(?:terms of (?:the )?)?{}", 0.95),
    ("under", r"under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{}", 0.9),
    ("see", r"see (?:the )?{}(?: for (?:more )?details)?", 0.8),
    ("", r"{}(?: license)?", 0.6),
)


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    hint: str
    regex: str
    sure: float


def rules() -> list[Rule]:
    """Every form of every family, in order of priority: hundreds of ordered signatures."""
    return [Rule(i * len(FORMS) + k, label, hint, rf"\b{form.format(f'(?:{name})')}\b", sure)
            for i, ((label, _, name), forms) in enumerate(signatures())
            for k, (hint, form, sure) in enumerate(forms)]


def signatures() -> list[tuple[tuple[str, str, str], tuple]]:
    """Label, keyword and name of every signature, with the forms it comes in."""
    return ([(f, FORMS) for f in FAMILIES] + [(f, SHORT_FORMS) for f in SHORT]
            + [(f, (("", "{}", 0.9),)) for f in BODIES])


#: Every text that a rule or phrase can match holds one of these, in lower case.
GATE = ("licen", "spdx", "cc0", "gpl", "mpl", "bsd", "wtfpl", "apache", "creative", "domain",
        "reserved", "attribution", "hereby", "redistribution", "implied", "unencumbered")
GATE_PATTERN = f"cc{NOT_ALNUM}by"


def _gate(low: Column) -> Column:
    """A cheap test that lets through every text in which a rule or phrase can match."""
    found = F.contains(low, F.lit("cc")) & low.rlike(GATE_PATTERN)
    for keyword in GATE:
        found = found | F.contains(low, F.lit(keyword))
    return found


def _detections(norm: Column) -> Column:
    """All places of all matching rules, as structs of an array."""
    families = F.from_json(  # one literal for the planner, however many rules there are
        F.lit(json.dumps([{"keyword": k, "name": rf"\b(?:{n})\b", "rules": [
            asdict(r) for r in rules() if r.number // len(FORMS) == i]}
            for i, ((_, k, n), _) in enumerate(signatures())])),
        "array<struct<keyword:string,name:string,rules:array<struct<number:int,label:string,"
        "hint:string,regex:string,sure:double>>>>")
    # by rising cost: the family's keyword, its name, the words of the form, the whole signature
    named = F.filter(families, lambda f: F.contains(norm, f["keyword"]) & F.rlike(norm, f["name"]))
    fitting = F.filter(F.flatten(F.transform(named, lambda f: f["rules"])),
                       lambda r: F.contains(norm, r["hint"]) & F.rlike(norm, r["regex"]))

    def places(rule: Column) -> Column:
        found = F.regexp_extract_all(norm, rule["regex"], F.lit(0))
        between = F.split(norm, rule["regex"], -1)
        lengths = F.zip_with(between, found, lambda b, f: F.struct(
            F.length(b).alias("b"), F.coalesce(F.length(f), F.lit(-1)).alias("f")))
        empty = F.array().cast("array<struct<start:int,end:int,number:int,label:string,sure:double>>")
        state = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.aggregate(lengths, state, lambda s, x: F.when(x["f"] < 0, s).otherwise(F.struct(
            (s["at"] + x["b"] + x["f"]).alias("at"),
            F.concat(s["out"], F.array(F.struct(
                (s["at"] + x["b"]).alias("start"), (s["at"] + x["b"] + x["f"]).alias("end"),
                rule["number"].alias("number"), rule["label"].alias("label"),
                rule["sure"].alias("sure")))).alias("out"))),
            lambda s: s["out"])

    return F.flatten(F.transform(fitting, places))


def _outermost(detections: Column) -> Column:
    """Without those inside another; of equal intervals the first rule stays.

    Sorted by start, then the longer, then the earlier rule, a detection lies inside an earlier
    one if and only if it ends no later than the furthest end so far.
    """
    ordered = F.sort_array(F.transform(detections, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("neg"), d["number"].alias("number"),
        d["label"].alias("label"), d["sure"].alias("sure"))))
    kept = "array<struct<start:int,end:int,number:int,label:string,sure:double>>"
    state = F.struct(F.lit(-1).alias("far"), F.array().cast(kept).alias("out"))
    return F.aggregate(ordered, state, lambda s, d: F.when(-d["neg"] <= s["far"], s).otherwise(
        F.struct((-d["neg"]).alias("far"), F.concat(s["out"], F.array(F.struct(
            d["start"].alias("start"), (-d["neg"]).alias("end"), d["number"].alias("number"),
            d["label"].alias("label"), d["sure"].alias("sure")))).alias("out"))),
        lambda s: s["out"])


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``norm`` (their words in lower case, one space between them, or null
    where the gate finds nothing), ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels`` and ``detections``: structs of ``start`` and ``end`` (characters of
    ``norm``), rule ``number``, ``label`` and ``sure``, none inside another.

    Columns of those names are replaced and all others pass through. Each row stands for itself;
    an empty or null text has no words and no detections. Nothing is shuffled.
    """
    new = ("norm", "n_words", "n_base", "first_word", "last_word", "base_labels", "detections")
    # lower() also changes other letters, but none that a phrase or a word border consists of
    lowered = F.lower(plain(docs[text]))
    out = docs.drop(*[c for c in new if c != text]).withColumn("_lb_low", lowered)
    out = out.withColumns({
        "n_words": F.size(words_of(F.col("_lb_low"), NOT_ALNUM)).cast("long"),
        "norm": F.when(_gate(F.col("_lb_low")),
                       F.trim(F.regexp_replace("_lb_low", NOT_ALNUM, " ")))})
    norm = F.col("norm")
    padded = F.concat(F.lit(" "), norm, F.lit(" "))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        has = F.contains(padded, F.lit(f" {phrase} "))
        count = F.when(has, F.regexp_count(padded, F.lit(f" {phrase}(?= )"))).otherwise(0)
        counts.append(F.coalesce(count, F.lit(0)))
        firsts.append(F.when(has, word_count(F.trim(F.substring_index(padded, f" {phrase} ", 1)))))
        after = word_count(F.trim(F.substring_index(padded, f" {phrase} ", -1)))
        lasts.append(F.when(has, F.col("n_words") - after - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    least = F.array_min(F.array(*[x.cast("long") for x in firsts]))
    most = F.array_max(F.array(*[x.cast("long") for x in lasts]))
    none = F.array().cast("array<struct<start:int,end:int,number:int,label:string,sure:double>>")
    return out.withColumns({
        "n_base": sum(counts, F.lit(0)).cast("long"), "first_word": least, "last_word": most,
        "base_labels": F.array_sort(F.array_compact(F.array(*labels))),
        "detections": F.when(norm.isNull(), none).otherwise(_outermost(_detections(norm))),
    }).drop("_lb_low")


@query("op5_license_rules")
def op5_license_rules(spark, sf_dir):
    """License phrases and rule labels of all documents."""
    scanned = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = F.array_sort(F.array_union("base_labels", F.transform("detections", lambda d: d["label"])))
    sure = F.coalesce(F.array_max(F.transform("detections", lambda d: d["sure"])), F.lit(0.0))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), sure.alias("score"),
        F.size("detections").alias("n_detections"))
