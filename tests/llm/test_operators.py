"""Every operator on a small table of odd rows, and against brute force or its SQL."""

import collections
import hashlib
import math
import os
import pathlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(pathlib.Path(__file__).parents[2]), os.environ.get("PYTHONPATH", "")])

from latebook.llm import (  # noqa: E402
    chat, context_tree, decontamination, licenses, lines, packing, quality, sharding, shingles,
    simhash, toxicity,
)
from latebook.llm.queries import ORACLES, QUERIES  # noqa: E402
from latebook.llm.text import relieve  # noqa: E402
from latebook.llm.tokens import encoder, tokenizer_path  # noqa: E402
from tools.compare import database, difference  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: doc_id, text, lang, source, n_chars and columns whose names could clash
ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, n int"
LONG = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, PASSAGE, "en", "a", 1, "s", 1), (1, PASSAGE, "en", "a", 1, "s", 1),
    (2, PASSAGE.replace("six", "sixth"), "en", "a", 1, None, None), (3, "", "en", None, 0, "", 0),
    (4, None, None, None, None, None, None), (None, "no id here at all", "fr", "b", 2, "x", 2),
    (5, LONG, "en", "c", 3, "y", 3), (6, "x\n\n x \nX\r\n", "de", "c", 4, "z", 4),
    (7, PASSAGE.upper() + "\n" + PASSAGE + " thirteen", "en", "a", 5, "q", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, ODD)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, name):
    assert difference(QUERIES[name](spark, SF), database(SF), ORACLES[name]) is None


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = "a b c d e f".split()
    docs = [(i, "\n".join(" ".join(rng.choice(words, rng.integers(1, 9))) for _ in range(4)))
            for i in range(40)]
    seen, want = [], collections.defaultdict(list)
    for i, text in docs:
        for k, line in enumerate(text.split("\n")):
            mine = line.split()
            if any(mine == x or (min(len(mine), len(x)) >= lines.LEAST and edits(mine, x) <= 1)
                   for x in seen):
                want[i].append(k)
            seen.append(mine)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["gone"] for r in lines.with_removed(df).select(
        "doc_id", lines.numbers("_lb_gone").alias("gone")).collect()}
    assert {k: v for k, v in got.items() if v} == dict(want)


def test_lines_on_odd_rows(odd, none):
    out = lines.dedupe_lines(odd)
    assert out.columns == odd.columns and lines.dedupe_lines(none).count() == 0
    texts = collections.Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert texts[(1, PASSAGE)] == 2 and (2, ROWS[2][1]) not in texts  # one word changed
    assert (7, PASSAGE + " thirteen") not in texts and texts[(3, "")] == texts[(4, None)] == 1


def test_simhash_against_brute_force(spark):
    found = simhash.op3_simhash_bytes(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    import xxhash
    for r in found:
        words = texts[r["doc_id"]].encode().translate(LOWER).split()
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert r["fingerprint"] == f"{bits:016x}"
    assert components(found) == {r["doc_id"]: r["component_id"] for r in found}


def components(found):
    fps = {r["doc_id"]: int(r["fingerprint"], 16) for r in found}
    label = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            low = min(label[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 4)
            if low < label[a]:
                label[a], changed = low, True
    return label


def test_long_postings_lose_no_link(spark):
    """A crowd around one fingerprint goes the way without pairs; both ways agree."""
    rng = np.random.default_rng(5)
    base, fps = 0x0123456789ABCDEF, set()
    while len(fps) < 150:
        flips = rng.choice(64, rng.integers(0, 6), replace=False)
        fps.add(base ^ sum(1 << int(b) for b in flips))
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 50)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    want = {}
    label = {f: f for (f,) in signed}
    changed = True
    while changed:
        changed = False
        for a in label:
            low = min(label[b] for b in label
                      if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
            if low < label[a]:
                label[a], changed = low, True
    want = {f: v for f, v in label.items() if list(label.values()).count(v) > 1}
    for long in (4, 1000):
        got = simhash.components(simhash.links_of(df, long=long)).collect()
        assert {r["node"]: r["component"] for r in got} == want


def test_simhash_on_odd_rows(odd, none):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(ROWS) and simhash.near_duplicates(none).count() == 0
    of = {r["doc_id"]: r["component_id"] for r in found}
    assert of[3] == of[4] == 3 and of[1] == 1
    kept = shingles.one_of_each(odd, 5)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(None) == 1 and 4 not in ids


def brute_copies(texts, words=5):
    """The smallest id of each group of texts whose shingles are alike at 0.8."""
    sets = {}
    for i, text in texts.items():
        w = (text or "").encode().translate(LOWER).split()
        k = min(words, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    near = {a: [b for b in sets if sets[a] == sets[b] or 5 * len(sets[a] & sets[b])
                >= 4 * len(sets[a] | sets[b])] for a in sets}
    label, changed = {a: a for a in sets}, True
    while changed:
        changed = False
        for a in sets:
            low = min(label[b] for b in near[a])
            if low < label[a]:
                label[a], changed = low, True
    return label


@pytest.mark.parametrize("long", [64, 4])
def test_near_dedup_stage_against_brute_force(spark, long):
    """Copies with more and more words changed, far beyond four bits; crowds go both ways."""
    rng = np.random.default_rng(11)
    texts = {}
    for family in range(12):
        base = [f"w{x}" for x in rng.integers(0, 4000, rng.integers(6, 150))]
        for edits_made in (0, 0, 1, 1, 1, 2, 2, 3, 4, 5):
            words = list(base)
            for at in rng.integers(0, len(words), edits_made):
                words[at] = f"e{rng.integers(0, 10**6)}"
            texts[len(texts)] = " ".join(words)
    texts |= {200: "", 201: None, 202: "a b", 203: "A  b", 204: "a b c"}
    want = brute_copies(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = collections.defaultdict(set)
    for r in shingles.near_copies(df, 5, long).collect():
        found[r["component"]].add(r["doc_id"])
    groups = collections.defaultdict(set)
    for i, low in want.items():
        groups[low].add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))
    import corpus_pipeline
    kept = corpus_pipeline.near_dedup(spark, df, SF).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(groups)


def test_near_dedup_uses_the_byte_position_index(spark):
    """The index links what lies within four bits; only pairs that it left apart are checked later."""
    rng = np.random.default_rng(13)
    base = [f"w{x}" for x in rng.integers(0, 4000, 3000)]
    texts = {i: " ".join([*base[:i], f"e{i}", *base[i + 1:]]) for i in range(12)}
    texts |= {20: " ".join(base[:2000]), 21: " ".join(base[5:40]), 22: " ".join(base[5:40]).upper()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    marked = shingles.marked_sets(df, 5, np.zeros(0, np.uint64)).cache()
    fp = {r["sig"]: r["fp"] for r in marked.collect()}
    assert fp == {shingles.signature(shingles.shingle_set(t, 5)): simhash.fingerprint(t, 5)
                  for t in texts.values()}
    found = shingles.fingerprint_links(marked).collect()

    def joined(pairs):
        groups = {s: {s} for s in fp}
        for a, b in pairs:
            both = groups[a] | groups[b]
            groups.update((s, both) for s in both)
        return sorted({tuple(sorted(g)) for g in groups.values()})

    want = joined([(a, b) for a in fp for b in fp if ((fp[a] ^ fp[b]) & (1 << 64) - 1).bit_count() <= 4])
    assert joined(map(tuple, found)) == want and len(want) < len(fp)
    groups = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "a long, b long")
    assert sorted(map(tuple, shingles.apart(pairs, groups).collect())) == [(2, 3), (4, 5)]


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: exact.encode(r["text"], add_special_tokens=False).ids + [0]
            for r in docs.collect()}
    pieces = packing.pack_documents(docs).collect()
    got, windows = collections.defaultdict(list), collections.defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert p["start"] == len(got[p["doc_id"]]) and p["length"] == len(p["ids"])
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        got[p["doc_id"]] += p["ids"]
        assert p["doc_tokens"] == len(want[p["doc_id"]])
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
    assert got == want
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    report = packing.padding_report(packing.pack_documents(docs)).first()
    assert report["padding"] < 0.02 * report["tokens"]


def test_packing_on_odd_rows(odd, none):
    pieces = packing.pack_documents(odd, with_ids=False).collect()
    per = collections.Counter()
    for p in pieces:
        per[p["doc_id"]] += p["length"]
    assert per[3] == per[4] == 1 and None in per
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b", "x \n y", "\n \n", "a <|endoftext|> b", "tab\t x",
                                  " lead", "trail ", "don't I'll  go", "a  b", "\x85 k j"])
def test_tokens_word_by_word(text):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert next(iter(encoder()([text]))).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_differencing():
    sizes = [int(x) for x in np.random.default_rng(1).integers(1, 128, 400)]
    windows = packing.windows_for(sizes, 1024)
    assert sorted(i for w in windows for i in w) == list(range(400))
    assert max(sum(sizes[i] for i in w) for w in windows) <= 1024
    assert packing.windows_for([1024], 1024) == [[0]]


def test_licenses_against_brute_force(spark, odd, none):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    extra = [(90, "cc by nc cc by nc-sa CC-BY_NC", "", "", 0, "", 0),
             (91, "Under THE mit License: K. SPDX-License-Identifier: BSD-3-Clause", "", "", 0, "", 0)]
    docs = odd.union(spark.createDataFrame(extra, ODD))
    for r in licenses.scan_licenses(docs).collect():
        words = word.findall((r["text"] or "").encode().translate(LOWER).decode())
        starts = [i for p in licenses.PHRASES for i in range(len(words))
                  if words[i:i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(starts))
        assert r["first_word"] == min(starts, default=None)
        assert r["last_word"] == max(starts, default=None)
        spans = [(d["start"], d["end"]) for d in r["detections"]]
        assert not any(a != b and a[0] >= b[0] and a[1] <= b[1] for a in spans for b in spans)
    found = {r["doc_id"]: [d["label"] for d in r["detections"]]
             for r in licenses.scan_licenses(docs).collect()}
    assert found[90] == ["cc-by-nc", "cc-by-nc-sa", "cc-by-nc"]
    assert found[91] == ["mit", "bsd-3-clause"]
    assert licenses.scan_licenses(none).count() == 0 and len(licenses.rules()) > 300


def test_licenses_by_id_bare_name_and_body(spark):
    gpl = "GNU {}General Public License as published by the Free Software Foundation, either version {}"
    said = {"SPDX-License-Identifier: " + k: v for k, v in {
        "MIT": "mit", "ISC": "isc", "Zlib": "zlib", "BSL-1.0": "bsl-1", "EPL-2.0": "epl-2",
        "Artistic-2.0": "artistic-2", "GPL-2.0-or-later": "gpl-2", "LGPL-2.1-only": "lgpl-2.1",
        "MPL-2.0": "mpl-2", "MIT-0": "mit-0", "0BSD": "0bsd", "BSD-2-Clause": "bsd-2-clause",
        "Apache-2.0": "apache-2"}.items()} | {
        "licensed under MIT": "mit", "MIT licensed": "mit", "licensed under the ISC": "isc",
        "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
        "Redistribution and use in source and binary forms, with or without\n# modification, "
        "are permitted": "bsd", gpl.format("", "3 of the License"): "gpl-3",
        gpl.format("", "2 of the License"): "gpl-2", gpl.format("Lesser ", "2.1"): "lgpl-2.1",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted": "isc"}
    df = spark.createDataFrame(list(said.items()) + [("MIT researchers took a ruby", None)],
                               "text string, want string")
    got = {r["text"]: ([d["label"] for d in r["detections"]], r["want"])
           for r in licenses.scan_licenses(df).collect()}
    assert {t: x for t, (x, want) in got.items() if x != ([want] if want else [])} == {}


def test_chat_reads_back(spark):
    said = ["</s>[INST] ok [/INST]", "a\\", "<|im_end|>\n", "<", "\\<|", "<\\|", "é\U0001f600<|", "", None]
    rows = [(c, t, role, x) for c, x in enumerate(said)
            for t, role in enumerate(["system\n", "user", "assistant", None, "assistant"])]
    rows += rows[:3] + [(None, None, "assistant", "no id")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    groups = collections.defaultdict(list)
    for c, t, role, x in rows:
        groups[c].append((-1 if t is None else t, role or "", x or ""))
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        text = "".join(f"{role}\n{x}\n" for _, role, x in turns)
        r = got[c]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert not any(c in chat.escape(x or "") for x in said for c in chat.CONTROL)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_shards(spark, odd, none):
    placed = sharding.op7_shard_histogram(spark, SF).collect()
    total = collections.Counter()
    slots = collections.defaultdict(list)
    for r in placed:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    largest = max(r["size"] for r in placed)
    assert max(total.values()) - min(total.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    out = sharding.shard_documents(odd)
    assert set(out.columns) == {*odd.columns, "shard", "slot"} and out.count() == len(ROWS)
    assert sharding.shard_documents(none).count() == 0
    same = spark.range(400).selectExpr("id doc_id", "'same text' text")
    counts = [r["count"] for r in sharding.shard_documents(same).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 2


def test_quality(odd, none):
    found = {r["doc_id"]: r for r in quality.quality_ledger(odd).collect()}
    assert found[3]["n_words"] == found[4]["n_words"] == 0 and found[6]["n_dup_lines"] == 0
    assert quality.quality_ledger(none).count() == 0
    report = {r["rule"]: r for r in quality.ablation(quality.quality_ledger(odd)).collect()}
    assert report["few_words"]["failed"] == len(ROWS) - 1


def test_repeated_windows_both_ways(spark, monkeypatch):
    text = " ".join(["a b c d"] * 5 + [f"u{i}" for i in range(60)] + ["x y z x y z q"])
    words = text.split()
    counts = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    want = len({p for i, g in enumerate(zip(words, words[1:], words[2:], strict=False))
                if counts[g] > 1 for p in (i, i + 1, i + 2)})
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for bound in (64, 0):
        monkeypatch.setattr(quality, "LOOK_UP", bound)
        assert quality.measured(df).first()["n_repeat_words"] == want


def test_decontamination_on_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, PASSAGE, "x"), (2, "", "x"), (3, None, "x"), (None, "no id", "x"),
                                   (1, PASSAGE, "x")], "item_id long, text string, similarity string")
    found = {(r["doc_id"], r["item_id"]): r["similarity"]
             for r in decontamination.find_items(odd, bench).collect()}
    assert found == {(1, 1): 1.0, (7, 1): 1.0, (None, None): 1.0}
    kept = decontamination.without_items(odd, bench)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 5, 6}
    assert decontamination.find_items(none, bench).count() == 0
    assert decontamination.without_items(odd, bench.limit(0)).count() == len(ROWS)


def test_toxicity(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    scored = toxicity.score_texts(docs, model).join(labels, "doc_id").collect()
    unseen = [r for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    hit = [r["score"] >= toxicity.CUT for r in unseen if r["toxic"] == 1]
    false = [r["score"] >= toxicity.CUT for r in unseen if r["toxic"] == 0]
    # some labels of this table mark texts without any trace of toxic words
    assert np.mean(hit) > 0.85 and np.mean(false) < 0.005
    out = toxicity.score_texts(odd, model)
    assert set(out.columns) == set(odd.columns) and out.count() == len(ROWS)
    assert toxicity.score_texts(none, model).count() == 0
    kept = toxicity.reject_toxic(odd.withColumn("toxic", odd["n"]), labels)
    assert kept.columns == [*odd.columns, "toxic"]
    assert sorted(map(str, kept.drop("toxic").collect())) == sorted(map(str, odd.collect()))
    assert toxicity.reject_toxic(none, labels).count() == 0
    untaught = toxicity.train(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score_texts(odd, untaught).collect()} == {0.5}


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """A word of toxic rows beyond the first 1500 by hash counts, also where shards are averaged."""
    ids = spark.range(7000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    first = {r["doc_id"] for r in ids.filter(~held & (F.col("doc_id") % 2 == 1)).orderBy("h").limit(1500).collect()}
    docs = spark.createDataFrame(
        [(i, "plain words of " + ("calm" if i % 2 == 0 else "alpha" if i in first else "omega"), "en")
         for i in range(7000)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (docs["doc_id"] % 2).cast("int").alias("toxic"))
    assert toxicity.learnable(docs, labels).count() == docs.filter(~held).count()
    for rows in (2000, 500):
        monkeypatch.setattr(toxicity, "SHARD_ROWS", rows)
        model = toxicity.train(docs, labels)
        calm, alpha, omega = model.scores([f"plain words of {w}" for w in ("calm", "alpha", "omega")])
        assert calm < 0.5 and alpha >= toxicity.CUT and omega >= toxicity.CUT


def test_training_leaves_neither_shuffles_nor_models_behind(spark):
    """Each round's shuffle and the model that it sent are gone when the round is over."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = list(env.blockManager().diskBlockManager().localDirsString())

    def kept():
        files = {f.name for x in folders for f in pathlib.Path(x).rglob("shuffle_*.data")}
        return files, env.memoryManager().storageMemoryUsed()

    docs = spark.range(6000).selectExpr("id doc_id", "concat('text ', id % 90) text", "'en' lang")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) toxic")
    files, used = kept()
    toxicity.train(docs, labels)
    for _ in range(50):  # both are dropped in the background
        left, now = kept()
        if left <= files and now - used < 4 << 20:
            break
        time.sleep(0.1)
    assert left <= files and now - used < 4 << 20


def test_decontamination_plans_stay_small(spark):
    """What finds the items is written in steps, not planned as one query with that of the texts."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "k l m n o p q r s t")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c d e f g h i j")], "item_id long, text string")
    left = decontamination.without_items(docs, bench)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Aggregate" not in plan
    assert [r["doc_id"] for r in left.collect()] == [2]


class _Jvm:
    """A driver's JVM with so much of its heap of 100 in use."""
    def __init__(self, used):
        self.collections = 0
        self.java = self.lang = self.Runtime = self.System = self.sparkContext = self._jvm = self
        self.totalMemory, self.freeMemory, self.maxMemory = (lambda: used + 5), (lambda: 5), (lambda: 100)

    def getRuntime(self):
        return self

    def gc(self):
        self.collections += 1


def test_a_full_heap_is_collected_between_queries():
    for used, times in ((20, 0), (30, 1)):
        jvm = _Jvm(used)
        assert relieve(jvm) == bool(times) and jvm.collections == times


def test_words_are_hashed_together_as_one_by_one():
    texts = ["Été über " + "x" * 300 + " " + "é" * 70 + " 日本語テキスト 😀😀😀😀😀😀 a", "", "...", " a a-b c\x00d \ud800"]
    words = toxicity.read_words(texts)
    split = [w for t in texts for w in t.encode("utf-8", "replace").translate(toxicity._TABLE).split()]
    assert len(words.at) == len(split) + 2 + 2 * len(texts)  # an empty text has a place, and gaps follow
    for word, at in zip(split, words.at[words.at > 0], strict=True):
        want = [zlib.crc32(word, 1), zlib.crc32(word, 2),
                *(zlib.crc32(word.decode()[:n].encode(), n) for n in toxicity.PREFIXES)]
        assert words.hashes[at].tolist() == [h % toxicity.BUCKETS for h in want]


def brute_score(model, text):
    """The score of a text, place by place."""
    words = text.encode().translate(toxicity._TABLE).split()

    def vector(word):
        named = word.decode("utf-8", "replace")
        sides = [zlib.crc32(word, seed) for seed in (1, 2)]
        sides += [zlib.crc32(named[:n].encode(), n) for n in toxicity.PREFIXES]
        return sum(model.rows[i][h % toxicity.BUCKETS] for i, h in enumerate(sides))

    places = [vector(w) for w in words] or [np.zeros(toxicity.DIM)]
    z = model.offset
    for k, width in enumerate(toxicity.WIDTHS):
        values = [sum((places[i + j] @ model.filters[width][j] for j in range(width) if i + j < len(places)),
                      np.zeros(toxicity.FILTERS)) for i in range(len(places))]
        top = -np.sort(-np.array(values), axis=0)[:toxicity.POOLED]
        z += (np.maximum(top + model.bias[width], 0) * model.out[k][:len(top)]).sum()
    return 1 / (1 + math.exp(-z))


@pytest.mark.parametrize("places", [1 << 16, 5])
def test_convolution_and_pooling_against_brute_force(monkeypatch, places):
    monkeypatch.setattr(toxicity, "PLACES", places)
    rng = np.random.default_rng(9)
    vocabulary = [f"word{i}" for i in range(30)] + ["Été", "über"]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (1, 2, 3, 17, 40, 5)] + ["", "..."]
    model = toxicity.fit(texts * 4, np.array([1, 0] * 16), epochs=2, batch=8)
    want = [brute_score(model, t) for t in texts]
    assert np.allclose(model.scores(texts), want, atol=1e-5) and len(set(np.round(want, 3))) > 2


def test_rows_that_agree_in_text_and_id_are_dealt_one_by_one(spark):
    rows = spark.range(4000).selectExpr("cast(null as long) doc_id", "'the same text' text").union(
        spark.range(600).selectExpr("id doc_id", "concat('text ', id) text"))
    placed = sharding.shard_documents(rows).collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in placed:
        size[r["shard"]] += len(r["text"]) + 1
        slots[r["shard"]].append(r["slot"])
    assert len(placed) == 4600 and len(size) == 8 and max(size.values()) - min(size.values()) <= 60
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_near_dedup_keeps_a_row_of_every_group(spark):
    """Unlike texts under one id, and rows without an id, all have groups of their own."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (2, a + " more"), (None, a), (None, "d " + c), (None, "e f g h i j")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, shingles.one_of_each(df, 5).collect()), key=str) == sorted(
        [(1, a), (1, b), (2, c), (None, "e f g h i j")], key=str)
    texts = df.selectExpr("cast(doc_id as string) || 'x' doc_id", "text")
    assert shingles.one_of_each(texts, 5).count() == 4
    assert simhash.near_duplicates(texts).count() == len(rows)


def brute_tree(train, texts, depth):
    """Context-tree weighting node by node."""
    import functools
    import math
    counts, longer = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)

    def walk(text):
        data = bytes(depth) + text + b"\0"
        for i in range(depth, len(data)):
            for bit in range(8):
                yield [data[i - k:i] for k in range(depth + 1)], (256 | data[i]) >> (8 - bit), \
                    data[i] >> (7 - bit) & 1

    for text in train:
        for contexts, node, bit in walk(text):
            for k, c in enumerate(contexts):
                counts[c, node][bit] += 1
                if k < depth:
                    longer[c, node].add(contexts[k + 1])

    def own(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    @functools.cache
    def mixed(c, node):
        if (c, node) not in counts:
            return 0.0
        mine = own(*counts[c, node])
        if len(c) == depth:
            return mine
        return float(np.logaddexp(mine, sum(mixed(x, node) for x in longer[c, node])) - math.log(2))

    def chance(contexts, node, bit, k=0):
        n = counts.get((contexts[k], node), [0, 0])
        mine = (n[bit] + .5) / (sum(n) + 1)
        if k == depth:
            return mine
        below = sum(mixed(x, node) for x in longer.get((contexts[k], node), ()))
        weight = 1 / (1 + math.exp(min(700, max(-700, below - own(*n)))))
        return weight * mine + (1 - weight) * chance(contexts, node, bit, k + 1)

    return [sum(math.log10(chance(c, node, bit)) for c, node, bit in walk(t)) for t in texts]


@pytest.mark.parametrize("block", [context_tree.BLOCK, 40])
def test_context_tree_against_brute_force(spark, block):
    import math
    texts = ["Hello hello world", "abc abc abd", "", "héllo wörld", None, "the cat the cat"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in context_tree.score_documents(df, block).collect()}
    low = [(t or "").encode().translate(LOWER) for t in texts]
    out = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    train = [t for t, o in zip(low, out, strict=True) if not o]
    counts = collections.Counter(w for t in train for w in (*t.split(), b""))
    total = sum(counts.values())
    for i, (text, score) in enumerate(zip(low, brute_tree(train, low, context_tree.DEPTH), strict=True)):
        words = [*text.split(), b""]
        base = sum(math.log10((counts[w] + .5) / (total + .5 * (len(counts) + 1))) for w in words)
        r = got[i]
        assert r["held_out"] == out[i] and r["n_tokens"] == len(words)
        assert r["n_known"] == sum(counts[w] > 0 for w in words) and r["train_tokens"] == total
        assert abs(r["base_score"] - base) < 1e-9 and abs(r["score"] - score) < 1e-8 * (1 - score)


def memory_of(run):
    """Bytes that Python, numpy and Arrow held at once, at most."""
    import tracemalloc

    import pyarrow as pa
    usual = pa.default_memory_pool()
    pool = pa.proxy_memory_pool(usual)
    pa.set_memory_pool(pool)
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] + pool.max_memory()
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(usual)


def test_context_tree_steps_hold_little_memory():
    """Two workers share an executor with its JVM: what a task holds beside its block is bounded."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    vocabulary = np.array(["".join(rng.choice(list("abcdefghij"), n)) for n in rng.integers(2, 9, 20_000)])
    texts = [" ".join(vocabulary[rng.integers(0, 20_000, 300)]) for _ in range(2500)]  # 4.5 MB
    out = [i % 5 == 1 for i in range(len(texts))]
    block = pa.table({"block": pa.array([0] * len(texts), pa.int64()), "doc_id": pa.array(range(len(texts))),
                      "text": texts, "held_out": out})
    noise = rng.integers(97, 123, (3000, 1000), np.uint8)  # hardly a run occurs twice
    unlike = pa.table({"text": [row.tobytes().decode() for row in noise], "held_out": [False] * len(noise)})
    assert memory_of(lambda: sum(map(len, context_tree.count_runs(iter(unlike.to_batches(500)))))) < 80e6
    assert memory_of(lambda: context_tree.ask_runs(block)) < 24e6
    assert memory_of(lambda: context_tree.ask_words(block)) < 16e6
    runs, words = context_tree.ask_runs(block)["run"], context_tree.ask_words(block)
    kinds = {"run": pa.int64(), "f": pa.float64(), "word": pa.binary(), "n": pa.int64(), "c": pa.int64(),
             "own": pa.bool_()}
    found = [{"run": runs, "f": pa.array(-rng.random(len(runs)))},
             {"word": words["word"], "n": words["n"], "c": words["n"], "own": pa.array([True] * len(words))}]
    answers = pa.concat_tables(pa.table({k: f.get(k, pa.nulls(len(next(iter(f.values()))), t))
                                         for k, t in kinds.items()}) for f in found)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("word_logs", pa.float64()), ("score", pa.float64()),
                        ("n_bytes", pa.int64()), ("part_tokens", pa.int64()), ("part_words", pa.int64())])
    score = context_tree.score_block(schema)
    assert memory_of(lambda: score(block, answers)) < 35e6
    scored = score(block, answers).to_pylist()
    learnt = [t for t, o in zip(texts, out, strict=True) if not o]
    assert [r["doc_id"] for r in scored] == [*range(len(texts)), None]
    assert all(r["n_tokens"] == 301 and r["n_bytes"] == len(t) for r, t in zip(scored, texts, strict=False))
    assert scored[-1]["part_tokens"] == 301 * len(learnt)
    assert scored[-1]["part_words"] == len({w for t in learnt for w in t.split()}) + 1


def test_steps_of_texts_lose_no_row():
    import pyarrow as pa
    texts = ["", "ab", "c" * 50, "", "de", "f" * 9, "é" * 4, ""]
    for size in (1, 4, 10, 1000):
        parts = [texts[rows] for rows in context_tree.steps(pa.chunked_array([texts[:3], texts[3:]]), size)]
        assert sum(parts, []) == texts and all(parts)
        assert all(len(p) == 1 or sum(len(t.encode()) for t in p) <= size for p in parts)
    assert list(context_tree.steps(pa.array([], pa.string()))) == []


def test_context_tree_on_odd_rows(odd, none):
    assert context_tree.score_documents(odd).count() == len(ROWS)
    assert context_tree.score_documents(none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS and 0 < out.count() <= docs.count(), name
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.count() > 0
