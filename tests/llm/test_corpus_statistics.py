"""Phrases, repeated passages and spelling variants against brute force, on odd and random rows."""

import collections
import hashlib
import os
import pathlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(pathlib.Path(__file__).parents[2]), os.environ.get("PYTHONPATH", "")])

from latebook.llm import phrases, spelling, suffixes  # noqa: E402
from latebook.llm.queries import QUERIES  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, n int, key string, word string, a long, score int"


def rows_of(*rows):
    """Rows with extra columns whose names the operators use themselves."""
    return [(*row, 1, "k", "w", 2, 3) for row in rows]


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(5)
    words = "New York city Été état the of and straße".split()
    texts = [" ".join(rng.choice(words, rng.integers(1, 40))) + rng.choice([".", "\n", " ; x"])
             for _ in range(300)]
    return spark.createDataFrame(rows_of(
        *((i, t, ["en", "de", None][i % 3]) for i, t in enumerate(texts)),
        (900, texts[0], "en"), (900, texts[0], "en"), (900, texts[1], "en"), (None, texts[2], "en"),
        (None, texts[3], None), (101, "", "en"), (102, None, None), (103, " \t.,;\n", "de"),
        (104, "the of and " * 30_000, "en"), (105, "x" * 5000, "en")), SCHEMA)


def brute_phrases(rows, least, keep=80):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\\x20\\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    candidates = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    most = collections.Counter()
    for (lang, p), v in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                most[lang, p[i:i + size]] = max(v, most[lang, p[i:i + size]])
    want = []
    for (lang, p), a in candidates.items():
        if 100 * most[lang, p] >= keep * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k)
                       for k in range(1, len(p)))
        want.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return sorted(want)


@pytest.mark.parametrize("least", [3, 30])
def test_phrases_against_brute_force(odd, least):
    got = sorted(map(tuple, phrases.mine_phrases(odd, least).collect()))
    assert got == brute_phrases([(r["text"], r["lang"]) for r in odd.collect()], least)
    assert len(got) > 5


def test_phrases_are_ranked(spark, odd):
    rows = phrases.best_phrases(odd, top=3).collect()
    by_lang = collections.defaultdict(list)
    for r in brute_phrases([(r["text"], r["lang"]) for r in odd.collect()], phrases.LEAST):
        by_lang[r[0]].append(r)
    assert {(r["lang"], r["rank"], r["phrase"]) for r in rows} == {
        (lang, i, r[1]) for lang, mine in by_lang.items()
        for i, r in enumerate(sorted(mine, key=lambda r: (-r[6], -r[2], r[1].encode()))[:3], 1)}
    assert phrases.best_phrases(odd.limit(0)).collect() == []


def test_products_beyond_64_bits_are_exact(spark):
    a, l, r = 4 * 10**18, 4 * 10**18 + 7, 4 * 10**18 + 9
    df = spark.createDataFrame([(a, [l], [r])], "f long, lefts array<long>, rights array<long>")
    assert df.select(phrases._lowest_cut().alias("c")).first()["c"]["score"] == (
        2_000_000 * a // (l + r))


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_slices_cut_between_pieces_only(size):
    texts = ["a b. c", "", "no border in this long piece at all", "x,y;z", "."]
    column = pa.array(texts, pa.binary())
    got = []
    for data, firsts, langs in phrases.slices(np.arange(len(texts)), column, size):
        words = phrases.Words(data, firsts, langs)
        assert len(firsts) == len(langs)
        got += [(lang, words.words[int(c)].as_py()) for lang, c in zip(words.lang, words.code)]
        if size >= 7:
            assert len(data) <= max(size, 36)
    want = [(i, w) for i, t in enumerate(texts) for w in re.split("[ .,;]+", t) if w]
    assert got == want


def test_a_small_bitmap_only_lets_more_through(odd, monkeypatch):
    want = sorted(map(tuple, phrases.mine_phrases(odd, 3).collect()))
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 5)
    monkeypatch.setattr(phrases, "COMMON", 3)
    assert sorted(map(tuple, phrases.mine_phrases(odd, 3).collect())) == want


def test_stripes_merge_elementwise():
    def stripes(*rows):
        lang, prefix, part, word, times = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(prefix), pa.array(part, pa.int32()),
                                           pa.array(word), pa.array([
                                               np.array(t, "<u4").tobytes() for t in times])],
                                          schema=phrases._STRIPE)
    a = stripes(("en", "x", 0, "a b", [1, 2**32 - 1]), ("de", "x", 0, "a", [4]))
    b = stripes(("en", "x", 0, "b c", [5, 6]), ("en", "y", 0, "a", [7]))
    merged = phrases.merge([phrases.entries_of(a), phrases.merge([phrases.entries_of(b)])])
    assert sorted(zip(*(x.tolist() for x in merged), strict=True)) == [
        ("de", "x", "a", 4), ("en", "x", "a", 1), ("en", "x", "b", 2**32 + 4), ("en", "x", "c", 6),
        ("en", "y", "a", 7)]


def brute_passages(rows, window):
    first = {}
    order = lambda d: (d is None, d if d is not None else 0)
    for doc, text in rows:
        for i in range(len(text) - window + 1):
            w = text[i:i + window]
            first[w] = min(first.get(w, order(doc)), order(doc))
    want = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - window + 1):
            if first[text[i:i + window]] < order(doc):
                gone[i:i + window] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        want.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(want, key=repr)


def passages(spark, seed=1):
    rng = np.random.default_rng(seed)
    letters = np.array(list("ab é"))
    shared = ["".join(rng.choice(letters, rng.integers(15, 120))) for _ in range(12)]
    rows = []
    for i in range(80):
        parts = [rng.choice(shared) if rng.random() < 0.6 else "".join(
            rng.choice(list("abcdefgh \n"), rng.integers(1, 60))) for _ in range(rng.integers(0, 6))]
        rows.append((int(rng.permutation(200)[0]) if i % 9 else None, "".join(parts), "en"))
    rows += [(5, "a" * 3000, "en"), (6, "a" * 2000 + "b" * 60, "en"), (7, "ab" * 700, "en"), (8, "", "en"),
             (9, None, None), (300, rows[1][1], "en"), (300, rows[1][1], "en"), (300, rows[2][1], "en")]
    return rows


@pytest.mark.parametrize("window,crowd", [(20, 1000), (50, 1000), (50, 2)])
def test_passages_against_brute_force(spark, monkeypatch, window, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rows = passages(spark)
    df = spark.createDataFrame(rows_of(*rows), SCHEMA).repartition(7)
    got = sorted(map(tuple, suffixes.passage_digests(df, window).collect()), key=repr)
    want = brute_passages([(d, (t or "").encode()) for d, t, _ in rows], window)
    assert got == want
    assert sum(r[2] for r in want) > 1000


def test_removed_passages_leave_valid_text(spark):
    common = "This passage stands in three documents and is fifty bytes or longer. "
    df = spark.createDataFrame(rows_of((1, "One. " + common + "é", "en"), (2, "Two. " + common, "en"),
                                       (None, common + "three", "en")), SCHEMA)
    got = {r["doc_id"]: r["text"] for r in suffixes.remove_passages(df).collect()}
    assert got[1].startswith("One. This") and got[2] == "Two" and got[None] == "three"
    texts = spark.createDataFrame([("b", common), ("a", common + "x")], "doc_id string, text string")
    assert {tuple(r) for r in suffixes.remove_passages(texts).collect()} == {
        ("a", common + "x"), ("b", "")}
    assert suffixes.remove_passages(df.limit(0)).collect() == []


def test_one_passage_in_many_documents(spark):
    rng = np.random.default_rng(2)
    common = "".join(rng.choice(list("abcdefghij "), 90))
    rows = [(i, "".join(rng.choice(list("klmnopqr "), 30)) + common
             + "".join(rng.choice(list("klmnopqr "), 30)), "en") for i in range(400)]
    df = spark.createDataFrame(rows_of(*rows), SCHEMA).coalesce(1)
    got = sorted(map(tuple, suffixes.passage_digests(df).collect()), key=repr)
    assert got == brute_passages([(d, t.encode()) for d, t, _ in rows], 50)


def test_spread_windows_meet_those_of_other_batches(spark):
    """Periodic runs of unlike lengths have their windows spread; each text is a batch of its own."""
    rows = [(1, "a" * 700, "en"), (2, "a" * 500, "en"), (3, "ab" * 300 + "a" * 400, "en"), (4, "ab" * 200, "en")]
    df = spark.createDataFrame(rows_of(*rows), SCHEMA)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        got = sorted(map(tuple, suffixes.passage_digests(df).collect()), key=repr)
    finally:
        spark.conf.set(name, before)
    assert got == brute_passages([(d, t.encode()) for d, t, _ in rows], 50)


def test_runs_hold_each_window_once_and_depend_on_bytes(monkeypatch):
    rng = np.random.default_rng(4)
    text = bytes(rng.integers(97, 101, 700, dtype=np.uint8)) + b"a" * 300 + b"abc" * 80
    of_window = {}
    for block in (suffixes.BLOCK, 128):
        monkeypatch.setattr(suffixes, "BLOCK", block)
        found = [x for part in suffixes.runs_of(text, 50) for x in zip(*map(np.ndarray.tolist, part))]
        places = [i for first, size, *_ in found for i in range(first, first + size)]
        assert places == list(range(len(text) - 49))
        assert block < 1000 or len(found) < len(places) / 8
        for first, size, key, packed in found:
            sides = {(side, packed >> side & 0xFFFF) for side in (0, 16)} - {(0, 0), (16, 0)}
            for i in range(first, first + size):
                of_window.setdefault(text[i:i + 50], []).append((key, sides))
    for i in range(0, len(text) - 49, 7):  # the same bytes alone
        (first, size, key, packed), = zip(*map(np.ndarray.tolist, next(suffixes.runs_of(text[i:i + 50], 50))))
        sides = {(side, packed >> side & 0xFFFF) for side in (0, 16)} - {(0, 0), (16, 0)}
        assert (first, size) == (0, 1) and sides
        assert all(k == key and sides <= s for k, s in of_window[text[i:i + 50]])


def brute_spelling(rows):
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}

    def near(x, y):
        if abs(len(x) - len(y)) > 1 or x == y:
            return False
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y, strict=True)) == 1
        x, y = sorted((x, y), key=len)
        return any(y[:i] + y[i + 1:] == x for i in range(len(y)))

    form, nears = {}, {}
    for x in n:
        mine = [y for y in n if near(x, y)]
        nears[x] = len(mine)
        if mine:
            best = min(mine, key=lambda y: (-n[y], y))
            if n[best] >= 10 * n[x]:
                form[x] = best
    want = []
    for x in n:
        root = x
        while root in form:
            root = form[root]
        want.append((x, form.get(x), root, n[x], nears[x], n[form[x]] if x in form else None))
    return sorted(want)


@pytest.mark.parametrize("most,widest", [(20_000, 256), (3, 256), (2, 2)])
def test_spelling_against_brute_force(spark, monkeypatch, most, widest):
    monkeypatch.setattr(spelling, "MOST", most)
    monkeypatch.setattr(spelling, "WIDEST", widest)
    rng = np.random.default_rng(6)
    stems = ["aaaaaaa", "aabbaab", "étéétéé", "bananas", "×letter÷", "streets", "a" * 400]
    texts = []
    for i in range(500):
        stem = stems[min(len(stems) - 1, int(rng.exponential(1.5)))]
        for _ in range(rng.integers(0, 3) if rng.random() < 0.2 else 0):
            at = int(rng.integers(0, len(stem) + 1))
            stem = rng.choice([stem[:at] + rng.choice(list("abéZ")) + stem[at:],
                               stem[:at] + stem[at + 1:],
                               stem[:at] + rng.choice(list("abs")) + stem[at + 1:]])
        texts.append(str(stem) + rng.choice([" ", "-", "1", "\n"]) + stem)
    rows = [(i if i % 5 else None, t, "en") for i, t in enumerate(texts)]
    rows += [(1, "", "en"), (2, None, None), (3, texts[0], "en"), (3, texts[0], "en"), (4, "Ā1ß", "en")]
    df = spark.createDataFrame(rows_of(*rows), SCHEMA)
    got = sorted(map(tuple, spelling.spelling_groups(df).collect()))
    want = brute_spelling([(d, t) for d, t, _ in rows])
    assert got == want
    assert sum(r[1] is not None for r in want) > 3 and max(r[4] for r in want) > 3
    assert spelling.spelling_groups(df.limit(0)).collect() == []


def test_words_of_the_smallest_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(map(tuple, QUERIES["op13_spelling_forms"](spark, "/root/testdata/sf0.001").collect()))
    words = {r[0] for r in got}
    want = brute_spelling([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got == want and words


def test_acceptor_is_minimal_and_composition_is_complete():
    rng = np.random.default_rng(8)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(4, 6))) for _ in range(150)})
    states, initial = spelling.acceptor(words)
    assert sorted(spelling.both_accept(states, initial, initial)) == words
    assert len({(f, tuple(e.items())) for f, e in states}) == len(states)
    got = collections.Counter(map(frozenset, spelling.one_edit_pairs(words, 4, True)))
    want = {frozenset((x, y)) for x in words for y in words if x != y and (
        len(x) == len(y) == 4 and sum(a != b for a, b in zip(x, y, strict=True)) == 1
        or len(x) == 5 and len(y) == 4 and any(x[:i] + x[i + 1:] == y for i in range(5)))}
    assert set(got) == want and set(got.values()) == {1}
