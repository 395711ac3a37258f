"""Collocations, spelling variants and licence scans against brute force; their odd rows and tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordermill.llm import collocations, licenses, spelling

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def texts():
    """Few syllables, so that phrases, anagrams and near words abound; a third of all rows is one text."""
    rng = random.Random(11)
    made = ["".join(rng.choices(["ka", "lo", "mi", "nu", "ré", "sa", "Ñi", "to"], k=rng.randrange(1, 5))) for _ in range(220)]
    made += [w[:j] + rng.choice(["", "a", "x", "é"]) + w[j + rng.randrange(2) :] for w in made if len(w) > 4 for j in rng.sample(range(len(w)), 2)]
    rng.shuffle(made)
    out = []
    for k in range(150):
        ws = [made[min(int(rng.expovariate(0.015)), len(made) - 1)] for _ in range(rng.randrange(0, 90))]
        text = " ".join(w + rng.choice(["", "", "", ",", ".", "\n", "\t", "!"]) for w in ws)
        out.append((k, text, ["en", "de", None][k % 3], "s", 1))
    hot = "Kalo Kalo Kalo mi nu, the quick brown fox\x0bjumps over the lazy dog; the quick brown fox"
    out += [(500 + k, hot, "en", "s", 1) for k in range(60)]
    out += [(900, None, "en", None, None), (901, "", None, None, 0), (902, " \t\n.,;", "fr", None, 5), (7, out[7][1], "en", "s", 1), (None, "kalomi " * 40, None, None, None)]
    return out + [(903, "kalo minu " * 20_000, "xx", "s", 1), (904, "\U0001f600 œuvre Straße straße ×÷ strasse " * 5, "xx", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS).selectExpr("*", "1 as a", "'x' as word", "2 as n", "3 as labels", "'z' as phrase", "0 as score").repartition(5)


def brute_collocations(texts, least, top):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang, *_ in texts:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 6):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    rows = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                score, cut = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def as_rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("least, top", [(100, 2000), (5, 2000), (5, 7)])
def test_collocations_equal_brute_force(docs, texts, least, top):
    assert as_rows(collocations.collocations(docs, least=least, top=top)) == brute_collocations(texts, least, top)


def test_full_counters_change_nothing(docs, texts, monkeypatch):
    """Where every counter is taken many times over, nothing is padded early and counts stay exact."""
    monkeypatch.setattr(collocations, "_counter", lambda x, bits: (x % np.uint64(3)).astype(np.int64))
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 500)
    assert as_rows(collocations.collocations(docs, least=5)) == brute_collocations(texts, 5, 2000)


def test_products_beyond_64_bits(spark):
    rows = [("en", 0, "", 9 * 10**15), ("en", 1, "x", 3 * 10**14), ("en", 1, "y", 7 * 10**14), ("en", 2, "x y", 10**14 + 1)]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, f bigint")
    old = collocations.phrase_counts
    collocations.phrase_counts = lambda *_, **__: counts
    try:
        (row,) = collocations.collocations(counts).collect()
    finally:
        collocations.phrase_counts = old
    assert row["score"] == 1000 * (10**14 + 1) * 9 * 10**15 // (3 * 10**14 * 7 * 10**14)


def brute_words(texts, least=3):
    counts = Counter()
    for doc_id, text, *_ in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    return {w: n for w, n in counts.items() if n >= least}


def edit_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(texts):
    words = brute_words(texts)
    forms, rows = {}, {}
    for w, n in words.items():
        near = [x for x in words if edit_one(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 2 * n else None
        rows[w] = len(near)
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, rows[w], words[forms[w]] if forms[w] else None))
    return sorted(out)


def test_variants_equal_brute_force(docs, texts):
    want = brute_variants(texts)
    got = sorted(map(tuple, spelling.op12(docs).collect()))
    assert got == want
    assert sum(r[1] is not None for r in want) > 20 and sum(r[4] > 1 for r in want) > 20


def test_long_ways_to_the_root(spark):
    steps = [(f"w{k}", f"w{k + 1}") for k in range(21)]
    assert {r["root"] for r in spelling.roots(spark.createDataFrame(steps, "word string, form string")).collect()} == {"w21"}


def test_every_near_pair_shares_a_signature():
    rng = random.Random(2)
    letters = "abcdeéñÿ"
    for _ in range(300):
        w = "".join(rng.choices(letters, k=rng.randrange(5, 30)))
        at = rng.randrange(len(w))
        for x in (w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:]):
            bags = ["".join(sorted(v)) for v in (w, x)]
            if bags[0] != bags[1]:
                keys = spelling.signatures(spelling.vectors(bags))
                assert set(keys[0].tolist()) & set(keys[1].tolist())


def test_spare_letters_of_anagrams_and_long_runs():
    bags = ["aabcd", "aabce", "abcd", "a" * 40_000 + "b", "a" * 40_000]
    found = spelling.spare_letters(np.zeros(5, np.int64), bags)
    named = {(bag[-5:], chr(spelling.LETTERS[p]), blank) for bag, p, blank in found}
    assert named == {("aabcd", "d", True), ("aabce", "e", True), ("aabcd", "a", False), ("aaaab", "b", False)}
    # Bags that share a signature are compared in slices; the result is the same.
    many = sorted({"".join(sorted(random.Random(k).choices("abcdef", k=6))) for k in range(400)})
    whole = spelling.spare_letters(np.zeros(len(many), np.int64), many)
    spelling.SLICE, old = 50, spelling.SLICE
    try:
        assert spelling.spare_letters(np.zeros(len(many), np.int64), many) == whole
    finally:
        spelling.SLICE = old


def test_odd_tables(spark, docs):
    for op in (collocations.op11, spelling.op12, licenses.op13):
        assert op(docs.limit(0)).collect() == []
    bare = spark.createDataFrame([(1, None, None, None, None)], DOCS)
    assert collocations.op11(bare).collect() == [] and spelling.op12(bare).collect() == []
    assert list(licenses.op13(bare).first()) == [1, 0, 0, None, None, "", "", 0.0]


MIT = (
    "Copyright (c) 2020 A. Body\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software."
)
NOTICES = [
    (1, "x " * 50 + "Released under the MIT License.", {"mit"}, True),
    (2, "Licensed under the Apache License, Version 2.0. " + "y " * 30, {"apache-2"}, True),
    (3, "Licensed under CC BY-NC 4.0.", {"cc-by-nc"}, True),
    (4, "This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}, False),
    (5, "z " * 3000 + MIT + " z" * 200, {"mit"}, False),
    (6, MIT.replace("without restriction", "with restriction"), set(), False),
    (7, "the license version of the general public was granted under the copy", set(), False),
    (8, MIT.replace("person obtaining", "natural or legal person who is obtaining"), {"mit"}, False),
    (9, MIT + "\n" + "Released under the MIT License." * 2, {"mit"}, True),
    (10, "under the mit licenses, apache license versions 2, cc by ncx", set(), False),
    (11, " ".join(sorted(MIT.split())), set(), False),
]


def test_licences(spark):
    rows = [(k, t, "en", "s", 1) for k, t, *_ in NOTICES] + [(100 + k, "plain prose the of and version " * 9, "en", "s", 1) for k in range(40)]
    got = {r["doc_id"]: r for r in licenses.op13(spark.createDataFrame(rows, DOCS)).collect()}
    for k, text, labels, base in NOTICES:
        row = got[k]
        assert set(filter(None, row["labels"].split(","))) == labels, (k, row)
        assert (row["n_base"] > 0) == base and 0 <= row["score"] <= 1 and (row["score"] > 0.5) == bool(labels), (k, row)
        assert row["score"] == 1 or not base
    assert all(r["labels"] == "" and r["score"] == 0 for k, r in got.items() if k >= 100)


def test_licence_base_places_equal_brute_force(texts, spark):
    rng = random.Random(4)
    pool = "under the mit license apache version 2 cc by nc Under THE é x-y 2.0 by-nc".split()
    rows = [(k, rng.choice(" -\n_").join(rng.choices(pool, k=rng.randrange(400))), None, None, None) for k in range(120)] + [t for t in texts if (t[0] or 0) >= 500]
    got = {r["doc_id"]: r for r in licenses.op13(spark.createDataFrame(rows, DOCS)).collect()}
    for k, text, *_ in rows:
        ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        at = [(i, label) for phrase, label in licenses.BASE for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
        want = (len(ws), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        row = got[k]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == want
        assert {x for _, x in at} <= set(row["labels"].split(","))


def test_contraction_connects_the_same(spark):
    from ordermill.llm.components import components, contracted

    rng = random.Random(8)
    # Three groups, each tied by many tasks to many different leaders.
    links = [(g * 1000 + rng.randrange(40), g * 1000 + rng.randrange(400)) for g in range(3) for _ in range(4000)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    fewer = contracted(frame)
    want = {tuple(r) for r in components(frame).collect()}
    got = dict(map(tuple, components(fewer).collect()))
    assert all(got.get(node, node) == low for node, low in want)
    assert fewer.count() < 1400 < frame.distinct().count() and contracted(frame.limit(0)).count() == 0
