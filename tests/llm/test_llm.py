"""Every operator on small tables with nulls, empty and long texts, ties and repeated rows, against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from checks.parity import connect, difference
from tallyshore.llm import common, embeddings, fingerprints, licenses, lines, minhash, mixture, quality, tokens, toxicity, urls
from tallyshore.llm.queries import CATALOG, ORACLES

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, taken string, score string"
ODD = [
    (1, None, None, None, None, "x", "x"), (2, "", "en", "a", 0, "x", "x"), (3, " \n\t", "en", "a", 3, "x", "x"),
    (None, "no id at all here", "en", "b", 5, "x", "x"), (4, "one", "en", "b", 3, "x", "x"),
    (5, "the same words stand here twice", "en", "a", 31, "x", "x"),
    (6, "the same words stand here twice", "en", "a", 31, "x", "x"),
    (6, "the same words stand here twice", "en", "a", 31, "x", "x"),
    (7, "Licensed under the MIT\nLicense, then the General Public License. " + "long text " * 20_000, "en", "c", 9, "x", "x"),
    (8, "é" * 50 + "\n" + "é" * 49 + "e\n" + "é" * 50, "fr", "c", 9, "x", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    ours = CATALOG[name](spark, FOLDER).toPandas()
    assert difference(ours, connect(FOLDER).execute(ORACLES[name]).df()) is None


def _roots(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_minhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r[0]: (r[1], r[2], r[3]) for r in minhash.near_duplicates(docs, minhash.Settings(shingle=2)).collect()}
    sets = {r[0]: minhash.shingles(r[1], 2) for r in docs.select("doc_id", "text").collect()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    roots = _roots(sets, links)
    assert got == {i: (len(sets[i]), roots[i], roots[i] == i) for i in sets}


def test_minhash_odd_rows(odd, none):
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept)
            for r in minhash.near_duplicates(odd, minhash.Settings(shingle=2)).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 5, 5, True), (6, 5, 5, False),
            (None, 4, None, True)} <= rows
    assert minhash.near_duplicates(none).collect() == []


@pytest.mark.parametrize("sketches, texts_", [(minhash.SKETCH_BLOCK, minhash.REST_BLOCK), ((4, 8), (3, 5, 700))])
def test_minhash_finds_links_that_the_leader_lacks(spark, monkeypatch, sketches, texts_):
    monkeypatch.setattr(minhash, "SKETCH_BLOCK", sketches)
    monkeypatch.setattr(minhash, "REST_BLOCK", texts_)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(60):  # copies of copies drift away from the first text
        at = rng.randrange(len(base))
        base = base[:at] + [f"x{rng.randrange(10 ** 6)}"] + base[at + 1:]
        texts.append(" ".join(base))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [minhash.shingles(t, 2) for t in texts]
    links = [(a, b) for a in range(60) for b in range(a + 1, 60)
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r[0]: r[2] for r in minhash.near_duplicates(docs, minhash.Settings(shingle=2)).collect()}
    assert got == _roots(range(60), links)


def test_urls_odd_rows(spark):
    pages = spark.createDataFrame([
        (1, None, "x"), (2, "", "x"), (3, "no scheme.org/", "x"), (4, "http://EXAMPLE.org/en/1?x", "x"),
        (5, "https://a.b.example.org", "x"), (6, "http://x.com/de/" + "a" * 50_000, "x"), (6, "http://x.com/fr/", "x"),
        (7, "http://notexample.org/es/", "x"), (None, "http://q.com/de/#", "x")], "page_id long, url string, verdict string")
    rules = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("block", "com", "/de/")]
    assert {(r.page_id, r.host, r.rule, r.verdict) for r in urls.judge(pages, rules).collect()} == {
        (None, "q.com", "com/de/", "block"), (1, "", None, "allow"), (2, "", None, "allow"), (3, "", None, "allow"),
        (4, "example.org", "example.org/en/1", "block"), (5, "a.b.example.org", None, "allow"),
        (6, "x.com", "com/de/", "block"), (6, "x.com", None, "allow"), (7, "notexample.org", "org/", "allow")}
    assert urls.judge(pages.limit(0), rules).collect() == []


def test_fingerprints_equal_brute_force(spark, odd, none):
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        changed = fingerprints.edited(text, rows[(i + 1) % len(rows)][1])
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    got = fingerprints.fingerprints(odd).collect()
    assert sorted(map(str, [(r.doc_id, r.n_chars, r.edited_sha256) for r in got])) == sorted(map(str, want))

    def pieces(text):
        return set(fingerprints.digests(pa.array([text]))[0].tolist())

    def alike(one, two):
        one, two = pieces(one), pieces(two)
        return 1 - len(one ^ two) / max(1, len(one) + len(two))

    following = [rows[(i + 1) % len(rows)][1] for i in range(len(rows))]
    near = [(i, t, alike(t, fingerprints.edited(t, n)), alike(t, n)) for (i, t), n in zip(rows, following)]
    assert sorted((str(r.doc_id), r.n_chars, r.near_edited, r.near_next) for r in got) == sorted(
        (str(i), len(t), a, b) for i, t, a, b in near)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[5] == prints[6] != prints[7] and prints[1] == prints[2]
    assert fingerprints.fingerprints(none).collect() == []


def test_tables_give_back_what_differs():
    rng = np.random.default_rng(0)
    one = np.unique(rng.integers(0, 1 << 48, 400, dtype=np.uint64))
    for kept in (400, 396, 300, 0):
        a = fingerprints._checked(one)
        b = fingerprints._checked(np.concatenate([one[:kept], one[kept:] + np.uint64(1)]))
        pair = (a, np.zeros(len(a), int)), (b, np.zeros(len(b), int))
        assert fingerprints.differing(*pair, 1)[0] == len(np.setxor1d(a, b))
        keys, own, side = fingerprints.recovered(*pair, 1)
        assert not own.any() and len(np.unique(keys)) == len(keys)
        assert np.array_equal(np.sort(keys[side == 1]), np.setdiff1d(a, b))
        assert np.array_equal(np.sort(keys[side == -1]), np.setdiff1d(b, a))


def test_edit_distance_equals_definition():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abé日") for _ in range(rng.randrange(10))) for _ in "ab")
        for most in range(4):
            assert lines.edit_distance(a, b, most) == min(plain(a, b), most + 1)


@pytest.mark.parametrize("settings", [lines.Settings(), lines.Settings(hot=3, block=4)])
def test_lines_equal_brute_force(spark, settings):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcd ef") for _ in range(rng.randint(22, 60))) for _ in range(25)]

    def changed(text):
        for _ in range(rng.randrange(5)):
            at, kind = rng.randrange(len(text)), rng.randrange(3)
            text = text[:at] + (rng.choice("abé日語🙂") if kind else "") + text[at + (kind < 2):]
        return text

    docs = [(i, "\n".join(changed(rng.choice(base)) for _ in range(rng.randint(0, 4)))) for i in range(120)]
    seen = sorted((i, n, t) for i, text in docs for n, t in enumerate(text.split("\n")) if len(t) >= 24)
    texts = sorted({t for *_, t in seen})
    links = [(a, b) for a in texts for b in texts if a < b and lines.edit_distance(a, b, 2) <= 2]
    roots, first = _roots(texts, links), {}
    for i, n, t in seen:
        first.setdefault(roots[t], (i, n))
    count = {t: sum(t in link for link in links) for t in texts}
    want = {(i, n): (*first[roots[t]], count[t], first[roots[t]] == (i, n)) for i, n, t in seen}
    if settings.hot == 3:  # keys that go on from one batch to the next
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)
    rows = lines.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), settings).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r[0], r[1]): tuple(r[2:]) for r in rows} == want


@pytest.mark.parametrize("settings", [lines.ALL, lines.Settings(least=1, hot=3, block=4)])
def test_short_lines_equal_brute_force(spark, settings):
    rng = random.Random(12)
    docs = [(i, "\n".join("".join(rng.choice("abcdefghé日🙂") for _ in range(rng.choice([0, 1, 2, 3, 4, 7, 8, 9, 12, 23, 24])))
                          for _ in range(rng.randint(0, 4)))) for i in range(60)]
    docs += [(i + 60, f"{text[:-1]}x") for i, text in docs if len(text) > 5]
    seen = sorted((i, n, t) for i, text in docs for n, t in enumerate(text.split("\n")) if t)
    texts = sorted({t for *_, t in seen})
    links = [(a, b) for a in texts for b in texts if a < b and lines.edit_distance(a, b, 2) <= 2]
    roots, first = _roots(texts, links), {}
    for i, n, t in seen:
        first.setdefault(roots[t], (i, n))
    count = {t: sum(t in link for link in links) for t in texts}
    rows = lines.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), settings).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in rows} == {
        (i, n): (*first[roots[t]], count[t], first[roots[t]] == (i, n)) for i, n, t in seen}


def test_query_has_every_line(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r[0], n) for r in texts for n, line in enumerate((r[1] or "").split("\n")) if line)
    assert sorted((r.doc_id, r.line_no) for r in CATALOG["op4_line_dedup"](spark, FOLDER).collect()) == want


def test_short_lines_are_removed_if_equal(spark):
    docs = [(1, "All rights reserved.\n\r\nLes.\nthe cat"), (2, "\r\nAll rights reserved.\nLet.\nthe cap"),
            (3, "Les.\nAll rights reserved."), (4, "one\nLes.\n\ntwo")]
    rest = lines.remove(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in rest} == {1: docs[0][1], 2: "\r\nLet.\nthe cap", 4: "one\n\ntwo"}


def test_lines_odd_rows(odd, none):
    rows = {tuple(r) for r in lines.near_duplicates(odd).collect() if r.doc_id == 8}
    assert rows == {(8, 0, 8, 0, 1, True), (8, 1, 8, 0, 1, False), (8, 2, 8, 0, 1, False)}
    rest = lines.remove(odd)
    assert rest.columns == odd.columns
    assert [r.text for r in rest.collect() if r.doc_id == 8] == ["é" * 50]
    assert lines.near_duplicates(none).collect() == [] and lines.remove(none).collect() == []


def test_mixture_fills_like_water(spark, odd, none):
    rng = random.Random(5)
    docs = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "B", "é", None]) if i % 3 else "a") for i in range(600)]
    rows = mixture.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, target, open_ = {s: i % 3 + 1 for i, s in enumerate(names)}, {}, set(names)
    while True:
        rest = sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_.remove(s)
    target |= share
    taken = dict.fromkeys(names, 0)
    for r in rows:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in names)
    assert sorted(map(str, rows)) == sorted(map(str, mixture.mix(
        spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)).collect()))
    assert mixture.mix(odd).count() == len(ODD) and mixture.mix(none).collect() == []
    made = mixture.materialize(odd)
    words = sum(len(re.findall(mixture.WORD, r.text)) for r in made.collect())
    assert made.columns == odd.columns and words == sum(r.taken for r in mixture.mix(odd).collect())


def test_mixture_of_whole_texts(spark):
    rng = random.Random(15)
    docs = [(i, "\n".join(f"w{i}  x" for _ in range(rng.randint(0, 30))), f"s{i % 5}") for i in range(200) if i % 5 < 2 or i < 60]
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string")
    want, cut = {}, 0
    for r in mixture.mix(rows).collect():
        part = r.taken % r.size if r.size else 0
        cut += part > 0
        want[r.doc_id] = r.taken // r.size + (2 * part >= r.size) if r.size else 0
    got = corpus_pipeline.mix_sources(spark, rows, FOLDER).collect()
    assert cut > 0 and {i: n for i, n in want.items() if n} == dict(Counter(r.doc_id for r in got))
    assert {(r.doc_id, r.text) for r in got} <= {(i, text) for i, text, _ in docs}


def test_licenses_odd_rows(odd, none):
    rows = {r.doc_id: r for r in licenses.scan(odd).collect()}
    assert (rows[7].n_base, rows[7].first_word, rows[7].last_word, rows[7].base_labels) == (2, 3, 7, "gpl,mit")
    assert (rows[1].n_words, rows[1].n_base, rows[1].first_word, rows[1].labels, rows[1].score) == (0, 0, None, "", 0.0)
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(none).collect() == []


def test_wrapped_licenses(spark):
    mit = ("# Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "# of this software and associated documentation files")
    bsd = "Redistribution and use in source\n\nand binary forms, with or without modification, are permitted\nprovided that these conditions are met"
    gpl = ("This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU General\n"
           "Public\nLicense as published by the Free Software\nFoundation")
    far = "released" + "\nword" * 8 + " mit\nlicence license"
    docs = [(3 * n + k, "word word\n" * n + text + "\nword" * (n % 5))
            for n in range(0, 80, 7) for k, text in enumerate((mit, bsd, far))]
    docs += [(900, gpl), (901, "released by us\nunder mit, a\nfree license"), (902, None), (903, mit.replace("\n#", ""))]
    rows = {r.doc_id: (r.labels, r.score) for r in licenses.scan(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, _ in docs[:-4]:
        assert rows[i] == [("mit", 1.0), ("bsd", 1.0), ("", 0.0)][i % 3]
    assert (rows[900][0], rows[901], rows[902], rows[903]) == ("gpl", ("mit", 1.0), ("", 0.0), ("mit", 1.0))


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    vectors = np.concatenate([base, base + rng.normal(size=base.shape) * 0.2, base * 3, base + rng.normal(size=base.shape) * 0.3])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    bad = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [None, 1.0], 0),
           (905, [1.0, 2.0], 0), (None, rows[0][1], 0), (906, [1e300] * 3, 0), (907, [1e-300] * 3, 0)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table, tile=50).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    roots = _roots(range(len(rows)), list(zip(*np.nonzero(near))))
    want = {i: (int(near[i].sum()), roots[i], roots[i] == i) for i in range(len(rows))}
    want |= {i: (0, i, True) for i in range(900, 906)} | {906: (1, 906, True), 907: (1, 906, False), None: (0, None, True)}
    assert got == want
    assert embeddings.near_duplicates(table.limit(0)).collect() == []


def test_bounds_of_quantized_products_hold():
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(200, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    whole, scale, lost = embeddings.quantize(unit)
    rough = (whole * scale[:, None]) @ (whole * scale[:, None]).T
    assert (unit @ unit.T <= rough + lost[:, None] + lost[None, :] * (1 + lost[:, None])).all()


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize("module, column, least", [(toxicity, "toxic", 0.5), (quality, "quality", 0.3)])
def test_classifiers(spark, odd, none, module, column, least):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = module.fit(docs, labels)
    rows = {r.doc_id: r for r in module.score(docs, model).collect()}
    assert all(r.held_out == _held_out(i) and r.predicted == (r.score >= least) for i, r in rows.items())
    held = [(rows[r.doc_id].score, r[column]) for r in labels.collect() if _held_out(r.doc_id)]
    ones, zeros = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([[a > b for b in zeros] for a in ones]) > 0.9  # area under the curve
    # held-out labels are never read
    hidden = labels.collect()
    flipped = [(r.doc_id, 1 - r.quality, 1 - r.toxic) if _held_out(r.doc_id) else tuple(r) for r in hidden]
    again = module.fit(docs, spark.createDataFrame(flipped, labels.schema))
    assert np.allclose(again.weights, model.weights)
    assert module.score(odd, model).count() == len(ODD)
    assert module.score(none, model).collect() == []
    blank = module.fit(none, labels.limit(0))
    assert {r.score for r in module.score(odd, blank).collect()} == {0.5}


def test_toxicity_equals_brute_force(spark, monkeypatch):
    """Grams, ratios and choice by plain counting, weights as of Newton steps on the whole matrix."""
    monkeypatch.setattr(toxicity, "RIDGE", 0.02)
    monkeypatch.setattr(toxicity, "STEPS", 4000)
    rng, size = random.Random(8), 30
    words = [["vile", "scum", "idiot", "fool"], ["green", "river", "stone", "Läufer"]]
    texts = [" ".join(rng.choice(words[rng.random() < (0.35 if i % 3 == 0 else 0.75)]) for _ in range(rng.randint(0, 9)))
             for i in range(90)] + [None, ""]
    ids = [i for i in range(2000) if not _held_out(i)][:len(texts)]
    label = np.array([int(i % 3 == 0) for i in range(len(texts))])

    def cell(gram):
        h = 0
        for c in gram:
            h = (h * 0x01000193 + ord(c)) % 2 ** 32
        h = (h ^ h >> 15 ^ len(gram)) * 0x85EBCA6B % 2 ** 32
        return ((h ^ h >> 13) * 0xC2B2AE35 % 2 ** 32) >> 32 - toxicity.BITS

    padded = [f" {(t or '').lower()} " for t in texts]
    grams = [{cell(t[i:i + n]) for n in toxicity.SIZES for i in range(len(t) - n + 1)} for t in padded]
    assert [set(f.tolist()) for f in toxicity.ngrams([t or "" for t in texts])] == grams
    seen = [Counter(g for own, y in zip(grams, label) if y == k for g in own) for k in (0, 1)]
    share = [{g: (seen[k][g] + 1) / ((label == k).sum() + 2) for g in seen[0] | seen[1]} for k in (0, 1)]
    ratio = {g: np.log(share[1][g] / share[0][g]) for g in share[0]}

    def distance(g):
        both = (seen[0][g] + seen[1][g] + 2) / (len(label) + 4)
        return abs(share[1][g] - share[0][g]) / np.sqrt(both * (1 - both) + 1e-9)

    chosen = sorted(ratio, key=lambda g: (-round(distance(g), 12), g))[:size]
    matrix = np.array([[ratio[g] * (g in own) for g in chosen] + [1] for own in grams])
    weigh = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean())) / len(label)
    ridge = 0.02 * np.diag([1] * size + [0])
    best = np.zeros(size + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-matrix @ best))
        best -= np.linalg.solve((matrix.T * weigh * p * (1 - p)) @ matrix + ridge,
                                matrix.T @ (weigh * (p - label)) + ridge @ best)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(zip(ids, label.tolist())), "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, kept=size)
    assert set(np.flatnonzero(model.weights)) <= set(chosen)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert np.allclose([got[i] for i in ids], 1 / (1 + np.exp(-matrix @ best)), atol=1e-4)


def test_quality_risk_is_least_and_not_negative():
    """The risk written out, whose slope is nothing where ``minimize`` ends, and no smaller anywhere near."""
    rng, prior = np.random.default_rng(4), 0.4
    positive = rng.normal(0.7, 1, (300, 3))
    unlabelled = np.concatenate([rng.normal(0.7, 1, (400, 3)), rng.normal(-0.7, 1, (600, 3))])

    def risk(weights):
        def loss(x, sign):
            return np.log1p(np.exp(-sign * (x @ weights[:-1] + weights[-1]))).mean()
        rest = loss(unlabelled, -1) - prior * loss(positive, -1)
        return prior * loss(positive, 1) + max(0, rest) + quality.RIDGE / 2 * (weights[:-1] ** 2).sum(), rest

    best = np.append(*quality.minimize(positive, unlabelled, prior))
    assert risk(best)[1] > 0
    steps = [1e-4 * row for row in np.eye(len(best))]
    assert max(abs(risk(best + d)[0] - risk(best - d)[0]) / 2e-4 for d in steps) < 5e-3
    assert all(risk(best + rng.normal(0, 0.3, len(best)))[0] >= risk(best)[0] for _ in range(200))


def test_quality_hardly_depends_on_few_unlabelled_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = sorted(r[0] for r in docs.select("doc_id").collect())
    labels = [(i, i % 2) for i in ids]
    # with each document labelled, and with all but one
    models = [quality.fit(docs, spark.createDataFrame(
        [r for r in labels if r[0] != left], "doc_id long, quality int"))
        for left in (None, next(i for i in ids if not _held_out(i) and i % 2 == 0))]
    for name in ("center", "spread"):
        assert np.allclose(*(getattr(m, name) for m in models))


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return tokens.Encoder(tokens.parse_ranks(file.read()), public_tokenizers.PATTERN)


def test_tokens_equal_tiktoken(encoder):
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=encoder.vocabulary.ranks)
    rng, letters = random.Random(8), "abcdeth in.' \n1'sré²\x1c\x85 中😀​"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["", "ab" * 3000, "é" * 2000, " " * 500]
    ids = encoder.encode(texts)
    assert ids == [plain.encode_ordinary(t) for t in texts]
    assert [encoder.decode(i).decode() for i in ids] == texts


def test_encoding_holds_little(encoder):
    tracemalloc.start()
    try:
        vocabulary = tokens.Vocabulary(encoder.vocabulary.ranks)
        assert tracemalloc.get_traced_memory()[0] < 24_000_000 and vocabulary.longest == 128
    finally:
        tracemalloc.stop()
    texts = [f"{n} words and some more " * 5000 for n in range(40)] + [None, "", "x" * 3_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(43)), pa.array(texts)], ["doc_id", "text"])
    parts = list(tokens.encode_batches(iter([batch]), encoder, decode=True))
    assert all(p.num_rows == 1 or pc.sum(pc.binary_length(p["decoded"])).as_py() <= common.SLICE_BYTES for p in parts)
    assert [x for p in parts for x in p["doc_id"].to_pylist()] == list(range(43))
    assert [x.decode() for p in parts for x in p["decoded"].to_pylist()] == [t or "" for t in texts]


def test_short_pieces_are_encoded_side_by_side(encoder, monkeypatch):
    one_by_one, extend = [], tokens.PrefixTable.extend

    def counted(table, size):
        one_by_one.append(size)
        extend(table, size)

    monkeypatch.setattr(tokens.PrefixTable, "extend", counted)
    monkeypatch.setattr(tokens, "SIDE_BY_SIDE", 1000)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=encoder.vocabulary.ranks)
    rng, syllables = random.Random(10), ["th", "an", "er", "schlo", "s", "ß", "é", "ing", "中文", "Q", "zzz"]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 10))) for _ in range(50)) for _ in range(200)]
    texts += ["\0", "!\0\0", "\0" * 9 + "#", "q" * 64, "#" * 63 + "\0", "", "1234567890" * 6]
    assert encoder.encode(texts) == [plain.encode_ordinary(t) for t in texts]
    assert len(encoder._numbers) > 5000 and sum(one_by_one) < 200
    ids, at = encoder.encode_rows(texts)
    assert [x.decode() for x in encoder.decode_rows(ids, at).to_pylist()] == texts
    longer = ["é" * 32 + "x", "k" * 65]
    assert encoder.encode(longer) == [plain.encode_ordinary(t) for t in longer] and 65 in one_by_one


def test_latin_texts_are_split_by_the_common_pattern(encoder):
    latin = [c for c in map(chr, range(0x250)) if not tokens._BEYOND_LATIN(c)]
    rng, some = random.Random(12), "'stmdrevl \n\t\r_-!é1Z9ßĀ[`{~@/"
    texts = [a + b for a in latin for b in some] + ["".join(rng.choices(some, k=12)) for _ in range(20000)]
    assert len(latin) > 450 and [encoder.split(t) for t in texts] == [encoder._any(t) for t in texts]


def test_encoder_of_ranks_with_gaps():
    ranks = {bytes([i]): i for i in range(256)}
    ranks |= {b"ab": 300, b"bc": 310, b"aa": 311, b"abc": 320, b"xyz": 330, b"aab": 331, b"cab": 340, b"abab": 350}
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcxyz", k=rng.randrange(1, 20))) for _ in range(3000)] + [""]
    for made in (ranks, ranks | {b"cc": 361, b"ccc": 360}):  # then with a join of lower rank than its part
        encoder = tokens.Encoder(made, r"\w+")
        assert encoder._short.ordered == (made is ranks)
        whole = [[made[t.encode()]] if t.encode() in made else [made[x] for x in encoder.vocabulary.merge(t.encode())]
                 for t in texts]
        ids, at = encoder.encode_rows(texts)
        if made is ranks:
            assert encoder.encode(texts) == whole
        assert [x.decode() for x in encoder.decode_rows(ids, at).to_pylist()] == texts


def test_bpe_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES_KEPT", 40)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = tokens.parse_ranks(file.read())
    encoder = tokens.Encoder(ranks, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=ranks)
    for i in range(30):
        texts = [f"anwhtin{i % 7}ko thenre{chr(97 + i % 9)}ouqx {i * j} of" for j in range(8)]
        assert encoder.encode(texts) == [plain.encode_ordinary(t) for t in texts]
        assert len(encoder._numbers) <= 40 + 60


def test_prefix_table_edits(encoder):
    rng = random.Random(9)
    table = tokens.PrefixTable(encoder.vocabulary, b"the quick brown fox " * 100)
    for _ in range(20):
        start = rng.randrange(len(table.data))
        worked = table.replace(start, start + rng.randrange(4), bytes(rng.choice(b"abc ") for _ in range(rng.randrange(5))))
        assert worked < 400
        assert table.tokens() == tokens.PrefixTable(encoder.vocabulary, table.data).tokens()
    assert table.tokens(50) == tokens.PrefixTable(encoder.vocabulary, table.data[:50]).tokens()


def test_encode_odd_rows(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = tokens.encode_documents(odd, path, public_tokenizers.PATTERN, decode=True).collect()
    want = sorted((str(r[0]), (r[1] or "").encode()) for r in ODD)
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in rows) == want
    assert tokens.encode_documents(none, path, public_tokenizers.PATTERN).collect() == []


def test_pipeline_bounds_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    rows = [(i, "a", f"{i} " + "plain words of a long text, told twice. " * 1000) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1)
    spark.conf.unset(common.BATCH_KEY)
    try:
        corpus_pipeline.encode(spark, docs, FOLDER)
        most = max(r.n for r in docs.mapInArrow(sizes, "n long").collect())
        assert most < 2 * common.BATCH_BYTES
        spark.conf.set(common.BATCH_KEY, "1m")
        corpus_pipeline.encode(spark, docs, FOLDER)
        assert spark.conf.get(common.BATCH_KEY) == "1m"
    finally:
        spark.conf.unset(common.BATCH_KEY)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    columns = docs.columns
    good = corpus_pipeline.keep_good(spark, docs, FOLDER)
    assert good.columns == columns
    for stage in (corpus_pipeline.drop_repeated_lines, corpus_pipeline.drop_near_copies, corpus_pipeline.mix_sources):
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns and out.count() > 0
    kept = {r[0] for r in corpus_pipeline.drop_near_copies(spark, docs, FOLDER).select("doc_id").collect()}
    assert kept == {r.doc_id for r in minhash.near_duplicates(docs).collect() if r.kept}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)


CLASHING = DOCS + ", digest string, kept string, row string, __score string, __node string"
LONG = "first words of a good plain line that no other text has, number {}"


@pytest.fixture(scope="module")
def clashing(spark):
    """Rows that share an id or have none, with texts of their own, and columns named like ours."""
    texts = [(1, LONG.format("one alone")), (6, LONG.format("one alone")), (6, "quite another story " + "é" * 30 + " told once"),
             (6, "shared opening of some length here\n" + LONG.format("two zwei")),
             (7, "shared opening of some length here"), (7, "a story of ships\nshared opening of some length here"),
             (None, "nothing here at all but plain words of a text"), (None, "Licensed under the MIT License, said nobody else"),
             (None, LONG.format("one alone")), (8, None), (8, "")]
    rows = [(i, t, "en", f"s{n}", n, "t", "s", "d", "k", "r", "c", "n") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING)


def test_no_stage_loses_a_unique_text_or_a_column(spark, clashing, monkeypatch):
    rows = {r.source: r for r in clashing.collect()}
    monkeypatch.setattr(corpus_pipeline, "QUALITY", 0.0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, FOLDER)
        assert out.columns == clashing.columns, name
        got = out.collect()
        for r in got:
            assert [v for c, v in r.asDict().items() if c not in ("text", "n_chars")] == [
                v for c, v in rows[r.source].asDict().items() if c not in ("text", "n_chars")], name
        texts = Counter(r.text for r in got)
        if name == "line dedup":
            assert texts[LONG.format("two zwei")] + texts["shared opening of some length here\n" + LONG.format("two zwei")] == 1
            assert texts["a story of ships"] + texts["a story of ships\nshared opening of some length here"] == 1
            assert sum((t or "").count("shared opening") for t in texts) == 1
            assert sum((t or "").count("one alone") for t in texts.elements()) == 1
        if name == "minhash near-dedup":
            assert texts[LONG.format("one alone")] == 1 and {r.doc_id for r in got if r.text == LONG.format("one alone")} == {1}
        for unique in {r.text for r in rows.values() if r.source in ("s2", "s6", "s7")}:
            assert texts[unique] == 1 or name == "source mix" and texts[unique] > 0, (name, unique)
    encoded = corpus_pipeline.STAGES[-1][1](spark, clashing, FOLDER).collect()
    assert len(encoded) == len(rows) and all(r.round_trip for r in encoded)


def test_licenses_label_each_row_by_its_own_text(clashing):
    got = Counter((r.doc_id, r.n_words, r.labels) for r in licenses.scan(clashing).collect())
    assert got[None, 10, ""] == 1 and got[None, 8, "mit"] == 1
    assert sum(n for (_, _, labels), n in got.items() if labels) == 1


def test_tiles_grow_with_vectors_only_once_they_are_full():
    assert embeddings.tiles(0, 0, 4096, 12) == 1
    assert embeddings.tiles(5_000, 64, 4096, 12) == 2
    assert embeddings.tiles(50_000, 64, 4096, 12) == embeddings.tiles(500_000, 64, 4096, 12) == 9
    full = embeddings.TILE_BYTES // (8 * 64)
    assert embeddings.tiles(100 * full, 64, 4096, 12) == 100
