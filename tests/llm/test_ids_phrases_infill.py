"""Token files, collocations and fill-in-the-middle against brute force."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.orc
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tallyshore.llm import binary, collocations, infill
from tallyshore.llm.queries import CATALOG
from tests.llm.test_llm import DOCS, FOLDER, ODD

WORDS = public_tokenizers.path("word_bpe_49k.json")
MORE = [
    (8, "Straße ΣΑΣ x y é ́ a\x1cb <|endoftext|>de", None, "c", 9, "x", "x"),
    (9, "it's 3<P>a", "en", "c", 9, "x", "x"), (10, "a <S", "en", "c", 9, "x", "x"),
    (11, "a b c d e. a b c d\tE! A b c", "en", "c", 9, "x", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD + MORE, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _in_order(rows):
    """Null ids first; rows that share an id by text here, as any order of theirs is as good."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_token_files_equal_brute_force(spark, odd, none, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    path = f"{tmp_path}/ids"
    binary.write(binary.encode_ordered(odd, WORDS), path, binary.Format(row_group=1_000))
    got = sorted(binary.digests(binary.read(spark, path)).collect(), key=lambda r: r.start)
    want = Counter()
    for doc_id, text, *_ in ODD + MORE:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == [r[0] for r in _in_order(ODD + MORE)]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    binary.write(binary.encode_ordered(none, WORDS), f"{tmp_path}/none")
    assert binary.digests(binary.read(spark, f"{tmp_path}/none")).collect() == []


def test_token_query_equals_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    tokenizer, start = Tokenizer.from_file(WORDS), 0
    got = {r.doc_id: r for r in CATALOG["op11_orc_token_ids"](spark, FOLDER).collect()}
    for doc in sorted(docs, key=lambda r: r.doc_id):
        ids = tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [2]
        assert got[doc.doc_id][1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_lookups_read_few_row_groups(spark, tmp_path):
    """Ids that are present and absent: the scan reads the row groups that may hold them, and no others."""
    path = f"{tmp_path}/many"
    docs = spark.range(40_000).selectExpr("id * 2 as doc_id", "concat('some words ', id) as text")
    binary.write(binary.encode_ordered(docs, WORDS, None).coalesce(2), path, binary.Format(stripe_bytes=1 << 16))
    files = [str(f) for f in tmp_path.glob("many/*.orc")]
    assert max(pa.orc.ORCFile(f).nstripes for f in files) > 1  # stripes for several tasks
    for wanted, read in (([20_000, 60_002], 2_000), ([20_001], 1_000), ([-1], 0)):
        found = binary.read(spark, path, wanted)
        rows = found.collect()
        assert sorted(r.doc_id for r in rows) == [i for i in wanted if i % 2 == 0 and i >= 0]
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numOutputRows").value() <= read
    ids = Tokenizer.from_file(WORDS).encode("some words 10000", add_special_tokens=False).ids
    assert binary.read(spark, path, [20_000]).first().token_ids == ids


def test_encoder_forgets_and_learns_again():
    encoder = binary.PieceEncoder(open(WORDS, encoding="utf-8").read())
    first = encoder.encode(["two words, Über", ""])
    kept, binary.PIECES_KEPT = binary.PIECES_KEPT, 2
    try:
        assert encoder.encode(["words of others", "two  words, Über", ""])[1:] == first
    finally:
        binary.PIECES_KEPT = kept


def test_pieces_equal_whole_texts():
    """Words with all kinds of letters and marks, alone, capital and before punctuation."""
    encoder = binary.PieceEncoder(open(WORDS, encoding="utf-8").read())
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x21, 0x260)] + ["\u0301", "Σ", "ß", "İ", "語", "ก", "\u1100", "\u1161", "😀", "'s", "'ll", "\xa0", "\x85"]
    texts = ["".join(rng.choices(letters + [" "] * 60 + ["\n", "\t", ". ", ", "], k=200)) for _ in range(300)]
    texts += ["".join(rng.choices(letters[:95] + ["é", "ø", " "] + [" "] * 20 + ["'re ", "\n", "\x0b"], k=200)) for _ in range(300)]
    texts += ["a <|endoftext|> b", "<|startoftext|>x", "_a__b_ 12,5 (it's)"]
    texts += ["".join(c + rng.choice(["", ",", "!? "]) + " " for c in letters)]
    tokenizer = Tokenizer.from_file(WORDS)
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_cut_by_the_pattern():
    """Latin pieces in arrays as by the pattern itself, also where texts meet; others as a whole, without their neighbors."""
    encoder = binary.PieceEncoder(open(WORDS, encoding="utf-8").read())
    rng = random.Random(5)
    letters = list("abSTrevelLmd") * 3 + list("'" * 4 + "?.59 \n\x0b") * 3 + ["é", "Ø", "Ⱥ", "ŉ"]
    texts = ["it'", "s", "'", "", "'r", "e", "''s", "5'S't", "'LLs'", "'lx"]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(2_000)]
    pieces, first = encoder._split(pa.array(texts))
    got = [p.lower() for p in pieces.to_pylist()]
    assert [got[a:b] for a, b in zip(first[:-1], first[1:])] == [regex.findall(binary._PATTERN, t.lower()) for t in texts]
    pieces, first = encoder._split(pa.array(["Der Hund’s it's", None, "a ×\x01b, c.", "x<|endoftext|> y."]))
    assert pieces.to_pylist() == ["der", "Hund’s", "it", "'s", "a", "×\x01b,", "c", ".", "x<|endoftext|>", "y."]
    assert first.tolist() == [0, 4, 4, 8, 10]


def test_words_that_the_vocabulary_cannot_spell():
    parts = json.load(open(WORDS, encoding="utf-8"))
    vocabulary, merges = parts["model"]["vocab"], parts["model"]["merges"]
    parts["model"]["vocab"] = {token: i for token, i in vocabulary.items() if "z" not in token}
    parts["model"]["merges"] = [m for m in merges if "z" not in "".join(m)]
    definition = json.dumps(parts)
    tokenizer, texts = Tokenizer.from_str(definition), ["Fizz and zoo, it's", "zz", "words of others"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in binary.PieceEncoder(definition).encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_known_pieces_cost_less_than_strings():
    """Texts of known words take less time than only splitting them and looking up each piece as a string."""
    encoder = binary.PieceEncoder(open(WORDS, encoding="utf-8").read())
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(2_000)]
    texts = [" ".join(rng.choices(words, k=2_000)) + "." for _ in range(200)]
    known = {word: encoder.encode([word])[0] for word in [*words, "."]}
    split, ours, plain = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[!-/:-@\[-`{-~]+").findall, [], []
    for _ in range(4):
        start = time.process_time()
        got = encoder.encode(texts)
        ours.append(time.process_time() - start)
        start = time.process_time()
        want = [b"".join(map(known.__getitem__, split(text))) for text in texts]
        plain.append(time.process_time() - start)
        assert got == want
    assert min(ours) < min(plain)


def _mined(rows, settings):
    """Collocations by the definition, on (text, lang) rows."""
    counts = Counter()
    for text, lang in rows:
        lowered = (text or "").encode().lower().decode()
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i:i + size])] += 1
    total = Counter()
    for (lang, phrase), a in counts.items():
        total[lang] += a * (len(phrase) == 1)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= settings.least}
    kept = {}
    for (lang, phrase), a in candidates.items():
        if any(other == lang and len(longer) > len(phrase) and 100 * b >= settings.inside * a
               and any(longer[i:i + len(phrase)] == phrase for i in range(len(longer)))
               for (other, longer), b in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((settings.scale * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        kept.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r))
    return {(lang, rank + 1, phrase.decode(), -a, l, r, total[lang], -score)
            for lang, found in kept.items()
            for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:settings.top])}


@pytest.mark.parametrize("settings", [
    collocations.Settings(least=3, trigger=4, top=40), collocations.Settings(least=2, trigger=1, inside=60)])
def test_collocations_equal_brute_force(spark, odd, none, settings):
    rng = random.Random(5)
    passage = " ".join(rng.choices(["eau", "de", "vie", "ou", "not", "Ünter"], k=200))
    rows = [(i, " ".join(rng.choices(["a", "b.", "c", "d,", "A", "é"], k=rng.randint(0, 60))) + " " + passage[:rng.randint(0, 400)],
             rng.choice(["en", "fr", None])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    key = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert {tuple(r[k] for k in key) for r in collocations.mine(docs, settings).collect()} == _mined(
        [r[1:] for r in rows], settings)
    assert {tuple(r[k] for k in key) for r in collocations.mine(odd, settings).collect()} == _mined(
        [(r[1], r[2]) for r in ODD + MORE], settings)
    assert collocations.mine(none, settings).collect() == []


def test_chunks_overlap_by_a_trigger_and_own_each_word_once():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["w%d" % i for i in range(30)], k=500)) for _ in range(3)] + ["", " .\n", "one"]
    found, owner, own = collocations.chunks(pa.array(texts), 8)
    assert own.sum() == 1501 and len(found) > 100
    for number, text in enumerate(texts[:3]):
        words = text.split()
        mine = [c for c, o in zip(found, owner) if o == number]
        at = 0
        for chunk, count in zip(mine, own[owner == number]):
            body, _, closing = chunk.decode().partition("\t")
            assert body.split() == words[at:at + count]
            at += count
            assert closing.split() == words[at:at + 3]
        assert at == 500


def test_equal_passages_give_equal_chunks():
    rng = random.Random(2)
    passage = " ".join(rng.choices(["w%d" % i for i in range(50)], k=400))
    found, owner, _ = collocations.chunks(pa.array(["one. " + passage, "quite another start: " + passage]), 8)
    first, second = ({c for c, o in zip(found, owner) if o == n} for n in (0, 1))
    assert len(first & second) > 0.8 * len(first)


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    frequent = spark.createDataFrame(
        [("x", "a", 1, big + 2), ("x", "b", 1, big + 5), ("x", "a b", 2, big)], "lang string, phrase string, words int, times long")
    row = collocations.scored(frequent, collocations.Settings()).first()
    assert row.score == 2_000_000 * big // (2 * big + 7)


def _rearranged(doc_id, text):
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted([h1 % (len(text) + 1), h2 % (len(text) + 1)])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("piece", [5, 1 << 16])
def test_infill_equals_brute_force(spark, odd, none, piece):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("ab<>PSM é\n😀", k=rng.randint(0, 40)))) for i in range(20, 220)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    outputs = infill.pieces(docs, infill.Settings(piece=piece))
    want, whole = Counter(), Counter()
    for doc_id, text in [r[:2] for r in ODD + MORE] + rows:
        text = text or ""
        form, prefix, middle, output = _rearranged("null" if doc_id is None else doc_id, text)
        whole[doc_id, form, output] += 1
        want[doc_id, len(text), form, prefix, middle, hashlib.sha256(output.encode()).hexdigest(),
             hashlib.sha256(text.encode()).hexdigest()] += 1
    assert {"plain", "spm", "psm"} == {form for _, form, _ in whole}
    assert Counter(map(tuple, infill.digests(outputs).collect())) == want
    assert Counter(map(tuple, infill.texts(outputs).collect())) == whole
    assert outputs.selectExpr("max(length(piece)) as most").first().most <= piece + 3
    assert infill.digests(infill.pieces(none)).collect() == []


def test_infill_needs_one_shuffle(spark, odd):
    plan = infill.digests(infill.pieces(odd))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
