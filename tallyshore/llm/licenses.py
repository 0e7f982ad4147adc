"""License scans: base phrases, and templates found by an exact set-similarity join. SQL functions only."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import Scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases whose words must stand side by side, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Content words of license notices. Words that any text may hold are left out.
TEMPLATES = (
    ("mit", "released mit license"),
    ("mit", "permission hereby granted free charge person obtaining copy software associated documentation files"),
    ("apache", "licensed apache license version"),
    ("gpl", "work licensed gnu general public license version"),
    ("gpl", "program free software redistribute modify terms gnu general public license published foundation"),
    ("bsd", "redistribution source binary forms modification permitted provided conditions met"),
    ("mpl", "source code form subject terms mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-nc", "licensed creative commons attribution noncommercial"),
    ("cc0", "waived copyright related neighboring rights cc0 public domain dedication"),
)
THRESHOLD = 0.8
REACH = 3  # a notice that is spread over lines has its words within so many times the words of its template


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def phrase_starts(found: Column, phrases: Mapping[str, str]) -> Column:
    """Array of (start, label) of each place in an array of words where a phrase stands."""
    def at(i: Column) -> Column:
        hits = []
        for phrase, label in phrases.items():
            same = [F.get(found, i + k) == word for k, word in enumerate(phrase.split())]
            fits = same[0]
            for s in same[1:]:
                fits = fits & s
            hits.append(F.when(fits, F.struct(i.cast("long").alias("start"), F.lit(label).alias("label"))))
        return F.filter(F.array(*hits), lambda h: h.isNotNull())

    firsts = [p.split()[0] for p in phrases]
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0))),
                      lambda i: F.get(found, i).isin(firsts))
    return F.flatten(F.transform(places, at))


def _sets(templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, list[str]]]:
    return [(i, label, sorted(set(text.split()))) for i, (label, text) in enumerate(templates)]


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row.

    Base labels come from the phrases. Further ones come from text blocks that
    hold at least ``threshold`` of the words of a template. Blocks are the lines,
    and for wrapped notices all runs of ``REACH`` times a template's words, wherever
    lines end. The text is cut into overlapping pieces that hold every such
    run whole, and the best run is looked for in the pieces that meet a template. Words are
    ordered by how many blocks hold them, rare ones first. A block with enough
    of a template's words has one of its first size - need + 1 words, so blocks and
    templates meet in an equi-join on those; a block with too few words, or
    with too few left behind the place of the meeting, is dropped, and the rest is
    counted in full. The score is 1 for a phrase, else the largest share of a
    template, else 0.

    A null or empty text has no words and empty labels. Rows are told apart by a
    number of their own, so those that repeat an id, or have none, get the labels of their texts.
    """
    spark = docs.sparkSession
    sets = _sets(templates)
    vocabulary = sorted({w for _, _, ws in sets for w in ws})
    scratch = Scratch(spark, "licenses")
    # lower() is far faster than replacing A-Z one by one. It keeps other letters beyond ASCII, where
    # they are part of words and match nothing, but for the Kelvin sign, which is put out of its way.
    text = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u2603")))
    split = F.transform(F.split(text, "\n"), words)
    listed = F.array(*map(F.lit, vocabulary))
    ends = sorted({p.split()[-1] for p in phrases})
    maybe = F.lit(False)
    for end in ends:
        maybe = maybe | F.contains(text, F.lit(end))
    # as a lambda's argument the words are worked out once, not for each place
    base = F.get(F.transform(F.array(words(text)), lambda found: phrase_starts(found, phrases)), F.lit(0))
    half = REACH * max((len(ws) for _, _, ws in sets), default=1)  # a piece has twice as many words
    least = min((math.ceil(threshold * len(ws)) for _, _, ws in sets), default=1)

    def pieces(found: Column) -> Column:
        cut = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0)), F.lit(half)),
            lambda start: F.slice(found, start + 1, 2 * half))
        cut = F.filter(cut, lambda w: F.size(F.array_intersect(w, listed)) >= least)
        return F.transform(cut, lambda w: F.filter(
            F.transform(w, lambda token, at: F.struct(at.alias("at"), token.alias("token"))),
            lambda h: h["token"].isin(vocabulary)))

    def parts(lines: Column) -> Column:
        several = F.size(F.filter(lines, lambda w: F.size(w) > 0)) > 1
        return F.struct(
            F.transform(lines, lambda w: F.struct(
                F.size(w).alias("n"), F.array_intersect(w, listed).alias("tokens"))).alias("lines"),
            F.when(several, F.get(F.transform(F.array(F.flatten(lines)), pieces), F.lit(0))).alias("pieces"))

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.when(maybe, base).alias("base"),
                       F.get(F.transform(F.array(split), parts), F.lit(0)).alias("parts"))
    rows = scratch.keep(rows.select(
        "doc_id", "row", F.aggregate("parts.lines", F.lit(0).cast("long"), lambda s, b: s + b["n"]).alias("n_words"),
        F.coalesce("base", F.expr("array()").cast("array<struct<start:bigint,label:string>>")).alias("base"),
        F.filter(F.transform("parts.lines", lambda b: b["tokens"]), lambda t: F.size(t) > 0).alias("blocks"),
        F.col("parts.pieces").alias("pieces")), "rows")

    blocks = rows.select("row", F.explode("blocks").alias("tokens"))
    wrapped = rows.select("row", F.explode("pieces").alias("found")).select(
        "row", F.array_distinct(F.transform("found", lambda h: h["token"])).alias("tokens"), "found")
    counts = {r[0]: r[1] for r in blocks.select(F.explode("tokens").alias("token")).groupBy("token").count().collect()}
    ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))  # of the templates' words only
    rank = {w: i for i, w in enumerate(ordered)}
    index = []
    for i, label, ws in sets:
        ws = sorted(ws, key=rank.get)
        need = math.ceil(threshold * len(ws))
        index += [(w, i, label, ws, need, place) for place, w in enumerate(ws[:len(ws) - need + 1])]
    prefixes = spark.createDataFrame(
        index, "token string, template int, label string, words array<string>, need int, place int")
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    sorted_tokens = F.transform(
        F.array_sort(F.transform("tokens", lambda t: F.struct(F.get(F.map_values(F.map_filter(
            ranks, lambda k, _: k == t)), F.lit(0)).alias("rank"), t.alias("token")))), lambda s: s["token"])
    probes = blocks.withColumn("found", F.lit(None).cast(wrapped.schema["found"].dataType)).unionByName(wrapped).filter(
        F.size("tokens") >= least).select("row", sorted_tokens.alias("tokens"), "found").select(
        "row", "tokens", "found", F.posexplode("tokens").alias("at", "token"))

    def best(own: Column) -> Column:
        """The most different words in a run, of those words of a piece that a template has."""
        return F.array_max(F.transform(own, lambda first: F.size(F.array_distinct(F.transform(
            F.filter(own, lambda h: (h["at"] >= first["at"]) & (h["at"] < first["at"] + REACH * F.size("words"))),
            lambda h: h["token"])))))

    held = F.when(F.col("found").isNull(), F.size(F.array_intersect("tokens", "words"))).otherwise(
        best(F.filter("found", lambda h: F.array_contains("words", h["token"]))))
    share = held / F.size("words")
    candidates = (
        probes.join(prefixes, "token")
        .filter((F.size("tokens") >= F.col("need"))
                & (F.least(F.size("words") - F.col("place"), F.size("tokens") - F.col("at")) >= F.col("need")))
        .withColumn("share", share).filter(F.col("share") >= threshold))
    hits = candidates.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share"))
    labels = F.array_distinct(F.transform("base", lambda b: b["label"]))
    starts = F.transform("base", lambda b: b["start"])
    all_labels = F.array_union(labels, F.coalesce("more", F.expr("array()").cast("array<string>")))
    return rows.join(hits, "row", "left").select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(all_labels), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
