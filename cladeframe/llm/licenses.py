"""License scan by diagonal voting.

All rolling word k-grams of the documents are hashed and Spark-joined to the k-grams of license notices. A match at
document word i and template word j votes for the diagonal i - j. Votes are summed per document, template and diagonal;
diagonals at most `slack` apart merge, so that a few inserted or missing words don't break a notice. A merged group is
verified: what it covers must be at least min_cover of the template's words and of the document's words from its first
to its last match, and the part of a template that stands in brackets, the name, must stand in the document word by
word: so neither "lesser" nor "affero" in a GPL notice, nor "noncommercial" in one of CC BY, counts as an inserted word.
Of verified spans that overlap under different labels the one with the highest cover, then the most words, then all
equals, are kept. Besides, fixed phrases are found word by word.

Cases: a null or empty text has no words, no labels and score 0. Texts shorter than a k-gram can only hold phrases.
Very long texts are scanned whole; the votes of a document are bounded by its length. Repeated rows are scanned alike.
Templates that tie in one place are all reported. An empty table gives an empty result. Other columns are ignored,
whatever their names. The templates are a list known to the driver, and broadcast if it has at most BROADCAST_ROWS words;
Spark shuffles a longer one. Native: DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, bind, value_key, words

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Names of licenses that come in families, by label.
GNU = {"gpl": ["gnu general public license"], "lgpl": ["gnu lesser general public license", "gnu library general public license"], "agpl": ["gnu affero general public license"]}
CREATIVE = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
CC_KINDS, CC_VERSIONS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"), ("2 0", "2 5", "3 0", "4 0")
#: Sentences of public licenses and usual notices, by label; the name stands in brackets.
SENTENCES = [
    ("apache-1.1", "licensed under [the apache software license version 1 1]"),
    ("apache-2.0", "licensed under [the apache license version 2 0]"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under [the mit license]"),
    ("mit", "licensed under [the mit license]"),
    ("mpl-1.1", "subject to [the mozilla public license version 1 1] the license you may not use this file except in compliance with the license"),
    ("mpl-2.0", "this source code form is subject to the terms of [the mozilla public license v 2 0]"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
K, SLACK, MIN_COVER = 3, 3, 0.8


def notices() -> list[tuple[str, str]]:
    """SENTENCES, and the usual notices of the families by rule."""
    out = list(SENTENCES)
    for label, names in GNU.items():
        for name in names:
            out.append((label, f"this program is free software you can redistribute it and or modify it under the terms of [the {name}]"))
            out.append((label, f"this work is licensed under [the {name}]"))
    for kind in CC_KINDS:
        long = " ".join(CREATIVE[x] for x in kind.split())
        for version in CC_VERSIONS:
            out.append((f"cc-{kind.replace(' ', '-')}", f"licensed under a [creative commons {long} {version}]"))
            out.append((f"cc-{kind.replace(' ', '-')}", f"licensed under [cc {kind} {version}]"))
    return out


def parsed(body: str, k: int) -> tuple[list[str], list[int]]:
    """Words of a template, and the starts of the k-grams that its name consists of."""
    own, name = [], []
    for i, part in enumerate(re.split(r"[\[\]]", body)):
        if i % 2:
            n = len(part.split())
            name += range(len(own), len(own) + n - k + 1)
        own += part.split()
    return own, name


def gram_hashes(own: Column, k: int) -> Column:
    def grams(w: Column) -> Column:
        one = lambda i: F.xxhash64(*[F.get(w, i + d) for d in range(k)])
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), one)).otherwise(F.array().cast("array<bigint>"))

    return bind(own, grams)


def phrase_places(own: Column, lowered: Column, phrase: str) -> Column:
    """Starts of the phrase in the array; lowered: the text, to leave most documents out cheaply."""
    parts = phrase.split()

    def at(i: Column, w: Column) -> Column:
        same = F.get(w, i) == parts[0]
        for d, part in enumerate(parts[1:], 1):
            same = same & (F.get(w, i + d) == part)
        return same

    none = F.array().cast("array<int>")
    may = F.size(own) >= len(parts)
    for part in parts:
        may = may & F.contains(lowered, F.lit(part))
    found = bind(own, lambda w: F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), lambda i: at(i, w)))
    return F.when(may, found).otherwise(none)


def template_grams(docs: DataFrame, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(template, label, length, name, at, h): the k-grams of all templates."""
    rows = []
    for n, (label, body) in enumerate(templates):
        own, name = parsed(body, k)
        rows.append(F.struct(F.lit(n).alias("template"), F.lit(label).alias("label"), F.lit(" ".join(own)).alias("body"), (F.array(*map(F.lit, name)) if name else F.array()).cast("array<int>").alias("name")))
    t = docs.sparkSession.range(1).select(F.inline(F.array(*rows))).withColumn("words", F.split("body", " "))
    out = t.select("template", "label", F.size("words").alias("length"), "name", F.posexplode(gram_hashes(F.col("words"), k)).alias("at", "h"))
    return F.broadcast(out) if sum(len(body.split()) for _, body in templates) <= BROADCAST_ROWS else out


def verified_spans(texts: DataFrame, grams: DataFrame, k: int, slack: int, min_cover: float) -> DataFrame:
    """(k1, k2, spans): array<struct<label, first, last, cover>> of texts(k1, k2, words)."""
    rolled = texts.select("k1", "k2", F.posexplode(gram_hashes(F.col("words"), k)).alias("i", "h"))
    votes = rolled.join(grams, "h").select("k1", "k2", "template", "label", "length", "name", "at", (F.col("i") - F.col("at")).alias("diagonal"))
    key = ["k1", "k2", "template", "label", "length"]
    lines = votes.groupBy(*key, "name", "diagonal").agg(F.collect_set("at").alias("at"))
    own = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(own) > slack).cast("int")
    lines = lines.withColumn("band", F.sum(F.coalesce(apart, F.lit(0))).over(own)).withColumn("named", F.size(F.array_except("name", "at")) == 0)
    places = F.flatten(F.transform("at", lambda a: F.sequence(a, a + (k - 1))))
    lines = lines.withColumn("at", F.array_distinct(places)).withColumn("i", F.transform("at", lambda a: a + F.col("diagonal")))
    merged = lines.groupBy(*key, "band").agg(F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("i")).alias("i"), F.bool_or("named").alias("named"))
    merged = merged.where("named").select("k1", "k2", "label", "length", F.size(F.array_distinct("at")).alias("known"), F.size(F.array_distinct("i")).alias("held"), F.array_min("i").cast("int").alias("first"), F.array_max("i").cast("int").alias("last"))
    cover = F.least(F.col("known") / F.col("length"), F.col("held") / (F.col("last") - F.col("first") + 1))
    spans = merged.withColumn("cover", cover).where(F.col("cover") >= min_cover)

    # overlapping spans are islands; within one, a span yields to a better one of another label
    order = Window.partitionBy("k1", "k2").orderBy("first", "last", "label")
    new = (F.col("first") > F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))).cast("int")
    spans = spans.withColumn("new", F.coalesce(new, F.lit(0))).withColumn("island", F.sum("new").over(order))
    spans = spans.groupBy("k1", "k2", "island").agg(F.collect_set(F.struct("label", "first", "last", "cover", "known")).alias("s"))
    better = lambda x, y: (x["label"] != y["label"]) & (x["first"] <= y["last"]) & (y["first"] <= x["last"]) & (F.struct(x["cover"], x["known"]) > F.struct(y["cover"], y["known"]))
    kept = F.filter("s", lambda y: ~F.exists("s", lambda x: better(x, y)))
    slim = F.transform(kept, lambda x: F.struct(x["label"].alias("label"), x["first"].alias("first"), x["last"].alias("last"), x["cover"].alias("cover")))
    return spans.groupBy("k1", "k2").agg(F.array_sort(F.flatten(F.collect_list(slim))).alias("spans"))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, k: int = K, slack: int = SLACK, min_cover: float = MIN_COVER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, places, base_labels, labels, score, spans) for every row. places: starts of the phrases; score: the
    best cover of a notice, 1 where a phrase stands; spans: array<struct<label, first, last, cover>>."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.select(*value_key("id", "text"), "id", ascii_lower(F.coalesce("text", F.lit(""))).alias("low"))
    texts = texts.withColumn("words", words(F.col("low"), NO_WORD))
    places = {phrase: phrase_places(F.col("words"), F.col("low"), phrase) for phrase in PHRASES}
    base = texts.select(
        "k1", "k2", "id", F.size("words").cast("long").alias("n_words"),
        F.struct(*[c.alias(f"p{i}") for i, c in enumerate(places.values())]).alias("p"),
    )
    labels = F.array_compact(F.array(*[F.when(F.size(F.col("p")[f"p{i}"]) > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]))
    base = base.select("k1", "k2", "id", "n_words", F.array_sort(F.concat(*[F.col("p")[f"p{i}"] for i in range(len(PHRASES))])).alias("places"), labels.alias("base_labels"))

    spans = verified_spans(texts.select("k1", "k2", "words"), template_grams(docs, notices() if templates is None else templates, k), k, slack, min_cover)
    out = base.join(spans, ["k1", "k2"], "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<label:string,first:int,last:int,cover:double>>")))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "n_words", "places", F.array_sort("base_labels").alias("base_labels"),
        F.array_sort(F.array_union("base_labels", F.array_distinct(F.transform("spans", lambda s: s["label"])))).alias("labels"),
        F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(best).alias("score"), "spans",
    )
