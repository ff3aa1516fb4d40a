"""Licence scans with a positional index of rare template words, from DataFrame functions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from loglode.llm.tables import ascii_lower, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases that are looked for as they stand, and the labels they give.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Label, a part of the licence's public notice, and the words of it that must be there.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 you may not use this file except in compliance "
        "with the license",
        "apache license version 2",
    ),
    (
        "gpl-2",
        "licensed under the gnu general public license version 2",
        "gnu general public license version 2",
    ),
    (
        "gpl-3",
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license version 3",
    ),
    (
        "lgpl",
        "licensed under the terms of the gnu lesser general public license",
        "gnu lesser general public license",
    ),
    (
        "agpl-3",
        "licensed under the gnu affero general public license version 3",
        "gnu affero general public license",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted",
        "with or without fee is hereby granted",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
]
#: Rarest words of a template that are in the index, beside those of its key phrase.
RAREST = 8
#: Least share of a template's indexed weight that must stand in place.
SHARE = 0.5


def with_words(docs: DataFrame) -> DataFrame:
    """doc_id, words and joined: the lower-cased words of the text, and them between spaces."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    joined = F.trim(F.regexp_replace(text, SEPARATORS, " "))
    rows = docs.select(F.col("doc_id").cast("long"), joined.alias("joined"))
    words = F.filter(F.split("joined", " "), lambda word: word != "")
    return rows.select("doc_id", F.concat(F.lit(" "), "joined", F.lit(" ")).alias("joined"), words.alias("words"))


def word_weights(rows: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """The IDF of each template word over all documents.

    The result has a number per word of the templates, at any size of the input.
    """
    wanted = F.array(*map(F.lit, vocabulary))
    present = rows.select(F.explode(F.array_intersect("words", wanted)).alias("word"))
    counts = {row["word"]: row["n"] for row in present.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = rows.count()
    return {word: math.log((1 + total) / (1 + counts.get(word, 0))) + 1e-9 for word in vocabulary}


def places_in(words: list[str], phrase: list[str]) -> range:
    """Where the words of a phrase stand in a template."""
    for start in range(len(words) - len(phrase) + 1):
        if words[start : start + len(phrase)] == phrase:
            return range(start, start + len(phrase))
    raise ValueError(f"{' '.join(phrase)} is not in its template")


def index(weights: dict[str, float]) -> tuple[dict[str, list[tuple]], list[tuple]]:
    """Postings (template, place, weight, 1 if of the key phrase) per word, and per template its
    label, key words and whole indexed weight.

    A template is indexed by its key phrase and by the places of its rarest words.
    """
    postings: dict[str, list[tuple]] = {}
    templates = []
    for number, (label, notice, phrase) in enumerate(TEMPLATES):
        words = notice.split()
        key = places_in(words, phrase.split())
        rare = sorted(set(words), key=lambda word: (-weights[word], word))[:RAREST]
        places = [i for i, word in enumerate(words) if i in key or word in rare]
        for place in places:
            entry = (number, place, weights[words[place]], int(place in key))
            postings.setdefault(words[place], []).append(entry)
        templates.append((label, len(key), sum(weights[words[place]] for place in places)))
    return postings, templates


def phrase_places(phrase: str) -> Column:
    """Numbers of the words at which a phrase starts; texts without it are not searched."""
    parts = phrase.split()
    starts = F.sequence(F.lit(1), F.size("words") - (len(parts) - 1))
    same = lambda i: F.slice(F.col("words"), i, F.lit(len(parts))) == F.array(*map(F.lit, parts))
    found = F.transform(F.filter(starts, same), lambda i: (i - 1).cast("long"))
    return F.when(F.contains("joined", F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<bigint>"))


def spots_of(phrase: str) -> Column:
    """phrase and at for each of its places."""
    name = F.lit(phrase).alias("phrase")
    return F.transform(phrase_places(phrase), lambda at: F.struct(name, at.alias("at")))


def find_licences(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, places, base_labels, labels and score.

    A word is a run of a-z, 0-9 and characters beyond ASCII after lower-casing A-Z. ``places`` has
    phrase and at for every place where a fixed phrase stands. Beside these, each file's words that
    are in the index give templates and where in the file those would start; a template is found
    where all words of its key phrase and at least half of its indexed weight (by IDF over all
    documents) stand at one such start. ``labels`` has the labels of both kinds, sorted. ``score`` is
    the largest share of a found template, 1 where a fixed phrase stands, 0 without a label.

    A null text has no words. Rows that repeat are scanned one by one; an empty table gives no rows;
    other columns are not used. Only rows with index words are grouped, by row and start.
    """
    rows = with_words(docs)
    vocabulary = sorted({word for _, notice, _ in TEMPLATES for word in notice.split()})
    postings, templates = index(word_weights(rows, vocabulary))
    # A template can only be found where the rarest word of its key phrase is.
    anchors = sorted({
        max(phrase.split(), key=lambda word: max(p[2] for p in postings[word]))
        for _, _, phrase in TEMPLATES
    })
    wanted = F.array(*map(F.lit, sorted(postings)))
    numbered = F.transform("words", lambda word, i: F.struct(i.alias("at"), word.alias("word")))
    hits = F.when(
        F.arrays_overlap("words", F.array(*map(F.lit, anchors))),
        F.filter(numbered, lambda hit: F.array_contains(wanted, hit.word)),
    )
    spots = F.concat(*map(spots_of, PHRASES))
    scanned = stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            spots.alias("places"),
            hits.alias("hits"),
        ),
        "scanned",
    )
    entry = lambda p: F.struct(
        F.lit(p[0]).alias("template"), F.lit(p[1]).alias("place"), F.lit(p[2]).alias("weight"), F.lit(p[3]).alias("key")
    )
    lookup = F.create_map(
        *[x for word, found in sorted(postings.items()) for x in (F.lit(word), F.array(*map(entry, found)))]
    )
    seen = scanned.filter("hits is not null").select("row", F.explode("hits").alias("hit"))
    votes = seen.select("row", "hit.at", F.explode(lookup[F.col("hit.word")]).alias("posting"))
    facts = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(key).alias("keys"), F.lit(weight).alias("weight"))
        for label, key, weight in templates
    ])
    starts = votes.groupBy(
        "row", "posting.template", (F.col("at") - F.col("posting.place")).alias("start")
    ).agg(F.sum("posting.key").alias("keys"), F.sum("posting.weight").alias("weight"))
    judged = starts.withColumn("fact", F.element_at(facts, F.col("template") + 1))
    share = F.least(F.lit(1.0), F.col("weight") / F.col("fact.weight"))
    found = judged.filter((F.col("keys") == F.col("fact.keys")) & (share >= SHARE))
    by_row = found.groupBy("row").agg(
        F.collect_set("fact.label").alias("found"), F.max(share).alias("share")
    )
    names = F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda place: names[place.phrase])))
    none = F.array().cast("array<string>")
    return scanned.join(by_row, "row", "left").select(
        "doc_id",
        "n_words",
        "places",
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("found", none))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
