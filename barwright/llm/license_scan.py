"""License scan: an exact containment join of text blocks with notice templates, with DataFrame
functions only.

Texts are lower-cased in A-Z and cut into words. A template of more than ``SHORT`` words is met by a
block that holds at least ``threshold`` of its distinct words; a block is any ``WIDE`` times as many
consecutive words as the template has, wherever they begin. Shorter templates are met by their words one
after the other. One pass over the texts keeps where the words of templates stand; the rest works on
these places. The words are ordered by the number of documents that hold them, rarest first, and:

* prefix filter: a block that meets a template holds one of its first ``size - need + 1`` words, so
  only the surroundings of such a word are looked at, taking it for the rarest shared one,
* length filter: enough places of the template's words stand around it,
* positional filter: enough different words that come after it in the order are among them.

What passes is verified block by block, each beginning at a word of the template (others hold no more of
them). Base labels come from phrases: places where the words of a phrase stand one after the other.
Templates are a parameter, some thousand at most, so broadcasting them is safe; documents are joined
with nothing.

A null text is empty: no words, no labels, score 0. Repeated rows give repeated results, a null
doc_id stays null, columns other than doc_id and text are ignored, an empty table gives an empty
result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import UPPER, stored, text_key

# The phrases of the base labels, and opening words of well-known notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files to deal in the software without "
            "restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a "
               "copy of the license at"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license as published by the free software "
            "foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international "
                 "license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
]
THRESHOLD = 0.9
# Words of a template whose words have to follow one another; words of a block for each of a template.
SHORT, WIDE = 8, 2
SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                               *range(0x7B, 0x80)]))


def words_of(text: Column) -> Column:
    """The words: runs of digits, letters and code points from U+0080 on."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS,
                        UPPER.lower() + " " * len(SEPARATORS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


Templates = list[tuple[str, str]]


def known_words(templates: Templates = TEMPLATES) -> list[str]:
    return sorted({w for _, text in templates for w in text.split()})


def strings(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def word_order(scanned: DataFrame, known: list[str]) -> list[int]:
    """The numbers of the templates' words, rarest in the documents first; ties by the word."""
    counts = scanned.select(F.explode(F.array_distinct("hits.word")).alias("word"))
    found = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.count("*").alias("n"))
             .collect()}  # at most as many as the templates have words
    return sorted(range(len(known)), key=lambda w: (found.get(w, 0), w))


class Template:
    """A template's words in the global order, and how many of them a block needs."""

    def __init__(self, number: int, label: str, text: str, rank: dict[str, int], threshold: float):
        words = text.split()
        self.number, self.label, self.words = number, label, [rank[w] for w in words]
        self.ranks = sorted({*self.words})
        self.short = len(words) <= SHORT
        self.need = len(self.ranks) if self.short else max(1, ceil(threshold * len(self.ranks) - 1e-9))
        self.prefix = self.ranks[:len(self.ranks) - self.need + 1]
        self.span = len(words) if self.short else WIDE * len(words)

    def entries(self) -> list[tuple]:
        """(rank, offset, template, label, short, span, need, ranks, words) for each prefix word; of a
        short one for each place of its rarest word."""
        offsets = [i for i, w in enumerate(self.words) if w == self.ranks[0]] if self.short else [0]
        return [(r, o, self.number, self.label, self.short, self.span, self.need, self.ranks, self.words)
                for r in self.prefix for o in offsets]


def phrase_places(words: Column) -> Column:
    """The places of all phrases, as structs (place, label)."""
    last = F.sequence(F.lit(0), F.size(words) - 1)

    def label(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, name in PHRASES.items():
            parts = phrase.split()
            stands = F.get(words, i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                stands = stands & (F.get(words, i + k) == part)
            found = F.when(stands, F.lit(name)).otherwise(found)
        return found

    places = F.transform(last, lambda i: F.struct(i.alias("place"), label(i).alias("label")))
    none = F.array().cast("array<struct<place:int,label:string>>")
    starts = strings(sorted({p.split()[0] for p in PHRASES}))
    ends = F.array_contains(words, "license")
    return F.when(ends & F.arrays_overlap(words, starts),
                  F.filter(places, lambda p: p["label"].isNotNull())).otherwise(none)


def hits(words: Column, known: list[str]) -> Column:
    """Where words of templates stand: (place, number of the word), in the order of the text."""
    number = F.create_map(*[x for n, w in enumerate(known) for x in (F.lit(w), F.lit(n))])
    placed = F.transform(words, lambda w, i: F.struct(
        i.alias("place"), F.try_element_at(number, w).alias("word")))
    return F.filter(placed, lambda h: h["word"].isNotNull())


def meetings(scanned: DataFrame, templates: list[Template], order: list[int]) -> DataFrame:
    """row, label and share of every template that a block of a text meets around some prefix word."""
    spark = scanned.sparkSession
    entry = spark.createDataFrame(
        [e for t in templates for e in t.entries()],
        "rank int, offset int, template int, label string, short boolean, span int, need int, "
        "ranks array<int>, words array<int>")
    prefix = F.array(*[F.lit(r) for r in sorted({r for t in templates for r in t.prefix})])
    widest = max(t.span for t in templates)
    rank = [0] * len(order)
    for r, word in enumerate(order):
        rank[word] = r
    ranked = scanned.select("row", F.transform("hits", lambda h: F.struct(
        h["place"].alias("place"), F.get(F.array(*map(F.lit, rank)), h["word"]).alias("rank"))).alias("hits"))
    # Around each prefix word the words that are not before it in the order.
    around = F.transform(
        F.filter("hits", lambda h: F.array_contains(prefix, h["rank"])),
        lambda p: F.struct(p["place"].alias("place"), p["rank"].alias("rank"), F.filter(
            "hits", lambda h: (h["rank"] >= p["rank"]) & (
                F.abs(h["place"] - p["place"]) < widest)).alias("near")))
    near = ranked.select("row", F.explode(around).alias("at")).select(
        "row", F.col("at.place").alias("at"), F.col("at.rank").alias("rank"), "at.near").join(
        F.broadcast(entry), "rank")

    first = F.col("at") - F.col("offset")
    run = F.transform(F.filter("near", lambda h: (h["place"] >= first) & (
        h["place"] < first + F.col("span"))), lambda h: h["rank"])
    in_a_row = near.where("short").where(run == F.col("words")).select(
        "row", "template", "label", F.lit(1.0).alias("share"))

    mine = F.filter("near", lambda h: F.array_contains("ranks", h["rank"]) & (
        F.abs(h["place"] - F.col("at")) < F.col("span")))
    hopeful = near.where("NOT short").withColumn("mine", mine).where(
        (F.size("mine") >= F.col("need"))
        & (F.size(F.array_distinct("mine.rank")) >= F.col("need")))
    starts = F.filter("mine", lambda s: (s["place"] <= F.col("at")) & (
        s["place"] > F.col("at") - F.col("span")))
    shared = F.array_max(F.transform(starts, lambda s: F.size(F.array_distinct(F.transform(
        F.filter("mine", lambda h: (h["place"] >= s["place"]) & (
            h["place"] < s["place"] + F.col("span"))), lambda h: h["rank"])))))
    wide = hopeful.withColumn("shared", shared).where(F.col("shared") >= F.col("need")).select(
        "row", "template", "label", (F.col("shared") / F.size("ranks")).alias("share"))
    return in_a_row.unionByName(wide)


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD,
                  templates: Templates = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every text.

    ``templates`` are labels with notices in lower case, whole or in part, their words one space apart.
    score is the largest share of a template's words in a block that meets it, at least 1 for a
    base phrase, and 0 where nothing was found.
    """
    known = known_words(templates)
    # The one pass over the texts: counts, and places of phrases and of template words.
    rows = docs.select("doc_id", text_key().alias("text_key"), words_of(F.col("text")).alias("words"))
    scanned = stored(rows.select(
        F.struct("doc_id", "text_key").alias("key"), F.size("words").cast("long").alias("n_words"),
        phrase_places(F.col("words")).alias("places"), hits(F.col("words"), known).alias("hits")), "licenses")
    order = word_order(scanned, known)
    rank = {known[w]: r for r, w in enumerate(order)}
    forms = [Template(n, label, text, rank, threshold) for n, (label, text) in enumerate(templates)]
    prefix = F.array(*[F.lit(order[r]) for r in sorted({r for t in forms for r in t.prefix})])
    met = meetings(scanned.where(F.arrays_overlap("hits.word", prefix)).select(
        F.col("key").alias("row"), "hits"), forms, order)
    best = met.groupBy("row").agg(F.collect_set("label").alias("more"),
                                  F.max("share").alias("share"))
    joined = scanned.drop("hits").join(best, F.col("key").eqNullSafe(F.col("row")), "left")
    places = F.col("places")
    base = F.array_sort(F.array_distinct(places["label"]))
    n_base = F.size(places).cast("long")
    both = F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))
    score = F.greatest(F.coalesce("share", F.lit(0.0)),
                       F.when(n_base > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return joined.select(
        "key.doc_id", "n_words", n_base.alias("n_base"),
        F.array_min(places["place"]).cast("long").alias("first_word"),
        F.array_max(places["place"]).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"), score.alias("score"))


def license_scan_sql(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL that looks at every word for the phrases and at every word for a block that begins there."""
    def quoted(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    cases = " ".join(
        "WHEN " + " AND ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(phrase.split(), 1))
        + f" THEN '{label}'" for phrase, label in PHRASES.items())
    short = ", ".join(f"('{label}', {quoted(text.split())})" for label, text in TEMPLATES
                      if len(text.split()) <= SHORT)
    wide = ", ".join(
        f"('{label}', {quoted(words)}, {max(1, ceil(threshold * len(words) - 1e-9))}, "
        f"{WIDE * len(text.split())})"
        for label, text in TEMPLATES if len(text.split()) > SHORT for words in [sorted({*text.split()})])
    return rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2f\x3a-\x60\x7b-\x7f]+') AS w FROM documents),
short(label, words) AS (VALUES {short}),
wide(label, words, need, span) AS (VALUES {wide}),
starts AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM docs),
places AS (SELECT doc_id, i, CASE {cases} END AS label FROM starts),
base AS (
  SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b, list(DISTINCT label) AS found
  FROM places WHERE label IS NOT NULL GROUP BY doc_id),
-- Texts without enough of a template's words have no block with them.
met AS (
  SELECT doc_id, label, 1.0::DOUBLE AS share FROM (
    SELECT doc_id, w, label, words, unnest(range(len(w))) AS i
    FROM docs JOIN short ON list_has_all(w, words)) s
  WHERE w[i + 1] = words[1] AND list_slice(w, i + 1, i + len(words)) = words
  UNION ALL
  SELECT doc_id, label, len(list_intersect(words, list_slice(w, i + 1, i + span))) / len(words) FROM (
    SELECT doc_id, w, label, words, need, span, unnest(range(len(w))) AS i
    FROM docs JOIN wide ON len(list_intersect(words, w)) >= need) s
  WHERE list_contains(words, w[i + 1])
    AND len(list_intersect(words, list_slice(w, i + 1, i + span))) >= need),
more AS (
  SELECT doc_id, list(DISTINCT label) AS found, max(share) AS share FROM met GROUP BY doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base,
       a AS first_word, b AS last_word,
       coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(
         coalesce(base.found, []), coalesce(more.found, [])))), ','), '') AS labels,
       greatest(coalesce(share, 0.0), CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END) AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""
