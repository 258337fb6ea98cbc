"""Licence scans by a positional index of each text's rarest licence words; built-in functions only."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import UPPER, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases whose places are counted, with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Notice lines as (label, text, phrases that must stand in it).
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["hereby granted free of charge", "any person obtaining a copy"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms", "with or without modification"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("proprietary", "all rights reserved no part may be reproduced without permission", ["all rights reserved", "without permission"]),
]
#: Rarest words looked up per template, and how many must agree on where it begins.
RARE, AGREE = 3, 2


def words(text: str = "text") -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))


def _list(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rarity(docs: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each licence word over all of ``docs``; the vocabulary bounds the rows."""
    seen = docs.select(F.array_intersect(words(), _list(vocabulary)).alias("w"))
    total = F.count("*").alias("n")
    rows = seen.select(F.explode(F.concat(F.col("w"), F.array(F.lit("")))).alias("w")).groupBy("w").agg(total).collect()
    counts = {r["w"]: r["n"] for r in rows}
    return {w: math.log((counts.get("", 0) + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _begins(hits: Column, word: str, place: int) -> Column:
    """Where a template would begin for each posting of its ``word``, which is its word number ``place``."""
    return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["i"] - place)


def _agreeing(begins: list[Column], agree: int) -> Column:
    def votes(b: Column) -> Column:
        return sum((F.array_contains(x, b).cast("int") for x in begins), F.lit(0))

    every = F.array_distinct(F.flatten(F.array(*begins)))
    return every if agree < 2 else F.filter(every, lambda b: votes(b) >= agree)


def _standing(candidates: Column, all_words: Column, phrase: list[str], at: int) -> Column:
    """The candidates with ``phrase`` at their word ``at``."""
    first = lambda b: F.greatest(b + at, F.lit(0)) + 1
    return F.filter(candidates, lambda b: (b + at >= 0) & (F.slice(all_words, first(b), F.lit(len(phrase))) == _list(phrase)))


def _matches(hits: Column, all_words: Column, text: list[str], picked: list[int], agree: int, phrases: list[list[str]]) -> Column:
    """Places where a template begins: its rare words' postings, cut by relative position, with each phrase in its place."""
    candidates = _agreeing([_begins(hits, text[k], k) for k in picked], agree)
    for phrase in phrases:
        at = next(k for k in range(len(text)) if text[k : k + len(phrase)] == phrase)
        candidates = _standing(candidates, all_words, phrase, at)
    return candidates


def _labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda b: F.struct(b.alias("at"), F.lit(label).alias("label")))


def _shares(places: Column, all_words: Column, label: str, text: list[str]) -> Column:
    """For each place the share of the template's words that stand where they should."""

    def share(b: Column) -> Column:
        return sum((F.coalesce(F.get(all_words, b + k) == w, F.lit(False)).cast("double") for k, w in enumerate(text)), F.lit(0.0)) / len(text)

    return F.transform(places, lambda b: F.struct(F.lit(label).alias("label"), share(b).alias("share")))


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_base, first_word, last_word, base_labels, labels and score.

    A template's score is the share of its words in their places where its key phrases stand; a base phrase alone scores 0.5,
    no label 0. Null and empty texts have no words, no labels and null places; repeated rows are judged alike.
    """
    phrases = [(p.split(" "), label) for p, label in PHRASES]
    templates = [(label, re.findall(WORD, t), [p.split(" ") for p in must]) for label, t, must in TEMPLATES]
    vocabulary = sorted({w for p, _ in phrases for w in p} | {w for _, t, _ in templates for w in t})
    idf = rarity(docs, vocabulary)

    def rarest(text: list[str], n: int) -> list[int]:
        firsts = {w: k for k, w in reversed(list(enumerate(text)))}
        return sorted(firsts.values(), key=lambda k: (-idf[text[k]], k))[:n]

    anchors = [(p, label, rarest(p, 1)) for p, label in phrases]
    looked = [(label, t, must, rarest(t, RARE)) for label, t, must in templates]
    index = sorted({p[k] for p, _, ks in anchors for k in ks} | {t[k] for _, t, _, ks in looked for k in ks})
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "text", "_w", "_hits", "_base", "_more"]
    own = [c for c in docs.columns if c not in made]
    wanted = _list(index)
    postings = F.filter(
        F.transform(F.col("_w"), lambda w, i: F.when(F.array_contains(wanted, w), F.struct(i.alias("i"), w.alias("w")))),
        lambda h: h.isNotNull(),
    )
    rows = docs.select(*own, words().alias("_w"))
    rows = rows.withColumn("_hits", F.when(F.arrays_overlap("_w", wanted), postings).otherwise(F.filter(F.transform(F.slice("_w", 1, 0), lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda h: F.lit(False))))
    hits, all_words = F.col("_hits"), F.col("_w")
    base = F.concat(*[_labelled(_matches(hits, all_words, p, ks, 1, [p]), label) for p, label, ks in anchors])
    more = F.concat(*[_shares(_matches(hits, all_words, t, ks, min(AGREE, len(ks)), must), all_words, label, t) for label, t, must, ks in looked])
    found = rows.withColumn("_base", F.when(F.size(hits) > 0, base)).withColumn("_more", F.when(F.size(hits) > 0, more))
    places, base_names = F.coalesce(F.size("_base"), F.lit(0)), F.transform("_base", lambda b: b["label"])
    empty = F.array().cast("array<string>")
    base_names = F.coalesce(base_names, empty)
    more_names = F.coalesce(F.transform("_more", lambda m: m["label"]), empty)
    score = F.greatest(F.coalesce(F.array_max(F.transform("_more", lambda m: m["share"])), F.lit(0.0)), F.when(F.size(base_names) > 0, 0.5).otherwise(0.0))
    return found.select(
        *own,
        F.size("_w").cast("long").alias("n_words"),
        F.when(F.col("_base").isNull(), 0).otherwise(places).cast("long").alias("n_base"),
        F.array_min(F.transform("_base", lambda b: b["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_base", lambda b: b["at"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_names)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_names, more_names)), ",").alias("labels"),
        score.alias("score"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
