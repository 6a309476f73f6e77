"""License scan with a positional rare-token index (operator 4), in DataFrame functions only.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. The
license words of the templates are located in every file; their document
frequency over all files gives an IDF. The index has postings (template,
position) of the INDEXED highest-IDF words of each template that any file holds. All words of a file
that have postings, its highest-IDF license words, are looked up, wherever they
stand and however many they are. The relative position (file position minus
template position) names the place where a template may stand; postings are
intersected there: at least AGREEING of them must name the same place (all, of a
template with fewer). At such a place the mandatory key phrase must stand word
by word and the words that stand must hold LEAST_SHARE of the template's IDF;
then the file gets the template's label, so a phrase in other prose gives none.
The score is the largest share of a place where the phrase stands.

Defined results: a null or wordless text has n_words 0, no label and score 0;
very long texts are scanned whole; of words with equal IDF the index takes the
first by alphabet, then by position; repeated rows and repeated ids each get a
row and count as files of their own; a null doc_id is kept; an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, text_of

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and labels of the base scan.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, template, mandatory key phrase in it); notices as their public licenses word them.
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "hereby granted"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     "general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "copy modify"),
    ("cc", "licensed under a creative commons attribution license", "creative commons attribution"),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered software released"),
]
# Words too common to be license words; no key phrase holds one.
STOP = set("a and any are as by for free in into is it of or out the this to under use with without work 0 2 3".split())
INDEXED = 4            # postings of a template, its words of the highest IDF
AGREEING = 2           # postings that must name the same place
LEAST_SHARE = 0.5      # of a template's IDF that must stand there (to nine places)


def _vocabulary() -> list[str]:
    return sorted({w for _, t, _ in TEMPLATES for w in t.split() if w not in STOP})


def words_of(text: Column) -> Column:
    """Words of a text, A-Z not yet lower-cased."""
    return F.array_remove(F.split(text, SEPARATOR), "")


def license_words(words: Column, vocabulary: list[str]) -> Column:
    """array<(i, w)>: the license words among the words, in order; w lower-cased (ASCII words only)."""
    def mark(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return F.when((F.octet_length(w) == F.length(w)) & low.isin(vocabulary), F.struct(i.alias("i"), low.alias("w")))
    return F.filter(F.transform(words, mark), lambda x: x.isNotNull())


def base_hits(occ: Column) -> Column:
    """array<(start, label)> of the places where a base phrase's words stand consecutively."""
    def at(o: Column, k: Column) -> Column:
        out = None
        for phrase, label in BASE.items():
            parts = phrase.split()
            ok = o["w"] == parts[-1]
            for back, w in enumerate(reversed(parts[:-1]), 1):
                before = F.get(occ, k - back)
                ok = ok & F.coalesce((before["w"] == w) & (before["i"] == o["i"] - back), F.lit(False))
            hit = F.struct((o["i"] - len(parts) + 1).alias("start"), F.lit(label).alias("label"))
            out = F.when(ok, hit) if out is None else out.when(ok, hit)
        return out
    return F.filter(F.transform(occ, at), lambda x: x.isNotNull())


def _template_words(spark: SparkSession, idf: dict[str, float], found: set[str]) -> DataFrame:
    """(t, label, pos, w, idf, key, indexed, need): the license words of every template; key marks those of the mandatory phrase,
    indexed the postings, need the number of them that must agree."""
    vocabulary, rows = set(_vocabulary()), []
    for t, (label, text, phrase) in enumerate(TEMPLATES):
        words, key = text.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        own = [(pos, w) for pos, w in enumerate(words) if w in vocabulary]
        rare = {pos for pos, _ in sorted((x for x in own if x[1] in found), key=lambda x: (-idf[x[1]], x[1], x[0]))[:INDEXED]}
        rows += [(t, label, pos, w, idf[w], at <= pos < at + len(key), pos in rare, min(AGREEING, len(rare))) for pos, w in own]
    return spark.createDataFrame(rows, "t int, label string, pos int, w string, idf double, key boolean, indexed boolean, need int")


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``."""
    vocabulary = _vocabulary()
    words = docs.select("doc_id", words_of(text_of()).alias("words"))
    found = stored(spark, words.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.size("words").cast("long").alias("n_words"),
        license_words(F.col("words"), vocabulary).alias("occ")), "license-words")
    each = found.select("rid", F.inline("occ"))
    n_docs = found.count()
    counts = each.select("rid", "w").distinct().groupBy("w").agg(F.count("*").alias("n"))
    df = {r["w"]: r["n"] for r in counts.collect()}             # one row a template word
    idf = {w: log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-3 for w in vocabulary}
    index = _template_words(spark, idf, set(df))

    postings = index.filter("indexed").select("t", "pos", "w", "need")
    places = (each.join(F.broadcast(postings), "w")                                     # the index has a fixed size
              .groupBy("rid", "t", (F.col("i") - F.col("pos")).alias("place"), "need").agg(F.count("*").alias("agree"))
              .filter("agree >= need").select("rid", "t", "place"))
    share = (places.join(F.broadcast(index), "t").withColumn("i", F.col("place") + F.col("pos"))
             .join(each.withColumn("hit", F.lit(1)), ["rid", "i", "w"], "left")
             .groupBy("rid", "t", "place", "label")
             .agg(F.min(F.when(F.col("key"), F.coalesce("hit", F.lit(0)))).alias("whole"),
                  (F.sum(F.when(F.col("hit") == 1, F.col("idf")).otherwise(0.0)) / F.sum("idf")).alias("share"))
             .filter("whole = 1").groupBy("rid")
             .agg(F.collect_set(F.when(F.col("share") >= LEAST_SHARE - 1e-9, F.col("label"))).alias("more"), F.max("share").alias("share")))
    none = F.array().cast("array<string>")
    return (found.withColumn("base", base_hits(F.col("occ"))).join(share, "rid", "left")
            .select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(F.col("base.start")).cast("long").alias("first_word"),
                    F.array_max(F.col("base.start")).cast("long").alias("last_word"),
                    F.array_join(F.array_sort(F.array_distinct(F.col("base.label"))), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union(F.col("base.label"), F.coalesce("more", none))), ",").alias("labels"),
                    F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0))).alias("score")))
