"""Operator 1, license scans: a positional index of rare tokens, DataFrame functions only.

A template is a passage of licence text whose leading words are its mandatory
key phrase.  The index holds, for each template, the two words of the key
phrase with the highest inverse document frequency over the scanned corpus,
with their offsets.  In each file the rarest word is looked up, its postings
give (template, start) candidates, the second word must stand at the matching
relative position, and then the whole key phrase is compared word by word.
A phrase contains its own rare words, so no place is lost whatever the
frequencies are; they only decide how few candidates there are.

Everything after the frequency count is local to a row: no shuffle, no skew,
and a text of any length is one row.  The frequency table has at most one row
per distinct key word of the templates.

Defined results: null or empty text has no words and no places (score 0);
repeated rows each give a row; null doc_id is kept; extra columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import ascii_lower, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    passage: str
    key: int = 0          # words of the mandatory key phrase, 0: all
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.passage.split()

    @property
    def key_words(self) -> list[str]:
        return self.words[: self.key or None]


# The phrases of the contract, then well-known licence names and passages.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met", key=13),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", key=1),
    Template("epl", "eclipse public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
                    "fee is hereby granted", key=12),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                    "and associated documentation files", key=11),
    Template("mpl", "mozilla public license"),
    Template("spdx", "spdx license identifier"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def _words(text):
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def word_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Documents that hold each key word; the result is bounded by the templates' words."""
    vocabulary = sorted({w for t in templates for w in t.key_words})
    found = docs.select(F.explode(F.array_intersect(_words(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("word"))
    return dict.fromkeys(vocabulary, 0) | {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def rare_index(templates, frequency: dict[str, int]) -> dict[str, list[tuple[int, int, int, str]]]:
    """Rarest word -> (template, its offset, offset of the second rarest, that word)."""
    index: dict[str, list] = {}
    for k, t in enumerate(templates):
        order = sorted(range(len(t.key_words)), key=lambda i: (frequency[t.key_words[i]], i))
        first, second = order[0], order[min(1, len(order) - 1)]
        index.setdefault(t.key_words[first], []).append((k, first, second, t.key_words[second]))
    return index


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, places, labels, base_labels, score.

    `places`: array of (template, label, start, base, score), every verified place in text order.
    Score of a place: share of its template's passage that stands in the file at
    matching positions; of a file: its best place.
    """
    index = rare_index(templates, word_frequencies(docs, templates))
    literal = lambda words: F.array(*map(F.lit, words))
    posting = lambda p: F.struct(*(F.lit(v).alias(n) for n, v in zip(("t", "off", "off2", "w2"), p, strict=True)))
    postings = F.create_map(*(x for w, ps in sorted(index.items()) for x in (F.lit(w), F.array(*map(posting, ps)))))
    facts = F.array(*(F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), literal(t.words).alias("words"), literal(t.key_words).alias("key")) for t in templates))

    at = lambda words, i: F.get(words, i)
    words, hits, aligned = F.col("words"), F.col("hits"), F.col("aligned")
    rare = F.transform(words, lambda w, i: F.when(w.isin(*sorted(index)), i))
    candidates = F.flatten(F.transform(hits, lambda i: F.transform(
        F.element_at(postings, at(words, i)),
        lambda p: F.struct(p["t"].alias("t"), (i - p["off"]).alias("start"), p["off2"].alias("off2"), p["w2"].alias("w2")))))
    fact = lambda c: F.element_at(facts, c["t"] + 1)
    verified = F.filter(aligned, lambda c: F.slice(words, c["start"] + 1, F.size(fact(c)["key"])) == fact(c)["key"])
    share = lambda c: F.aggregate(
        F.zip_with(F.slice(words, c["start"] + 1, F.size(fact(c)["words"])), fact(c)["words"], lambda a, b: F.when(a == b, 1).otherwise(0)),
        F.lit(0), lambda s, x: s + x) / F.size(fact(c)["words"])
    return (docs.select("doc_id", _words(F.col("text")).alias("words"))
            .withColumn("hits", F.array_compact(rare))
            .withColumn("aligned", F.filter(candidates, lambda c: (c["start"] >= 0) & (at(words, c["start"] + c["off2"]) == c["w2"])))
            .withColumn("places", F.array_sort(F.transform(verified, lambda c: F.struct(
                c["start"].alias("start"), c["t"].alias("template"), fact(c)["label"].alias("label"),
                fact(c)["base"].alias("base"), F.round(share(c), 6).alias("score")))))
            .select("doc_id", F.size("words").cast("long").alias("n_words"), "places",
                    F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))).alias("labels"),
                    F.array_sort(F.array_distinct(F.transform(F.filter("places", lambda p: p["base"]), lambda p: p["label"]))).alias("base_labels"),
                    F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score")))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 1 over the whole of `documents`."""
    base = F.transform(F.filter("places", lambda p: p["base"]), lambda p: p["start"])
    return (scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .withColumn("base", base)
            .select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min("base").cast("long").alias("first_word"), F.array_max("base").cast("long").alias("last_word"),
                    F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score"))


def _oracle(templates=TEMPLATES) -> str:
    """The same by plain word comparison at every position."""
    found = []
    for k, t in enumerate(templates):
        key = " AND ".join(f"w[i+{j}]='{x}'" for j, x in enumerate(t.key_words))
        share = "+".join(f"(CASE WHEN w[i+{j}]='{x}' THEN 1 ELSE 0 END)" for j, x in enumerate(t.words))
        found.append(f"SELECT rid, i - 1 AS start, {k} AS t, '{t.label}' AS label, {str(t.base).lower()} AS base, round(({share}) / {len(t.words)}.0::DOUBLE, 6) AS score FROM hit WHERE {key}")
    firsts = ",".join(f"'{x}'" for x in sorted({t.key_words[0] for t in templates}))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
hit AS (SELECT rid, w, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] IN ({firsts}))) AS i FROM d),
p AS ({" UNION ALL ".join(found)}),
g AS (SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM p GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN g USING (rid)"""


ORACLE = _oracle()
