"""License scan: phrases, and an exact set-similarity join of text blocks with templates.

A block is a line. A template and a block are sets of words; they match if the
block holds at least ``CONTAINMENT`` of the template's words. Words are ordered
by how many blocks of the whole corpus have them, rarest first. A matching block
must have one of the template's first ``m - need + 1`` words (prefix), at least
``need`` words (length), and enough words left after the first shared one
(position); what passes these is counted in full. Words of no template cannot
add to an overlap and are left out of the blocks' sets.

The template table is fixed and small, so it is sent to every task; counts are
added up before the shuffle. Built-in functions only.

Defined results: NULL and empty texts have no words, no blocks and no labels;
rows repeat as they come; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import whole

CONTAINMENT = 0.9

# Phrases that alone decide a label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public license notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "gnu general public license as published by the free software foundation either version 3 of the license or "
     "at your option any later version"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

# Everything below 128 but digits and letters; the pattern for words also takes A-Z away, once lower-cased.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
KEY = ("doc_id", "text_key")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(docs: DataFrame, phrases: dict[str, str] = PHRASES, text: str = "text") -> DataFrame:
    """doc_id, text_key, n_words, n_base, first_word, last_word and base_labels (array) of each row."""
    plain = F.trim(F.regexp_replace(whole(text), SEPARATORS, " "))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.concat(F.lit(" "), plain, F.lit(" ")).alias("t"))
    # (?i) covers A-Z only.
    any_phrase = "(?i)(?<= )(?:" + "|".join(phrases) + ")(?= )"
    rows = rows.withColumn("at", F.regexp_instr("t", F.lit(any_phrase)))
    some = F.col("at") > 0
    counts = [F.when(some, F.regexp_count("t", F.lit(f"(?i)(?<= ){p}(?= )"))).otherwise(0) for p in phrases]
    rows = rows.withColumn("counts", F.array(*counts))
    before_last = F.regexp_extract("t", "(?is)^(.*) (?:" + "|".join(phrases) + ")(?= )", 1)
    labels = F.array(*[F.when(F.get("counts", i) > 0, label) for i, label in enumerate(phrases.values())])
    return rows.select(
        *KEY,
        F.when(F.length("t") > 2, _spaces(F.col("t")) - 1).otherwise(0).cast("long").alias("n_words"),
        F.aggregate("counts", F.lit(0), lambda a, x: a + x).cast("long").alias("n_base"),
        F.when(some, _spaces(F.substr("t", F.lit(1), F.col("at") - 1)) - 1).cast("long").alias("first_word"),
        F.when(some, _spaces(before_last)).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base_labels"),
    )


def _blocks(docs: DataFrame, vocabulary: list[str], text: str) -> DataFrame:
    """One row a line that has a word of the vocabulary: its words from it, in the vocabulary's order."""
    lines = F.split(whole(text), "\n", -1)
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.posexplode(lines).alias("block", "line"))
    words = F.split(F.lower("line"), SEPARATORS, -1)
    rows = rows.select(*KEY, "block", F.array_intersect(F.lit(vocabulary), words).alias("words"))
    return rows.where(F.size("words") > 0)


def similarity_join(
    docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, text: str = "text"
) -> DataFrame:
    """doc_id, text_key, block (line number), template (its number), label and share of every match."""
    spark = docs.sparkSession
    sets = [sorted(set(words.split())) for _, words in templates]
    vocabulary = sorted({word for words in sets for word in words})
    counted = _blocks(docs, vocabulary, text).select(F.explode("words").alias("word")).groupBy("word").count()
    # At most one row for each template word.
    counts = {row["word"]: row["count"] for row in counted.collect()}
    order = sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))
    rank = {word: place for place, word in enumerate(order)}

    needs = [math.ceil(containment * len(words) - 1e-9) for words in sets]
    prefixes, whole_sets = [], []
    for number, (words, need) in enumerate(zip(sets, needs)):
        ranked = sorted(words, key=rank.get)
        whole_sets.append((number, templates[number][0], ranked))
        for place in range(len(ranked) - need + 1):
            prefixes.append((ranked[place], number, place, len(ranked), need))
    index = spark.createDataFrame(prefixes, "word string, template int, place int, length int, need int")
    full = spark.createDataFrame(whole_sets, "template int, label string, template_words array<string>")

    rows = _blocks(docs, order, text).where(F.size("words") >= min(needs))
    rows = rows.where(F.arrays_overlap("words", F.lit(sorted({row[0] for row in prefixes}))))
    seen = rows.select(*KEY, "block", "words", F.posexplode(F.slice("words", 1, F.size("words") - min(needs) + 1)).alias("at", "word"))
    near = seen.join(F.broadcast(index), "word").where(
        (F.size("words") >= F.col("need"))
        & (F.least(F.col("length") - F.col("place"), F.size("words") - F.col("at")) >= F.col("need"))
    )
    found = near.join(F.broadcast(full), "template")
    shared = F.size(F.array_intersect("words", "template_words"))
    found = found.where(shared >= F.col("need")).withColumn("share", shared / F.col("length"))
    return found.select(*KEY, "block", "template", "label", "share").distinct()


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row a document: the phrases' columns, labels (array, the join's too) and score.

    ``score`` is 1 where a phrase stands, else the largest share of a template a block holds.
    """
    base = phrase_places(docs, text=text)
    found = similarity_join(docs, text=text).groupBy(*KEY).agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share")
    )
    found = found.withColumnsRenamed({key: f"_{key}" for key in KEY})
    same = base["doc_id"].eqNullSafe(found["_doc_id"]) & (base["text_key"] == found["_text_key"])
    rows = base.join(found, same, "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", none)))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select(*base.columns, labels.alias("labels"), score.alias("score"))


def oracle(templates=TEMPLATES, phrases: dict[str, str] = PHRASES, containment: float = CONTAINMENT) -> str:
    """The query op2 in DuckDB's SQL: every line against every template."""
    rows = ", ".join(f"('{label}', list_distinct(string_split('{words}', ' ')))" for label, words in templates)
    named = ", ".join(f"('{phrase}', '{label}', {len(phrase.split())})" for phrase, label in phrases.items())
    split = f"list_filter(string_split_regex(%s, '{SEPARATORS}'), lambda w: w <> '')"
    return f"""
WITH t(label, words) AS (VALUES {rows}),
p(phrase, label, n) AS (VALUES {named}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_transform({split % "coalesce(text, '')"}, lambda w: lower(w)) AS w FROM documents
), places AS (
  SELECT r, label, unnest(list_filter(range(len(w)), lambda i: array_to_string(w[i + 1:i + n], ' ') = phrase)) AS place
  FROM d, p
), base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), sets AS (
  SELECT r, list_distinct({split % "lower(line)"}) AS words FROM lines
), found AS (
  SELECT r, label, len(list_intersect(t.words, sets.words)) / len(t.words) AS share FROM sets, t
  WHERE len(list_intersect(t.words, sets.words)) >= ceil({containment} * len(t.words) - 1e-9)
), method AS (
  SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN method USING (r)
"""
