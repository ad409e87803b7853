"""License scans by an exact set-similarity join of text blocks with license templates.

A template is a set of tokens. Its text blocks are windows of ``2 * half`` consecutive words that
begin at every multiple of ``half``, a power of two that is not below the template's words: a passage
as long as the template lies whole in a block, wherever lines break. A block meets a template if it has
at least ``threshold`` of its tokens. The join finds all such pairs:

- template tokens are ordered by their number in the whole corpus, rarest first;
- a block that meets a template has a token of its prefix, the rarest of its tokens that are one more than it may lack,
  so only blocks around prefix tokens are made, and joined by the tokens of both sides' prefixes;
- a block with too few template tokens can't meet it (length), nor can one with too few left behind
  the two places of a common token (position); what is left is compared whole.

Texts are not shuffled; only blocks with a prefix token are, as their template tokens. Templates are a parameter
of at most ``MOST_WORDS`` words, so what is broadcast is bounded.

Base phrases are fixed sequences of words with labels of their own.

Defined cases: a null text is an empty one. Repeated rows get a row each, with equal results (found by doc_id and
the text's hash). Other columns are ignored. Empty tables give empty results; without templates the base phrases count alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm._common import ascii_lower

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose words stand consecutively, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
MOST_WORDS = 50_000

#: Public license notices, with the labels they give.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License."),
    ("agpl", "Licensed under the GNU Affero General Public License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
)


@dataclass(frozen=True)
class Template:
    """need: how many of its tokens a block must have. half: words between the beginnings of its blocks."""

    number: int
    label: str
    tokens: tuple[str, ...]
    need: int
    half: int


def _py_words(text: str) -> list[str]:
    return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c if c > "\x7f" or c.isalnum() else " " for c in text).split(" ") if w]


def prepared(templates: Sequence[tuple[str, str]], threshold: float, least: int = 8) -> list[Template]:
    """Templates as sets; those without words are left out."""
    out = []
    for label, text in templates:
        words = _py_words(text)
        if words:
            tokens = tuple(sorted(set(words)))
            need = max(1, -int(-len(tokens) * round(threshold * 1000) // 1000))
            out.append(Template(len(out), label, tokens, need, max(least, 1 << (len(words) - 1).bit_length())))
    if sum(len(t.tokens) for t in out) > MOST_WORDS:
        raise ValueError(f"templates have more than {MOST_WORDS} words")
    return out


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))


def frequencies(docs: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """How often each of ``tokens`` stands in all texts. The driver gets a number for each."""
    words = docs.select(words_of(F.col("text")).alias("words")).select(F.explode(F.filter("words", lambda w: w.isin(*tokens))).alias("w"))
    return dict.fromkeys(tokens, 0) | {r["w"]: r["count"] for r in words.groupBy("w").count().collect()}


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _around(half: int, tokens: set[str]) -> Column:
    """Blocks of ``2 * half`` words that have one of ``tokens``, of the columns ``words`` and ``at`` (w, i)."""
    last = F.transform(F.filter("at", lambda x: x["w"].isin(*tokens)), lambda x: F.floor(x["i"] / half).cast("int"))
    begins = F.filter(F.array_distinct(F.concat(last, F.transform(last, lambda k: k - 1))), lambda k: k >= 0)
    return F.transform(begins, lambda k: F.struct(F.lit(half).alias("half"), k.alias("block"), F.slice("words", k * half + 1, 2 * half).alias("ws")))


def _candidate_blocks(texts: DataFrame, templates: list[Template], order: dict[str, int]) -> DataFrame:
    """doc_id, th, half, block, b: the template tokens, rarest first, of each block with a prefix token of a template of its size."""
    prefix: dict[int, set[str]] = {}
    for t in templates:
        prefix.setdefault(t.half, set()).update(sorted(t.tokens, key=order.get)[: len(t.tokens) - t.need + 1])
    every = set().union(*prefix.values())
    hits = texts.filter(F.exists("words", lambda w: w.isin(*every)))
    hits = hits.withColumn("at", F.filter(F.transform("words", lambda w, i: F.when(w.isin(*every), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull()))
    blocks = F.concat(*[_around(half, tokens) for half, tokens in sorted(prefix.items())])
    hits = hits.select("doc_id", "th", F.explode(blocks).alias("x")).select("doc_id", "th", "x.*")
    vocabulary = sorted(order, key=order.get)
    return hits.select("doc_id", "th", "half", "block", F.array_intersect(_strings(vocabulary), "ws").alias("b"))  # in the first one's order


def matches(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.9) -> DataFrame:
    """doc_id, th (hash of the text), label, template, first_word, last_word, containment: each block of a text that meets a template, once for equal rows."""
    spark = docs.sparkSession
    ready = prepared(templates, threshold)
    kind = "number int, label string, half int, need int, size int, tokens array<string>, token string, place int"
    if not ready:
        empty = docs.select("doc_id", F.xxhash64("text").alias("th")).filter("false")
        return empty.selectExpr("doc_id", "th", "'' AS label", "0 AS template", "0 AS first_word", "0 AS last_word", "0D AS containment")
    found = frequencies(docs, sorted({w for t in ready for w in t.tokens}))
    order = {w: i for i, (_, w) in enumerate(sorted((n, w) for w, n in found.items()))}
    postings = []
    for t in ready:
        ranked = sorted(t.tokens, key=order.get)
        postings += [(t.number, t.label, t.half, t.need, len(ranked), ranked, w, i) for i, w in enumerate(ranked[: len(ranked) - t.need + 1])]
    postings = F.broadcast(spark.createDataFrame(postings, kind).withColumnRenamed("half", "of_half"))  # templates have MOST_WORDS words at most
    blocks = _candidate_blocks(_texts(docs), ready, order)
    least = min(t.need for t in ready)
    tokens = blocks.filter(F.size("b") >= least).select("doc_id", "th", "half", "block", "b", F.posexplode(F.slice("b", F.lit(1), F.size("b") - least + 1)).alias("j", "w"))
    left = F.least(F.col("size") - F.col("place"), F.size("b") - F.col("j"))
    pairs = tokens.join(postings, (F.col("w") == F.col("token")) & (F.col("half") == F.col("of_half")) & (F.size("b") >= F.col("need")) & (F.col("j") <= F.size("b") - F.col("need")) & (left >= F.col("need")))
    pairs = pairs.withColumn("common", F.size(F.array_intersect("tokens", "b"))).filter("common >= need")
    pairs = pairs.groupBy("doc_id", "th", "label", F.col("number").alias("template"), "half", "block").agg(F.max(F.col("common") / F.col("size")).alias("containment"))
    begin = F.col("block") * F.col("half")
    return pairs.select("doc_id", "th", "label", "template", begin.alias("first_word"), (begin + 2 * F.col("half") - 1).alias("last_word"), "containment")


def _phrase_starts(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand."""
    first, *rest = phrase.split(" ")
    at = F.filter(F.transform(words, lambda w, i: F.when(w == first, i)), lambda i: i.isNotNull())
    if not rest:
        return at

    def follows(i: Column) -> Column:
        here = F.get(words, i + 1) == rest[0]
        for k, w in enumerate(rest[1:], 2):
            here = here & (F.get(words, i + k) == w)
        return F.coalesce(here, F.lit(False))

    return F.filter(at, follows)


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.9, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row for each row of ``docs``.

    score is the greatest containment of a template in a block that meets it, 1 where a base phrase stands, else 0.
    """
    rows = _texts(docs).select("doc_id", "th", F.size("words").cast("long").alias("n_words"), *[_phrase_starts(F.col("words"), p).alias(f"p{i}") for i, (p, _) in enumerate(phrases)])
    starts = F.concat(*[f"p{i}" for i in range(len(phrases))])
    base = F.filter(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "th", "n_words", starts.alias("starts"), F.array_sort(F.array_distinct(base)).alias("base"))
    met = matches(docs, templates, threshold).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))  # labels: a template each at most
    rows = rows.join(met, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", none)))
    return rows.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"), F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def oracle_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = 0.9) -> str:
    """The same rows in DuckDB: every block of every text is compared with every template. doc_ids must be distinct."""
    values = ", ".join(f"({t.number}, '{t.label}', {t.half}, {t.need}, {len(t.tokens)}, '{w}')" for t in prepared(templates, threshold) for w in t.tokens)
    return rf"""
WITH t(nr, label, half, need, size, tok) AS (VALUES {values}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS tok, generate_subscripts(ws, 1) - 1 AS i FROM w),
hit AS (SELECT doc_id, i, tok, nr, label, half, need, size FROM p JOIN t USING (tok)),
blk AS (SELECT *, i // half AS block FROM hit UNION ALL SELECT *, i // half - 1 FROM hit WHERE i >= half),
met AS (SELECT doc_id, label, count(DISTINCT tok)::DOUBLE / size AS c FROM blk GROUP BY doc_id, nr, label, half, need, size, block HAVING count(DISTINCT tok) >= need),
two AS (SELECT doc_id, tok, i, lead(tok) OVER o AS n1, lead(tok, 2) OVER o AS n2 FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
base AS (SELECT doc_id, i, CASE WHEN tok = 'cc' AND n1 = 'by' THEN 'cc-by' WHEN tok = 'general' AND n1 = 'public' AND n2 = 'license' THEN 'gpl' WHEN tok = 'all' AND n1 = 'rights' AND n2 = 'reserved' THEN 'reserved' END AS label FROM two),
b AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS ls FROM base WHERE label IS NOT NULL GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS ls FROM (SELECT doc_id, label FROM met UNION SELECT doc_id, label FROM base WHERE label IS NOT NULL) GROUP BY doc_id),
m AS (SELECT doc_id, max(c) AS c FROM met GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.a::BIGINT AS first_word, b.z::BIGINT AS last_word, coalesce(b.ls, '') AS base_labels, coalesce(al.ls, '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(m.c, 0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN m USING (doc_id)
"""
