"""License scans by diagonal voting, in DataFrame operations only.

Every word K-gram of a text is joined by its hash to the places of the same
K-gram in the templates. A hit at word i of the text and word j of a template
lies on the diagonal i - j: a copy of the template puts all its hits on one
diagonal, and words put in or left out move the rest to a neighbouring one. So
hits are counted by diagonal, neighbouring diagonals are merged into a span, and
a span is verified by the share of the template's K-grams that it really holds
(the words are compared, not only their hashes). Templates of two labels may
differ in a word; so the same share is asked of the K-grams that tell it from
such a twin. A span right behind a denial ("not released under ...") gives
no label.

Fixed phrases are found beside the templates wherever their words stand
consecutively.

Templates are a table (label, text); it is broadcast, so it must stay within
TEMPLATE_WORDS words, which is checked. Before the join, a place of the text is
passed over if one of its K words does not occur at that place of any template
K-gram: it could not be a hit.

Rows: a null or empty text has no words and no labels; repeated rows get the
same labels; a row is known by its id and a hash of its text. Extra columns are
carried, ``license`` is replaced.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.scratch import Scratch

K = 3
#: Diagonals this close belong to one copy.
NEAR = 2
#: Share of a template's K-grams that a verified span holds.
COVERED = 0.6
TEMPLATE_WORDS = 20_000
DENIALS = ("not", "never", "nor")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and the labels they stand for.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# The statements by which texts usually declare a license.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN, -1), "")


def _template_words(text: str) -> list[str]:
    low = text.translate(str.maketrans(_UPPER, _LOWER))
    return [w for w in re.split(_BETWEEN, low) if w]


def _grams(templates: tuple[tuple[str, str], ...]) -> list[tuple]:
    """(template, label, its K-grams, those that tell it apart, place, K-gram,
    whether this one does) of every template. Where a template of another label
    has the share COVERED of its K-grams, those that the other lacks tell it apart;
    where there is none, all of them do."""
    grams = []
    for _, text in templates:
        words = _template_words(text)
        grams.append([" ".join(words[j:j + K]) for j in range(len(words) - K + 1)])
    out = []
    for t, (label, _) in enumerate(templates):
        mine = grams[t]
        twins = [set(other) for (name, _), other in zip(templates, grams, strict=True)
                 if name != label and sum(g in set(other) for g in mine) >= COVERED * len(mine)]
        tells = [all(not twins or g not in twin for twin in twins) for g in mine]
        out += [(t, label, len(mine), sum(tells), j, g, tells[j]) for j, g in enumerate(mine)]
    if len(out) > TEMPLATE_WORDS:
        raise ValueError(f"templates hold {len(out)} word {K}-grams; at most {TEMPLATE_WORDS} are broadcast")
    return out


def _starts(words: Column, phrases: list[list[str]]) -> Column:
    """Places where one of the phrases stands."""
    def here(i: Column) -> Column:
        tests = [reduce(and_, [F.get(words, i + k) == w for k, w in enumerate(p)]) for p in phrases]
        return F.coalesce(reduce(or_, tests), F.lit(False))

    some = reduce(or_, [F.array_contains(words, p[0]) for p in phrases])
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when((F.size(words) > 0) & some, places).otherwise(F.array().cast("array<int>"))


def _denied(words: Column, i: Column) -> Column:
    """Whether the word before place ``i`` takes back what follows (``isn't`` is
    the words isn and t)."""
    before = lambda k: F.coalesce(F.get(words, i - k), F.lit(""))
    return before(1).isin(*DENIALS) | ((before(1) == "t") & before(2).endswith("n"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
         carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all but the text) plus
    ``license`` = struct(tk, n_words, n_base, first_word, last_word, base_labels
    (array), labels (array, the templates' too), score, spans (label, first and
    last word, share of the template))."""
    spark = df.sparkSession
    work = Scratch(spark)
    keep = [c for c in df.columns if c not in (text_col, "license")] if carry is None else carry
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(id_col).alias("id"),
                    F.xxhash64(text_col).alias("tk"),
                    words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    words = F.col("words")
    grams = _grams(templates)
    at = [sorted({g[5].split(" ")[k] for g in grams}) for k in range(K)]

    def possible(i: Column) -> Column:
        return reduce(and_, [F.get(words, i + k).isin(at[k]) for k in range(K)])

    candidates = F.when(F.size(words) >= K, F.transform(
        F.filter(F.sequence(F.lit(0), F.size(words) - K), possible),
        lambda i: F.struct(i.alias("i"), F.array_join(F.slice(words, i + 1, K), " ").alias("gram"))))
    denials = F.when(F.size(candidates) > 0, F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: _denied(words, i)))
    labels: dict[str, list[list[str]]] = {}
    for phrase, label in phrases:
        labels.setdefault(label, []).append(_template_words(phrase))
    base = {label: _starts(words, parts) for label, parts in labels.items()}
    read = work.stored(src.select("row", "id", "tk", F.size(words).alias("n_words"), candidates.alias("candidates"),
                                  denials.alias("denials"), *[c.alias(f"base_{k}") for k, c in enumerate(base.values())]), "read")
    names = sorted(range(len(base)), key=lambda k: list(base)[k])
    starts = F.concat(*[F.col(f"base_{k}") for k in range(len(base))])
    found = F.filter(F.array(*[F.when(F.size(f"base_{k}") > 0, F.lit(list(base)[k])) for k in names]),
                     lambda x: x.isNotNull())

    table = spark.createDataFrame(
        grams, "t int, label string, total int, own int, j int, template_gram string, tells boolean").withColumn(
        "h", F.xxhash64("template_gram"))
    hits = (read.select("id", "tk", F.explode("candidates").alias("c"))
            .select("id", "tk", "c.i", "c.gram", F.xxhash64("c.gram").alias("h"))
            .join(F.broadcast(table), "h").filter("gram = template_gram"))
    diagonals = (hits.groupBy("id", "tk", "t", "label", "total", "own", (F.col("i") - F.col("j")).alias("d"))
                 .agg(F.collect_set("j").alias("places"), F.collect_set(F.when(F.col("tells"), F.col("j"))).alias("telling"),
                      F.min("i").alias("first"), F.max("i").alias("last")))
    # a document's diagonals of one template, in order: a gap begins a new span
    by = "partition by id, tk, t order by d"
    gapped = diagonals.withColumn("new", F.expr(f"if(d - lag(d) over ({by}) <= {NEAR}, 0, 1)"))
    different = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))
    spans = (gapped.withColumn("span", F.expr(f"sum(new) over ({by})"))
             .groupBy("id", "tk", "t", "label", "total", "own", "span")
             .agg(different("places").alias("held"), different("telling").alias("told"),
                  F.min("d").alias("begin"), F.min("first").alias("first"),
                  (F.max("last") + K - 1).alias("last"))
             .withColumn("share", F.col("held") / F.col("total"))
             .filter((F.col("share") >= COVERED) & (F.col("told") >= COVERED * F.col("own"))))
    verified = (spans.groupBy(F.col("id").alias("span_id"), F.col("tk").alias("span_tk"))
                .agg(F.array_sort(F.collect_list(F.struct("first", "last", "label", "share", "begin"))).alias("spans")))
    joined = read.join(verified, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("tk") == F.col("span_tk")), "left")
    # where the template would begin, so that its first words need not be among the hits
    stated = F.filter("spans", lambda s: ~F.coalesce(F.array_contains("denials", s["begin"].cast("int")), F.lit(False)))
    joined = joined.withColumn("spans", F.transform(stated, lambda s: s.dropFields("begin")))
    joined = joined.withColumns({"found_labels": F.transform("spans", lambda s: s["label"]),
                                 "share": F.array_max(F.transform("spans", lambda s: s["share"]))})
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_union(found, F.coalesce("found_labels", none)))
    score = F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return joined.select("row.*", F.struct(
        "tk", F.col("n_words").cast("long").alias("n_words"), F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        found.alias("base_labels"), every.alias("labels"), score.alias("score"), "spans").alias("license"))
