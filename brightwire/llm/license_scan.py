"""License scans by diagonal voting. DataFrame functions only.

1. Every text is cut into words; every run of ``GRAM`` words is hashed within the scan's stage and joined to the positions of
   that hash in the templates. The run's words are compared with the template's there, so a hit is a true one.
2. A hit of word ``pos`` of a text with word ``at`` of a template votes for the diagonal ``pos - at``; hits are grouped by
   diagonal, so a notice is one row however long it is.
3. Neighbouring diagonals, up to ``DRIFT`` words apart, are one span: words that were put in or left out shift the rest of a
   notice by so many. A span is verified by the share of the template's words that hits on its diagonals cover.

A phrase whose words all stand consecutively covers itself on one diagonal, so base places come out of the same votes. The
words of a text never leave the scan's stage: what is shuffled are hits. Rows of documents are told apart by doc_id and
digest of the text, not by a row number, so a scan that is repeated after the loss of an executor finds the same rows.

Defined results: null and empty texts have no words and no labels; rows with equal doc_ids and texts have equal results,
each its own row; null doc_ids are documents like others; texts shorter than a phrase have none; overlapping places all
count; an empty table gives no rows; other columns are ignored, whatever their names. A template needs ``GRAM`` words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightwire.llm.common import cut, id_text

GRAM, DRIFT = 3, 4
#: Least share of a template's words that a span covers.
COVERED = 0.8
#: Tables of template positions (100 bytes each) and of documents with hits (200 bytes each) are broadcast up to this number; beyond it they are joined by a shuffle.
BROADCAST_GRAMS, BROADCAST_DOCS = 100_000, 250_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases that count as base places, with their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Notices and names of licenses, by which further labels are found.
NOTICES = (
    ("mit", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache-2", "apache license 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "mozilla public license v 2 0"),
    ("mpl-2", "subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "cc by sa"),
)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def template_rows(base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> list[dict]:
    """One entry for each position of each template's word runs."""
    out = []
    for t, (label, phrase) in enumerate([*base, *notices]):
        own = re.findall(WORD, phrase.lower())
        if len(own) < GRAM:
            raise ValueError(f"a template has fewer than {GRAM} words: {phrase}")
        out += [{"template": t, "label": label, "base": t < len(base), "size": len(own), "at": k, "gram": own[k : k + GRAM]} for k in range(len(own) - GRAM + 1)]
    return out


def template_grams(spark: SparkSession, base: Sequence[tuple[str, str]] = BASE, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    rows = template_rows(base, notices)
    kind = "array<struct<template: int, label: string, base: boolean, size: int, at: int, gram: array<string>>>"
    grams = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    grams = grams.withColumn("key", F.xxhash64(*(F.get("gram", F.lit(k)) for k in range(GRAM))))
    return F.broadcast(grams) if len(rows) <= BROADCAST_GRAMS else grams


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).withColumn("digest", F.md5("text"))


def diagonals(docs: DataFrame, grams: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, template, label, base, size, diagonal, ats): the template positions hit on each diagonal."""
    rows = _keyed(docs, id_col, text_col).select("doc_id", "digest", words(F.col("text")).alias("words"))
    rows = rows.select("*", F.posexplode_outer("words").alias("pos", "word")).filter(F.col("pos") <= F.size("words") - GRAM)
    own = [F.get("words", F.col("pos") + k) for k in range(GRAM)]
    same = [own[k] == F.get("gram", F.lit(k)) for k in range(GRAM)]
    met = rows.join(grams, F.xxhash64(*own) == F.col("key")).filter(same[0] & same[1] & same[2])
    return met.groupBy("doc_id", "digest", "template", "label", "base", "size", (F.col("pos") - F.col("at")).cast("long").alias("diagonal")).agg(F.collect_set("at").alias("ats"))


def spans(docs: DataFrame, grams: DataFrame, drift: int = DRIFT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every diagonal with its neighbours merged: first and last word of the span, covered share of the template, whether it is the best of its neighbours.

    ``place``: the template's words all stand consecutively, from word ``diagonal``.
    """
    found = diagonals(docs, grams, id_col, text_col)
    key = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal").rangeBetween(-drift, drift)
    near = found.withColumn("near", F.collect_list(F.struct("diagonal", "ats")).over(key))
    every = lambda pick: F.flatten(F.transform("near", pick))
    covered = F.array_distinct(every(lambda d: F.flatten(F.transform(d["ats"], lambda a: F.sequence(a, a + GRAM - 1)))))
    at = every(lambda d: F.transform(d["ats"], lambda a: d["diagonal"] + a))
    near = near.withColumns(
        {
            "coverage": F.size(covered) / F.col("size"),
            "first": F.array_min(at),
            "last": F.array_max(at) + GRAM - 1,
            "votes": F.size(every(lambda d: d["ats"])),
            "place": F.size("ats") == F.col("size") - GRAM + 1,
        }
    ).drop("near", "ats")
    rank = F.struct("coverage", (-F.col("diagonal")).alias("d"))
    return near.withColumn("best", F.max(rank).over(key) == rank)


def scan(docs: DataFrame, grams: DataFrame, covered: float = COVERED, drift: int = DRIFT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best covered share)."""
    base = F.col("base") & F.col("place")
    held = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    found = spans(docs, grams, drift, id_col, text_col).groupBy("doc_id", "digest").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).alias("last_word"),
        held(base).alias("base_labels"),
        held(base | (F.col("coverage") >= covered)).alias("labels"),
        F.max("coverage").alias("score"),
    )
    found = cut(found.withColumnRenamed("doc_id", "own_id").withColumnRenamed("digest", "own_digest"), "license-spans")
    found = F.broadcast(found) if found.count() <= BROADCAST_DOCS else found
    rows = _keyed(docs, id_col, text_col).select("doc_id", "digest", F.regexp_count(F.translate("text", _UPPER, _LOWER), F.lit(WORD)).cast("long").alias("n_words"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")), "left")
    none = {"n_base": F.lit(0).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    rows = rows.withColumns({c: F.coalesce(c, v) for c, v in none.items()})
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
