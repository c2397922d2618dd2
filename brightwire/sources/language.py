"""The language of a text by profiles of character n-grams, learnt from texts whose language is known.

``fit`` counts the n-grams of all labelled texts in Spark and keeps each language's most frequent ones, so a profile has a
bounded size whatever it is learnt from. A ``Profiles`` is a detector for ``extract.infer_language``: it
gives the language under which the text's n-grams are likeliest, and how sure that is.

Defined results: case, digits and punctuation don't count; a text without letters, and profiles of no language, give None;
texts and languages that are null aren't learnt from; equal likelihoods go to the first language by name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lengths of the n-grams.
SIZES = (1, 2, 3)
#: Most n-grams that a profile keeps; their shares are of all n-grams.
GRAMS = 3_000
#: Bits of the hash by which texts are counted before any is moved.
SLOT_BITS = 12


def _plain(text: str) -> str:
    return f" {' '.join(re.findall(r'[^\W\d_]+', text.lower()))} "


def grams_of(text: str) -> Counter:
    """The n-grams of a text, as ``fit`` counts them."""
    plain = _plain(text)
    return Counter(plain[i : i + n] for n in SIZES for i in range(len(plain) - n + 1)) if plain.strip() else Counter()


def _keys(plain: str) -> np.ndarray:
    """A number for each n-gram at each place: its code points, 21 bits each, the first one lowest."""
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.concatenate([sum(codes[k : len(codes) - n + 1 + k] << (21 * k) for k in range(n)) for n in SIZES])


@dataclass(frozen=True)
class Profiles:
    """For each language the logarithms of its n-grams' shares, and that of a share which stands for all others."""

    known: dict[str, dict[str, float]]
    other: dict[str, float]

    @cached_property
    def _table(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages by name, all profiles' n-grams as ascending numbers, and a row of logarithms for each; the last row is that of all others."""
        langs = sorted(self.known)
        grams = sorted((sum(ord(c) << (21 * k) for k, c in enumerate(g)), g) for g in set().union(*self.known.values()))
        rows = [[self.known[lang].get(g, self.other[lang]) for lang in langs] for _, g in grams]
        return langs, np.array([key for key, _ in grams], dtype=np.int64), np.array([*rows, [self.other[lang] for lang in langs]])

    def __call__(self, text: str) -> tuple[str, float] | None:
        plain = _plain(text)
        if not plain.strip() or not self.known:
            return None
        langs, grams, logs = self._table
        found, times = np.unique(_keys(plain), return_counts=True)
        at = np.searchsorted(grams, found)
        at[grams[np.minimum(at, len(grams) - 1)] != found] = len(grams)
        sums = (logs[at] * times[:, None]).sum(axis=0)  # each language's in the same order, so that equal ones stay equal
        best = int(sums.argmax())
        return langs[best], float(1 / np.exp(np.maximum(sums - sums[best], -700)).sum())


def letters(text: Column) -> Column:
    """Words of letters in lower case, with a space before, between and behind them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def pieces(t: Column) -> Column:
    """The words of ``letters``, and what lies between them: each space with its two neighbours, the last one alone."""
    words = F.split(F.trim(t), " ")
    between = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda w, x: F.coalesce(F.concat(F.substring(w, -1, 1), F.lit(" "), F.substring(x, 1, 1)), F.lit(" ")))
    return F.concat(words, between)


def piece_grams(piece: Column, chars: Column) -> Column:
    """Of a word, whose ``chars`` have a space at both ends, the n-grams that hold a letter of it or are its first space; of others the piece itself."""

    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(chars) - max(n, 2)), lambda i: F.concat(*(F.get(chars, i + k) for k in range(n))))

    return F.when(F.contains(piece, F.lit(" ")), F.array(piece)).otherwise(F.concat(*map(of, SIZES)))


def least_texts(rows: DataFrame, texts: int) -> DataFrame:
    """(language, hash, copies, text) that hold each language's ``texts`` least hashes: each text once, with the number of its copies.

    Rows are counted by language and slot, the hash's first bits; up to the slot of a language's last text there are some
    ``texts`` texts and a slot's worth, so only these are grouped and sorted, whatever the size of the table is.
    """
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("slot", F.shiftright("hash", 64 - SLOT_BITS))
    counts = rows.groupBy("language", "slot").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("language").orderBy("slot"))  # 2 ** SLOT_BITS rows a language at most
    last = counts.withColumn("before", upto - F.col("n")).filter(F.col("before") < texts).groupBy("language").agg(F.max("slot").alias("last"))
    return rows.join(last, "language").filter("slot <= last").groupBy("language", "hash").agg(F.count("*").alias("copies"), F.first("text").alias("text"))


def gram_counts(rows: DataFrame, text: str, language: str, texts: int | None = None) -> DataFrame:
    """(language, gram, n) over all texts, whole; with ``texts``, over so many of each language, those with the least hashes.

    Words are counted first, so that only different ones are taken apart.
    """
    rows = rows.select(F.col(language).alias("language"), F.col(text).alias("text")).filter("language is not null and text is not null")
    if texts is None:
        rows = rows.withColumn("times", F.lit(1).cast("bigint"))
    else:
        before = F.sum("copies").over(Window.partitionBy("language").orderBy("hash")) - F.col("copies")
        rows = least_texts(rows, texts).withColumn("times", F.least("copies", F.lit(texts) - before)).filter("times > 0")
    rows = rows.select("language", "times", letters(F.col("text")).alias("t")).filter("trim(t) <> ''")
    rows = rows.select("language", "times", F.explode(pieces(F.col("t"))).alias("piece")).groupBy("language", "piece").agg(F.sum("times").alias("times"))
    rows = rows.withColumn("chars", F.split(F.concat(F.lit(" "), "piece", F.lit(" ")), ""))
    return rows.select("language", "times", F.explode(piece_grams(F.col("piece"), F.col("chars"))).alias("gram")).groupBy("language", "gram").agg(F.sum("times").alias("n"))


def fit(rows: DataFrame, text: str = "text", language: str = "lang", texts: int | None = None, grams: int = GRAMS) -> Profiles:
    counts = gram_counts(rows, text, language, texts)
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= grams).join(F.broadcast(totals), "language")
    known: dict[str, dict[str, float]] = {}
    other: dict[str, float] = {}
    for r in top.collect():  # ``grams`` rows a language
        known.setdefault(r.language, {})[r.gram] = math.log(r.n / r.total)
        other[r.language] = math.log(0.5 / r.total)
    return Profiles(known, other)
