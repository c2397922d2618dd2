"""Language profiles against a plain count, and on held-out documents."""

import math
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from brightwire.plans import queries
from brightwire.sources import extract, language

TEXTS = [
    ("en", "The cat and the dog sat there, 12 of them."), ("en", "What THEY think is that these things matter"), ("fr", "Le chat et le chien s'étaient assis là."),
    ("fr", "Ce qu'ils pensent, c'est que tout cela compte"), ("de", "Die Katze und der Hund saßen über dort"), ("de", "Was sie denken, ist: Diese Dinge zählen"), (None, "nothing"), ("en", None), ("de", "123 ..."),
]


def test_profiles_equal_a_plain_count(spark):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    want = {}
    for lang, text in TEXTS:
        if lang and text:
            want.setdefault(lang, Counter()).update(language.grams_of(text))
    got = {(r.language, r.gram): r.n for r in language.gram_counts(df, "text", "lang").collect()}
    assert got == {(lang, g): n for lang, c in want.items() for g, n in c.items()}
    profiles = language.fit(df, grams=40)
    for lang, counts in want.items():
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:40]
        assert profiles.known[lang] == pytest.approx({g: math.log(n / sum(counts.values())) for g, n in top})


def test_profiles_detect(spark):
    profiles = language.fit(spark.createDataFrame(TEXTS, "lang string, text string"))
    for text, lang in (("and the things that they think", "en"), ("le chien et le chat comptent", "fr"), ("der Hund und die Dinge dort", "de")):
        found = profiles(text)
        assert found[0] == lang and 0.5 < found[1] <= 1
    assert profiles("12 ...") is None and profiles("") is None and language.fit(spark.createDataFrame([], "lang string, text string"))("some text") is None
    titles = spark.createDataFrame([("AND THE THINGS that they think",), (None,), ("the",), ("1234567890 1234567890",)], "t string")
    assert [r.x for r in titles.select(extract.infer_language(F.col("t"), profiles).alias("x")).collect()] == ["en", None, None, None]


def test_least_texts_are_few_rows_and_the_same_texts(spark):
    """Of 3,000 texts and 20,000 copies of one, some more than those learnt from are grouped and sorted; they are those with the least hashes, copies counted."""
    df = spark.range(23_000).select(F.lit("en").alias("language"), F.when(F.col("id") < 3_000, F.concat(F.lit("text x"), F.conv("id", 10, 26))).otherwise("the same").alias("text"))
    hashed = sorted((r.h, r.text) for r in df.select(F.xxhash64("text").alias("h"), "text").collect())
    same = next(k for k, (_, text) in enumerate(hashed) if text == "the same")
    for texts in (1, 50, same + 100):
        want = Counter()
        for _, text in hashed[:texts]:
            want.update(language.grams_of(text))
        assert language.least_texts(df, texts).count() <= texts + 50
        got = {r.gram: r.n for r in language.gram_counts(df.withColumnRenamed("language", "lang"), "text", "lang", texts).collect()}
        assert {g: n for g, n in got.items() if g.isascii() and not any(c.isdigit() for c in g)} == want


def test_all_texts_are_learnt_from(spark):
    """3,000 different texts of one language, each with a word of its own, beside two of another: none is left out."""
    own = lambda k: "".join(chr(ord("a") + int(d)) for d in f"{k:04d}")
    rows = [("en", f"the x{own(k)} \U0001d49c \u00e9{own(k)}") for k in range(3_000)] + [("fr", "a b c"), ("fr", "z")]
    want = {lang: Counter() for lang in ("en", "fr")}
    for lang, text in rows:
        want[lang].update(language.grams_of(text))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = {(r.language, r.gram): r.n for r in language.gram_counts(df, "text", "lang").collect()}
    assert got == {(lang, g): n for lang, c in want.items() for g, n in c.items()}
    profiles = language.fit(df)
    for lang, c in want.items():
        assert len(c) <= language.GRAMS and profiles.known[lang] == pytest.approx({g: math.log(n / c.total()) for g, n in c.items()})


def test_likelihoods_equal_a_plain_sum():
    known = {"en": {"a": -1.0, "ab": -2.5, " ab": -3.0, "\U0001d49c": -4.0}, "de": {"b": -0.5, "ab ": -1.5, " ": -2.0}}
    known["aa"] = dict(known["en"])  # equal to another one: the first by name is taken
    other = {"en": -7.0, "aa": -7.0, "de": -6.0}
    profiles = language.Profiles(known, other)
    for text in ("ab", "AB ab, b1b", "\U0001d49c\U0001d49c a", "zzz", "b b b b", "abab " * 50):
        sums = {lang: sum(n * own.get(g, other[lang]) for g, n in language.grams_of(text).items()) for lang, own in sorted(known.items())}
        best = max(sums, key=sums.get)
        found = profiles(text)
        assert found[0] == best != "en" and found[1] == pytest.approx(1 / sum(math.exp(x - sums[best]) for x in sums.values()))


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="needs the driver's tables")
def test_held_out_documents(spark):
    rows = queries.queries()["ext_lang_infer"](spark, "/root/testdata/sf0.001").collect()
    held = [r for r in rows if r.held_out and r.language is not None]
    assert len(rows) == 200 and len(held) > 20 and sum(r.language == r.lang for r in held) >= 0.9 * len(held)
