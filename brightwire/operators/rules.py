"""The guardrail vocabulary, and the hits of its terms in titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwire.functions.text import spaced, tokens

# The vocabulary: term, rule class, match scope, note.
VOCABULARY = (
    ("obit", "deny_hard", "token", "Obituary shorthand"),
    ("obituary", "deny_hard", "token", "Explicit obituary term"),
    ("death", "deny_hard", "token", "Death-related title term"),
    ("dead", "deny_hard", "token", "Death-related title term"),
    ("dies", "deny_hard", "token", "Death-related title term"),
    ("killed", "deny_hard", "token", "Fatal violence term"),
    ("kill", "deny_hard", "token", "Fatal violence term"),
    ("murder", "deny_hard", "token", "Severe crime term"),
    ("murdered", "deny_hard", "token", "Severe crime term"),
    ("suicide", "deny_hard", "token", "Self-harm term"),
    ("rape", "deny_hard", "token", "Severe crime term"),
    ("terrorist", "deny_hard", "token", "Severe violence term"),
    ("terrorism", "deny_hard", "token", "Severe violence term"),
    ("bombing", "deny_hard", "token", "Severe violence term"),
    ("crash", "deny_hard", "token", "Severe accident term"),
    ("crashed", "deny_hard", "token", "Severe accident term"),
    ("stabbing", "deny_hard", "token", "Severe violence term"),
    ("stabbed", "deny_hard", "token", "Severe violence term"),
    ("attack", "deny_soft", "token", "Risky harm/conflict term"),
    ("attacked", "deny_soft", "token", "Risky harm/conflict term"),
    ("blast", "deny_soft", "token", "Risky incident term"),
    ("blasts", "deny_soft", "token", "Risky incident term"),
    ("bomb", "deny_soft", "token", "Risky incident term"),
    ("bombs", "deny_soft", "token", "Risky incident term"),
    ("explosion", "deny_soft", "token", "Risky incident term"),
    ("explosions", "deny_soft", "token", "Risky incident term"),
    ("war", "deny_soft", "token", "Conflict term"),
    ("warfare", "deny_soft", "token", "Conflict term"),
    ("conflict", "deny_soft", "token", "Conflict term"),
    ("clashes", "deny_soft", "token", "Conflict term"),
    ("riot", "deny_soft", "token", "Civil unrest term"),
    ("riots", "deny_soft", "token", "Civil unrest term"),
    ("unrest", "deny_soft", "token", "Civil unrest term"),
    ("injured", "deny_soft", "token", "Injury term"),
    ("injury", "deny_soft", "token", "Injury term"),
    ("injuries", "deny_soft", "token", "Injury term"),
    ("wounded", "deny_soft", "token", "Injury term"),
    ("hostage", "deny_soft", "token", "Crisis term"),
    ("arrest", "deny_soft", "token", "Crime or investigation term"),
    ("arrested", "deny_soft", "token", "Crime or investigation term"),
    ("probe", "deny_soft", "token", "Investigation term"),
    ("scandal", "deny_soft", "token", "Negative topic term"),
    ("fraud", "deny_soft", "token", "Negative topic term"),
    ("scam", "deny_soft", "token", "Negative topic term"),
    ("corruption", "deny_soft", "token", "Negative topic term"),
    ("fire", "deny_soft", "token", "Disaster term"),
    ("wildfire", "deny_soft", "token", "Disaster term"),
    ("flood", "deny_soft", "token", "Disaster term"),
    ("earthquake", "deny_soft", "token", "Disaster term"),
    ("hurricane", "deny_soft", "token", "Disaster term"),
    ("cyclone", "deny_soft", "token", "Disaster term"),
    ("tornado", "deny_soft", "token", "Disaster term"),
    ("disaster", "deny_soft", "token", "Disaster term"),
    ("outbreak", "deny_soft", "token", "Health crisis term"),
    ("epidemic", "deny_soft", "token", "Health crisis term"),
    ("pandemic", "deny_soft", "token", "Health crisis term"),
    ("robbery", "deny_soft", "token", "Crime term"),
    ("theft", "deny_soft", "token", "Crime term"),
    ("shooting", "deny_soft", "token", "Violence term"),
    ("shootings", "deny_soft", "token", "Violence term"),
    ("gunfire", "deny_soft", "token", "Violence term"),
    ("shelling", "deny_soft", "token", "Conflict term"),
    ("missile", "deny_soft", "token", "Conflict term"),
    ("missiles", "deny_soft", "token", "Conflict term"),
    ("evacuation", "deny_soft", "token", "Disruption term"),
    ("evacuate", "deny_soft", "token", "Disruption term"),
    ("toxic", "deny_soft", "token", "Hazard term"),
    ("poisoning", "deny_soft", "token", "Hazard term"),
    ("panic", "deny_soft", "token", "Crisis term"),
    ("rescue", "allow", "token", "Positive recovery term"),
    ("rescued", "allow", "token", "Positive recovery term"),
    ("recovery", "allow", "token", "Positive recovery term"),
    ("recovered", "allow", "token", "Positive recovery term"),
    ("relief", "allow", "token", "Positive aid term"),
    ("aid", "allow", "token", "Positive aid term"),
    ("charity", "allow", "token", "Positive civic term"),
    ("donation", "allow", "token", "Positive civic term"),
    ("donate", "allow", "token", "Positive civic term"),
    ("fundraiser", "allow", "token", "Positive civic term"),
    ("scholarship", "allow", "token", "Positive opportunity term"),
    ("award", "allow", "token", "Positive recognition term"),
    ("awarded", "allow", "token", "Positive recognition term"),
    ("breakthrough", "allow", "token", "Positive progress term"),
    ("heal", "allow", "token", "Positive health term"),
    ("healing", "allow", "token", "Positive health term"),
    ("cure", "allow", "token", "Positive health term"),
    ("cured", "allow", "token", "Positive health term"),
    ("save", "allow", "token", "Positive recovery term"),
    ("saved", "allow", "token", "Positive recovery term"),
    ("peace", "allow", "token", "Positive diplomacy term"),
    ("ceasefire", "allow", "token", "Positive diplomacy term"),
    ("community", "allow", "token", "Positive civic term"),
    ("volunteer", "allow", "token", "Positive civic term"),
    ("support", "allow", "token", "Positive civic term"),
    ("celebration", "allow", "token", "Positive civic term"),
    ("win", "allow", "token", "Positive achievement term"),
    ("wins", "allow", "token", "Positive achievement term"),
    ("victory", "allow", "token", "Positive achievement term"),
    ("reunion", "allow", "token", "Positive social term"),
    ("free", "allow", "token", "Positive accessibility term"),
    ("brings community together", "allow", "phrase", "Positive community phrase"),
    ("free family fun", "allow", "phrase", "Positive community phrase"),
    ("wins award", "allow", "phrase", "Positive recognition phrase"),
    ("peace talks", "allow", "phrase", "Positive diplomacy phrase"),
    ("relief effort", "allow", "phrase", "Positive civic phrase"),
    ("recovery effort", "allow", "phrase", "Positive civic phrase"),
    ("charity event", "allow", "phrase", "Positive civic phrase"),
    ("fundraiser for", "allow", "phrase", "Positive civic phrase"),
    ("rescued from", "allow", "phrase", "Positive recovery phrase"),
    ("saved by", "allow", "phrase", "Positive recovery phrase"),
)
TERM_SCHEMA = "term string, rule_class string, match_scope string, is_active boolean, notes string"
CLASSES = {"allow": "allow", "deny_soft": "soft_deny", "deny_hard": "hard_deny"}
#: Terms up to this number go into the plan as literals; a larger vocabulary is joined.
MAX_LITERALS = 2_000
#: Characters of the runs by which phrases of a larger vocabulary are found.
GRAM = 4


def vocabulary_rows() -> list[tuple]:
    return [(term, kind, scope, True, note) for term, kind, scope, note in VOCABULARY]


def guardrail_terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(vocabulary_rows(), TERM_SCHEMA)


def active_terms(terms: DataFrame) -> DataFrame:
    return terms.filter("is_active").select("term", "rule_class", "match_scope")


def term_use(terms: DataFrame, hits: DataFrame) -> DataFrame:
    """``terms`` with ``title_count``, the titles of ``hits`` (as made by ``with_hits``) that have each, none included."""
    found = reduce(DataFrame.unionByName, (hits.select(F.lit(kind).alias("rule_class"), F.explode(f"{name}_terms").alias("term")) for kind, name in CLASSES.items()))
    counts = found.groupBy("rule_class", "term").agg(F.count("*").alias("title_count"))
    return terms.join(counts, ["rule_class", "term"], "left").select(*terms.columns, F.coalesce("title_count", F.lit(0).cast("long")).alias("title_count"))


def _count(c: Column) -> Column:
    return c.cast("long")


def with_hits(articles: DataFrame, terms: DataFrame, title: str = "title") -> DataFrame:
    """``articles`` with five hit counts and the sorted distinct terms of each class.

    A hit is a term of the table, however often the title has it. The vocabulary is configuration: while it has up to
    ``MAX_LITERALS`` distinct terms the hits are expressions within the scan's stage, without join or shuffle.
    """
    rows = active_terms(terms).limit(MAX_LITERALS + 1).collect()
    if len(rows) > MAX_LITERALS or len({tuple(r) for r in rows}) < len(rows):
        return with_joined_hits(articles, terms, title)
    in_scope = lambda scope, kinds: [r.term for r in rows if r.match_scope == scope and r.rule_class in kinds]
    known = lambda c, words: F.filter(c, lambda w: w.isin(words)) if words else F.array().cast("array<string>")
    out = articles.withColumn("_tokens", tokens(F.col(title))).withColumn("_spaced", spaced(F.col(title)))
    out = out.withColumn("_known", F.array_distinct(known("_tokens", in_scope("token", CLASSES))))  # few or none, so each class looks at few
    for kind, name in CLASSES.items():
        phrases = [F.when(F.contains(F.col("_spaced"), F.lower(F.lit(p))), F.lit(p)) for p in in_scope("phrase", (kind,))]
        found = F.array_compact(F.array(*phrases)) if phrases else F.array().cast("array<string>")
        out = out.withColumn(f"{name}_tokens", known("_known", in_scope("token", (kind,)))).withColumn(f"{name}_phrases", found)
    for name in CLASSES.values():
        both = F.concat(f"{name}_tokens", f"{name}_phrases")
        out = out.withColumn(f"{name}_hit_count", _count(F.size(both))).withColumn(f"{name}_terms", F.sort_array(F.array_distinct(both)))
    out = out.withColumn("allow_token_hit_count", _count(F.size("allow_tokens"))).withColumn("allow_phrase_hit_count", _count(F.size("allow_phrases")))
    return out.drop("_tokens", "_spaced", "_known", *(f"{n}_{k}" for n in CLASSES.values() for k in ("tokens", "phrases")))


def _runs(text: Column, n: int) -> Column:
    """All runs of ``n`` characters; a shorter text itself."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substring(text, i, n))


def phrase_index(phrases: DataFrame) -> DataFrame:
    """``phrases`` with ``gram``: of the runs of ``GRAM`` characters of a phrase the one that fewest phrases have, or a shorter phrase itself."""
    grams = phrases.select("term").distinct().select("term", F.explode(F.array_distinct(_runs(F.lower("term"), GRAM))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = grams.join(counts, "gram").groupBy("term").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    return phrases.join(rarest, "term")


def phrase_hits(titles: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """(key, term, rule_class, match_scope) of the phrases that titles (key, s) contain: titles' runs of characters meet the phrases' rarest ones by equality, then the phrase is looked for."""
    index = phrase_index(phrases)
    sizes = sorted(r[0] for r in phrases.select(F.least(F.length("term"), F.lit(GRAM))).distinct().collect())  # ``GRAM`` and one numbers at most
    if not sizes:
        return titles.select(key).limit(0).join(phrases, F.lit(False))
    runs = [F.when(F.length("s") >= n, _runs(F.col("s"), n)).otherwise(F.array()) for n in sizes]
    met = titles.select(key, "s", F.explode(F.array_distinct(F.concat(*runs))).alias("gram")).join(index, "gram")
    return met.filter(F.instr("s", F.lower("term")) > 0).select(key, "term", "rule_class", "match_scope")


def with_joined_hits(articles: DataFrame, terms: DataFrame, title: str = "title", key: str = "source_record_id") -> DataFrame:
    """The same for any vocabulary: distinct tokens are joined on equality, phrases by a run of their characters. ``key`` tells articles apart."""
    terms = active_terms(terms)
    named = articles.select(key, tokens(F.col(title)).alias("t"), spaced(F.col(title)).alias("s"))
    words = named.select(key, F.explode(F.array_distinct("t")).alias("term"))
    by_word = words.join(terms.filter("match_scope = 'token'"), "term").select(key, "term", "rule_class", "match_scope")
    by_phrase = phrase_hits(named.select(key, "s"), terms.filter("match_scope = 'phrase'"), key)
    hits = by_word.unionAll(by_phrase)
    when = lambda kind: F.col("rule_class") == kind
    counts = [F.count_if(when(k)).alias(f"{n}_hit_count") for k, n in CLASSES.items()]
    counts += [F.count_if(when("allow") & (F.col("match_scope") == s)).alias(f"allow_{s}_hit_count") for s in ("token", "phrase")]
    lists = [F.sort_array(F.collect_set(F.when(when(k), F.col("term")))).alias(f"{n}_terms") for k, n in CLASSES.items()]
    found = hits.groupBy(key).agg(*counts, *lists)
    out = articles.join(found, key, "left")
    for c in found.columns[1:]:
        out = out.withColumn(c, F.coalesce(c, F.array().cast("array<string>") if c.endswith("_terms") else F.lit(0).cast("long")))
    return out
