"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwire.llm import byte_bpe, conversation_repair, exact_dedup, lexical_search, license_scan, line_dedup, merkle, near_dup, packing, token_count, token_files, toxicity, url_filter
from brightwire.llm.common import id_text, read_table, scratch_path

#: Where the public vocabularies are; every executor has them there.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
TOKEN_LIMIT = 1024
END_ID = 1
SEQUENCE, PAD_ID = 2048, 0


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_dedup(docs, min_docs=10))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), target, end=END_ID)
    return token_files.read_digests(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), [url_filter.parse_rule(*r) for r in RULES])


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.count_tokens(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_dup(documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(packing.cut_up(docs, vocabulary("word_bpe_49k.json"), SEQUENCE, PAD_ID), SEQUENCE)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_study(documents(spark, sf_dir))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted to labelled rows of ``docs`` outside the held-out fifth."""
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(~toxicity.held_out())
    return toxicity.fit(id_text(docs), labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = exact_dedup.exact_dedup(docs)
    digests = exact_dedup.narrow(id_text(docs)).select("doc_id", "n_bytes", "prefix_hash", F.sha2("text", 256).alias("text_sha256")).distinct()
    same = F.expr("a.doc_id <=> b.doc_id and a.n_bytes = b.n_bytes and a.prefix_hash = b.prefix_hash and (a.full_hash is null or a.full_hash = b.text_sha256)")
    return found.alias("a").join(digests.alias("b"), same).select("a.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(read_table(spark, sf_dir, "conversations")), dropped=F.col("dropped"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir), license_scan.template_grams(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_line_dedup, op2_token_files, op3_url_filter, op4_token_count, op5_near_dup, op6_best_fit_packing, op7_merkle, op8_toxicity, op9_exact_dedup, op10_byte_bpe, op11_lexical_search, op12_conversation_repair, op13_license_scan)
    return {f.__name__: f for f in found}
