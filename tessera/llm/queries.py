"""The ten operators as queries over the driver tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, host_quality, langid, license_scan, line_dedup, mixing, simhash, token_files, topk, toxicity
from tessera.llm.common import WORD, read_table, scratch_path, staged, unsigned_crc32

#: Mixing: tokens of the mix per token of the corpus, epochs, and integer weights by level.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 4), 4, 42
DOMAINS = ("web", "forum", "news", "reference")
MIX_WEIGHTS = {"domain": {"web": 4, "forum": 2, "news": 3, "reference": 1}, "lang": {"en": 5, "de": 3, "fr": 3, "es": 4}}
#: File format: pattern within whose matches the tokenizer merges, and the id that ends a document.
TOKENIZER, END_ID = "byte_bpe_50k.json", 0
RANKS = "byte_bpe_multi_50k.tiktoken"


def domain_of(source) -> "F.Column":
    """The domain a source belongs to: the first hex digit of its name's md5 picks one of DOMAINS."""
    digit = F.substring(F.md5(F.encode(F.coalesce(source, F.lit("")), "UTF-8")), 1, 1)
    return F.get(F.array(*map(F.lit, DOMAINS)), (F.instr(F.lit("0123456789abcdef"), digit) - 1) % len(DOMAINS))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a mix of three quarters of the corpus' words, once an epoch taken."""
    docs = read_table(spark, sf_dir, "documents")
    budget = F.expr(f"total * {MIX_SHARE[0]} div {MIX_SHARE[1]}")
    words = F.regexp_count("text", F.lit(WORD))
    return mixing.mix(docs, domain_of(F.col("source")), F.col("lang"), F.col("source"), words, budget, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all other rows, repeated
    rows a place each; null and unfinished vectors take no part."""
    vectors = topk.integer_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.exact_topk(vectors, F.col("id") % 100 == 0, 10)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. Texts without words have fingerprint zero;
    a null id keeps its fingerprint and has no component."""
    return simhash.simhash_components(read_table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on documents whose crc32(doc_id) mod 4 isn't 2; predictions see text only."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(unsigned_crc32(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = langid.train_language_model(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", F.col("lang").alias("lang_pred"), "score", "accepted")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document, base phrases and rules; null texts count as empty, with
    no places, '' as labels and a score of 0."""
    scanned = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))
    base, labels = F.transform("base", lambda d: d["label"]), F.transform("detections", lambda d: d["label"])
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    weights = F.transform(F.concat("base", "detections"), lambda d: d["weight"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda d: d["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda d: d["first"])).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, labels)).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, written to files in the shared folder and read back from them."""
    path = scratch_path(spark, "token_files")
    docs = read_table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, END_ID)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of every page without the boilerplate of its host. The text is taken out
    of the pages' source once and stored, as it is read twice."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", line_dedup.url_host(F.col("url")).alias("host"), line_dedup.html_text(F.col("html")).alias("text"))
    pages = staged(pages, "page_text")
    return line_dedup.drop_boilerplate(pages, "text", F.col("host"), dropped_col="n_dropped", lines_col="n_lines")


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; null texts have no words, null sources are one
    host, repeated rows are judged each."""
    judged = host_quality.judge_documents(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of what they decode to; null and empty
    texts have none, repeated rows a row each."""
    ranks = public_tokenizers.path(RANKS)
    decoded = bpe.encode_documents(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on labelled rows whose crc32(doc_id) mod 5 isn't 0; scores see text only."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = lambda c: F.coalesce(unsigned_crc32(c) % 5 == 0, F.lit(False))
    model = toxicity.train_toxicity(docs.select("doc_id", "text"), labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity.score_documents(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_mix_sources, op2_exact_topk, op3_simhash, op4_language_id, op5_license_scan, op6_token_files, op7_line_dedup, op8_host_quality, op9_byte_bpe, op10_toxicity]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from tessera.llm.sql import ORACLES

    return dict(ORACLES)
