"""The corpus pipeline: stages over `documents`, each written as Parquet for the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, host_quality, line_dedup, mixing, simhash
from tessera.llm.common import WORD, drop_scratch, read_table, scratch_mark, scratch_path
from tessera.llm.queries import MIX_SEED, RANKS, domain_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The mix: words kept of a hundred, and integer weights of languages within each domain. Domains,
#: and the sources of a language, keep their own proportions. Every document is taken once at
#: most, so the budget leaves the weights room to be reached.
KEEP_PERCENT = 80
WEIGHTS = {"domain": None, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": None}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go; null texts count as empty, and
    a null source is a host of its own."""
    return host_quality.keep_documents(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars follows the text, and is null with it."""
    out = line_dedup.drop_boilerplate(docs, "text", F.col("source"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest id. Documents
    without an id stay, once if they are equal in all columns."""
    return simhash.keep_one_per_group(docs, simhash.near_duplicate_groups(docs)).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their leaf's share of the words; each is taken once at most. Null
    languages and sources are leaves named ''."""
    budget = F.expr(f"total * {KEEP_PERCENT} div 100")
    words = F.regexp_count("text", F.lit(WORD))
    taken = mixing.mix(docs, domain_of(F.col("source")), F.col("lang"), F.col("source"), words, budget, WEIGHTS, 1, MIX_SEED)
    # ids may be null or repeated: what is taken is matched by id, each id's rows together
    gone = docs.select("doc_id").where("doc_id is not null").distinct().join(taken.select("doc_id").distinct(), "doc_id", "left_anti")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of them and of what they decode to; null texts have
    no ids."""
    ranks = public_tokenizers.path(RANKS)
    decoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates), ("mix to weights", mix), ("byte-level bpe", encode)]

#: Words repeated within a text, fingerprints and merges have no SQL form; the tests hold
#: every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages leave of `documents`, encoded: (doc_id, n_tokens, ids_sha256,
    decoded_sha256).

    Each stage is written as Parquet into the shared folder and read again; what a stage and
    its predecessor left there goes once the next one is written. Null and repeated ids, null
    and empty texts pass or go by each stage's own rule; an empty table gives an empty result.
    """
    docs, mark = read_table(spark, sf_dir, "documents"), scratch_mark()
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage_{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        drop_scratch(spark, mark, path)
    return docs
