"""Host-level quality rules.

Every document is measured by rules; failures are counted by host; each host's
failure rate is shrunk with a beta prior fitted to all hosts; the host's verdict is
joined back and decides how strictly its documents are judged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import staged, tidy

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
#: The hard rules of the base: too few words, or too many within repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Soft rules, in percent: symbols to words, repeated lines to lines; mean word length.
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT = 20, 30
MIN_MEAN_CHARS, MAX_MEAN_CHARS = 2, 15
#: A host whose shrunk failure rate reaches this is judged without the slack below.
STRICT_RATE = 0.5
#: A host whose shrunk failure rate reaches this is dropped whole.
BLOCK_RATE = 0.95
#: In a host that is not strict, a document must miss a soft limit by this factor.
SLACK = 1.5

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The counts of one text, in the order of _COUNTS. A null text counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, SPACE))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), len(lines), repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more, first places included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, upto = 0, 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            covered += at + 3 - max(at, upto)
            upto = at + 3
    return covered


def measured(docs: DataFrame, text_col: str, drop_text: bool = False) -> DataFrame:
    """docs with the counts of every row; drop_text leaves the text itself in the worker."""
    at = docs.columns.index(text_col)
    fields = [f for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    schema = StructType(fields + [StructField(c, LongType()) for c in _COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(text.as_py()) for text in batch.column(at)]
            counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(_COUNTS))]
            columns = [c for i, c in enumerate(batch.columns) if not (drop_text and i == at)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _soft_failed(slack: float) -> Column:
    """A soft rule is failed; slack widens every limit."""
    return (
        (F.col("n_symbols") * 100 > F.col("n_words") * (MAX_SYMBOL_PERCENT * slack))
        | (F.col("n_dup_lines") * 100 > F.col("n_lines") * (MAX_DUP_LINE_PERCENT * slack))
        | (F.col("word_chars") * slack < F.col("n_words") * MIN_MEAN_CHARS)
        | (F.col("word_chars") > F.col("n_words") * (MAX_MEAN_CHARS * slack))
    )


def _kept_by_host() -> Column:
    return F.when(F.col("verdict") == "blocked", False).when(F.col("verdict") == "strict", ~_soft_failed(1.0)).otherwise(~_soft_failed(SLACK))


def beta_prior(docs: float, failed: float, square: float, hosts: int) -> tuple[float, float]:
    """(mean, strength in documents) of the prior, by moments of the hosts' rates
    weighted by documents; square is the sum of documents times squared rate."""
    if not docs:
        return 0.0, 2.0
    mean, average = failed / docs, docs / hosts
    chance = mean * (1 - mean)
    between = square / docs - mean * mean - chance * hosts / docs
    return mean, max(chance / between - 1, 2.0) if between > 0 else max(average, 2.0)


def host_verdicts(judged: DataFrame, host_col: str = "host", failed_col: str = "failed") -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, verdict) from a boolean a document.

    The prior is the beta distribution with the mean and variance (moments) of the
    hosts' own rates, each host counting by its documents; where hosts differ no more
    than chance explains, the prior is worth as many documents as an average host.
    """
    hosts = staged(judged.groupBy(host_col).agg(F.count("*").alias("n_docs"), F.sum(F.col(failed_col).cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_docs").cast("double").alias("docs"),
        F.sum("n_failed").cast("double").alias("failed"),
        F.sum(F.col("n_docs") * rate * rate).alias("square"),
        F.count("*").alias("hosts"),
    ).first()
    mean, strength = beta_prior(moments["docs"] or 0.0, moments["failed"] or 0.0, moments["square"] or 0.0, moments["hosts"])
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.select(
        host_col,
        "n_docs",
        "n_failed",
        shrunk.alias("shrunk_rate"),
        F.when(shrunk >= BLOCK_RATE, "blocked").when(shrunk >= STRICT_RATE, "strict").otherwise("normal").alias("verdict"),
    )


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id_col, host, counts, base_failed, verdict, kept) for every row of docs.

    A document that fails the base is dropped. Else its host's verdict counts:
    a blocked host's documents go, a strict host's documents go when a soft rule is
    failed, other hosts' documents go when a soft limit is missed by SLACK times.
    A null text counts as empty, rows without a host form one host of their own, and
    repeated rows or ids are judged one by one. Other columns are not read.
    """
    named = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{host_col}`").cast("string").alias("host"), F.col(f"`{text_col}`").cast("string").alias("text__"))
    rows = staged(measured(named, "text__", drop_text=True), "measured")
    failed = rows.select(F.coalesce("host", F.lit("\0")).alias("host"), (base_failed() | _soft_failed(1.0)).alias("failed"))
    verdicts = host_verdicts(failed).select(F.col("host").alias("host__"), "shrunk_rate", "verdict")
    joined = rows.join(verdicts, F.coalesce("host", F.lit("\0")) == F.col("host__"), "left").drop("host__")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & _kept_by_host())


def keep_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of docs that judge_documents keeps, unchanged.

    Verdicts take part by host and rules are measured in the same scan, so no text is
    shuffled: the host table is joined to the documents, and Spark picks a broadcast
    only where that table is small.
    """
    columns = [F.col(f"`{c}`").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    host = F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("\0"))
    rules = measured(docs.select(host.alias("host__"), F.col(f"`{text_col}`").cast("string").alias("text__")), "text__", drop_text=True)
    verdicts = host_verdicts(rules.select("host__", (base_failed() | _soft_failed(1.0)).alias("failed__")), "host__", "failed__")
    known = docs.select(*[c.alias(f"{k}__") for k, c in enumerate(columns)], host.alias("host__")).join(verdicts.select("host__", "verdict"), "host__")
    judged = measured(known, f"{docs.columns.index(text_col)}__").where(~base_failed() & _kept_by_host())
    return judged.select(*[F.col(f"{k}__").alias(c) for k, c in enumerate(docs.columns)])
