"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, takes accents off, and maps homoglyphs and digit or sign
substitutions to the letters they stand for. Matches count at word boundaries, unless
they lie within an exception phrase. The sum of their weights is normalised by length,
and a logistic curve turns it into a score. Weights of the seed terms, further terms (words and beginnings
of words) and the curve are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm import simhash
from tessera.llm.common import staged, tidy

#: Labelled rows that training reads at most (in expectation), half of each label.
MAX_TRAINING_ROWS = 6000
#: A learned term must be in so many toxic rows and in such a part of them, and reach the log
#: odds and the z-score. A term in a hundredth of the toxic rows leaves room for no more terms
#: than a hundred times the distinct words and beginnings of a text.
MIN_ROWS, MIN_PART, MIN_ODDS, MIN_Z = 8, 0.01, 2.5, 6.0
#: Bits of the fingerprints that tell near copies among the sampled rows.
COPY_BITS = 512
#: Lengths of the word beginnings that are learned beside whole words; written with a '*'.
STEMS = (4, 5, 6, 7)

SEED_WORDS = (
    "idiot idiots moron morons imbecile cretin stupid dumb dumbass fool loser losers clown scum trash garbage filth vermin"
    " worthless pathetic disgusting hateful bastard bitch asshole jerk retard retarded pig slut whore shit bullshit fuck fucking"
    " fucker crap damn bollocks wanker twat prick cunt dickhead douchebag parasite subhuman degenerate lowlife"
    " dummkopf idioten arschloch scheisse schwachkopf vollidiot abschaum wertlos"
    " connard salaud abruti ordure debile merde encule"
    " idiota imbecil estupido basura cabron gilipollas mierda asqueroso"
)
SEED_PHRASES = ("shut up", "kill yourself", "go to hell", "drop dead", "i hate you", "piece of shit", "waste of space", "nobody likes you", "halt die klappe", "hau ab", "ferme la", "ta gueule", "vete al infierno")
EXCEPTIONS = ("clown fish", "clown car", "class clown", "trash can", "trash bag", "garbage collection", "garbage collector", "pathetic fallacy", "guinea pig", "pig iron", "hot damn", "fool s gold", "april fool", "dumb waiter", "dumb terminal", "parasite drag", "loser pays")

#: Look-alike letters of other scripts, and what they stand for.
_LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвнԛԝґɡıαοερτυνικηωχ", "aeopcyxijsdhkmtbhqwrgiaoeptuvikhwx", strict=True))
_DIGITS = dict(zip("013457", "oieast", strict=True))


def _folding() -> dict[int, str]:
    """Single characters: accents off (by decomposition), full width to ASCII, look-alikes, digits."""
    table = {c: chr(c - 0xFEE0).lower() for c in range(0xFF01, 0xFF5F)}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(c).lower())[0]
        if base.isascii():
            table[c] = base
    table |= {c: None for c in [*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0xFEFF]}
    for source in (_LOOKALIKES, _DIGITS):
        table |= {ord(a): b for a, b in source.items()}
        table |= {ord(a.upper()): b for a, b in source.items() if len(a.upper()) == 1 and not a.isascii()}
    return table


FOLDING = _folding()
_SIGNS = re.compile(r"[$@](?=\w)")
_INNER = re.compile(r"(?<=[a-z])[!|](?=[a-z])")


def fold(text: str) -> str:
    """Folded text. Signs count as letters only before or between letters, so that marks
    after a word leave it as it is."""
    text = text.lower().translate(FOLDING)
    if "$" in text or "@" in text:
        text = _SIGNS.sub(lambda m: "s" if m[0] == "$" else "a", text)
    if "!" in text or "|" in text:
        text = _INNER.sub("i", text)
    return text


def seed_terms() -> list[str]:
    return sorted({*SEED_WORDS.split(), *SEED_PHRASES})


@dataclass
class ToxicityModel:
    """Weights by term and a logistic curve over (weight a word, log weight, any match)."""

    weights: dict[str, float]
    curve: list[float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "curve": self.curve, "exceptions": self.exceptions, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for phrase in self.exceptions:
                a.add_word(phrase, (len(phrase), None, None))
            for term, weight in self.weights.items():
                text = term.removesuffix("*")
                _, whole, stem = a.get(text, (0, None, None))
                a.add_word(text, (len(text), *((whole, weight) if text != term else (weight, stem))))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) outside of exception phrases. Terms count at word boundaries,
        beginnings where a word begins; of several from one place the heaviest counts."""
        found, spared, n = {}, [], len(folded)
        exceptions = set(self.exceptions)
        for last, (size, whole, stem) in self.automaton().iter(folded) if len(self.automaton()) else ():
            start, end = last - size + 1, last + 1
            if start and folded[start - 1].isalnum():
                continue
            inside = end < n and folded[end].isalnum()
            if not inside and folded[start:end] in exceptions:
                spared.append((start, end))
            weights = [w for w in (None if inside else whole, stem) if w is not None]
            if weights and max(weights) > found.get(start, (0, -1.0))[1]:
                found[start] = end, max(weights)
        spared.sort()
        out, upto, at = [], 0, 0
        for start, (end, weight) in sorted(found.items()):
            while at < len(spared) and spared[at][0] <= start:
                upto, at = max(upto, spared[at][1]), at + 1
            if end > upto:
                out.append((start, end, weight))
        return out

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Weight of matches a word, log of 1 + weight, and whether any matched."""
        if not text:
            return 0.0, 0.0, 0.0
        folded = fold(text)
        weight = sum(w for _, _, w in self.matches(folded))
        return 10 * max(weight, 0.0) / (len(folded.split()) + 10), math.log1p(max(weight, 0.0)), float(weight > 0)

    def score(self, text: str | None) -> float:
        z = self.curve[0] + sum(c * x for c, x in zip(self.curve[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 200, ridge: float = 0.05) -> list[float]:
    """Weights of a logistic curve by Newton steps, slopes held at zero or more."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w)), grad)
        new = w - np.clip(step, -2, 2)
        new[1:] = np.maximum(new[1:], 0)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w.tolist()


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, n_toxic, n_clean) over distinct folded words and word beginnings of each text."""

    @F.pandas_udf("array<string>")
    def terms(texts: pd.Series) -> pd.Series:
        def of(text):
            words = set(re.findall(r"[^\W\d_]{3,}", fold(text)))
            return sorted(words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n})

        return texts.map(of)

    each = sample.select("label__", F.explode(terms("text__")).alias("term"))
    return each.groupBy("term").agg(F.sum("label__").alias("n_toxic"), F.sum(1 - F.col("label__")).alias("n_clean"))


def learn_weights(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Log odds of terms, seeds and learned ones."""
    odds = F.log((F.col("n_toxic") + 0.5) / (toxic - F.col("n_toxic") + 0.5)) - F.log((F.col("n_clean") + 0.5) / (clean - F.col("n_clean") + 0.5))
    toxic_part, clean_part, part = F.col("n_toxic") / toxic, F.col("n_clean") / clean, (F.col("n_toxic") + F.col("n_clean")) / (toxic + clean)
    z = (toxic_part - clean_part) / F.sqrt(part * (1 - part) * (1 / toxic + 1 / clean) + 1e-12)
    scored = counts.withColumn("odds", odds).withColumn("z", z)
    learned = scored.where((F.col("n_toxic") >= max(MIN_ROWS, MIN_PART * toxic)) & (F.col("odds") >= MIN_ODDS) & (F.col("z") >= MIN_Z))
    weights = {term: 1.5 for term in seed_terms()}
    seen = scored.where(F.col("term").isin(list(weights)) & (F.col("n_toxic") + F.col("n_clean") >= MIN_ROWS))
    for row in seen.collect():
        weights[row["term"]] = float(max(0.0, min(4.0, row["odds"])))
    for row in learned.collect():
        weights[row["term"]] = float(min(4.0, row["odds"]))
    return weights


def without_copies(sample: DataFrame) -> DataFrame:
    """The rows of sample(id__, text__, ...) that are no near copy of one with a smaller id.

    The sample is bounded (twice the training rows), and so are its fingerprints of COPY_BITS
    bits, which are compared on the driver.
    """
    rows = sorted((r["id__"], r["wide"]) for r in simhash.wide_prints(sample, "id__", "text__", 5, COPY_BITS // 64).select("id__", "wide").collect())
    if not rows:
        return sample
    prints = np.array([w for _, w in rows], np.int64).view(np.uint64)
    radius, gone = simhash.radius_of(COPY_BITS, 2), []
    for start in range(0, len(rows), 128):
        part = prints[start : start + 128]
        near = np.bitwise_count(part[:, None] ^ prints[None, : start + len(part)]).sum(axis=2, dtype=np.int64) <= radius
        gone += [rows[start + at][0] for at in range(len(part)) if near[at, : start + at].any()]
    ids = sample.sparkSession.createDataFrame([(i,) for i in gone], f"id__ {sample.schema['id__'].dataType.simpleString()}")
    return sample.join(F.broadcast(ids), "id__", "left_anti")


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Learn from a sample of labelled rows, about max_rows / 2 of each label, drawn by a
    hash of the id; copies and near copies of a text count once. Rows with a null id, text or label, and
    labels other than 0 and 1, teach nothing. Without rows of both labels the seed terms
    keep their weights, and a curve that asks for one match in about twenty words.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("label__"))
    counts = {r[0]: r[1] for r in known.groupBy("label__").count().collect()}
    fallback = ToxicityModel({term: 1.5 for term in seed_terms()}, [-2.0, 2.5, 0.5, 0.5])
    if len(counts) < 2:
        return fallback
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col(id_col)), F.lit(1 << 20)) / float(1 << 20)
    part = F.when(F.col("label__") == 1, min(1.0, max_rows / 2 / counts[1])).otherwise(min(1.0, max_rows / 2 / counts[0]))
    # twice the expected number bounds what is broadcast, so that no text but the sample's moves
    drawn = F.broadcast(known.where(draw < part).orderBy(draw, id_col).limit(2 * max_rows))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col), F.col(text_col).cast("string").alias("text__"))
    sample = texts.join(drawn, id_col).groupBy(F.col(id_col).alias("id__")).agg(F.min("text__").alias("text__"), F.max("label__").alias("label__"))
    sample = staged(sample.groupBy("text__").agg(F.max("label__").alias("label__"), F.min("id__").alias("id__")), "labelled")
    sample = staged(without_copies(sample), "distinct")
    n = {r[0]: r[1] for r in sample.groupBy("label__").count().collect()}
    if len(n) < 2:
        return fallback
    model = ToxicityModel(learn_weights(_term_counts(sample), n[1], n[0]), [0.0] * 4)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def features(column: pd.Series) -> pd.Series:
        return column.map(lambda t: list(shared.value.features(t)))

    rows = sample.select(features("text__").alias("x"), "label__", F.xxhash64("text__").alias("order")).orderBy("order").collect()
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    # the sample has as many rows of each label as there are; the curve learns the labels' own shares
    share = counts[1] / (counts[0] + counts[1])
    curve = _logistic(x, y)
    drawn_share = y.mean()
    curve[0] += math.log(share / (1 - share)) - math.log(drawn_share / (1 - drawn_share))
    return ToxicityModel(model.weights, curve)


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """docs with `score` (0 to 1) of each whole text in place of text_col. Null and empty
    texts get the score of no match; other columns are passed on as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    schema = StructType([*(f for f in docs.schema.fields if f.name != text_col), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([shared.value.score(text.as_py()) for text in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), scores], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)
