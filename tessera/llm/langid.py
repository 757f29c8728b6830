"""Language identification: averaged hashed subword embeddings, linear softmax.

A text becomes its lower-cased letters, other runs being one space; its character
n-grams are hashed to buckets, the buckets' embeddings are averaged, and a linear
softmax scores the languages. Embeddings and weights are trained together by
stochastic gradient descent in numpy. Scores are calibrated by a temperature fitted
on rows kept out of training, which also set the score below which the language is
better left open.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tessera.llm.common import staged, tidy

BUCKET_BITS, SIZE, GRAMS = 15, 16, (1, 2, 3, 4)
#: Labelled rows that training reads at most (in expectation), over all languages.
MAX_TRAINING_ROWS = 1600
#: Parts that the whole text of a training row is cut into at most, and characters of a part at least.
PARTS, PART = 6, 96
EPOCHS, RATE = 5, 0.6
#: Characters of a text whose n-grams are held at once.
PIECE = 1 << 16
#: Precision that accepted rows should have.
PRECISION = 0.99

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def point_pieces(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """(code points, how many of them were in the piece before) of pieces of a text: lower-cased
    letters, each other run as one space, a space at either end of the text. A piece starts with
    as many old points as an n-gram may reach back."""
    tail = np.array([32], np.uint32)
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= tail[-1] != 32
        points = np.where(letter, points, np.uint32(32))[keep]
        if at + PIECE >= len(text) and (points[-1] if len(points) else tail[-1]) != 32:
            points = np.append(points, np.uint32(32))
        whole = np.concatenate([tail, points])
        yield whole, len(tail) if at else 0
        tail = whole[-(max(GRAMS) - 1) :]


def gram_buckets(points: np.ndarray, old: int = 0) -> list[np.ndarray]:
    """Bucket of each n-gram that doesn't lie within the first `old` points, an array for each n."""
    out = []
    value = np.zeros(len(points), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(points) < n:
            break
        value = (value[: len(points) - n + 1] ^ points[n - 1 :]) * _MULTIPLIERS[n - 1]
        value ^= value >> np.uint32(13)
        if n in GRAMS:
            out.append(((value * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKET_BITS))[max(0, old - n + 1) :])
    return out


def bag_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of all n-grams of a text."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for points, old in point_pieces(text):
        for buckets in gram_buckets(points, old):
            total += np.bincount(buckets, minlength=len(total))
    held = np.flatnonzero(total)
    return held, total[held]


@dataclass
class LanguageModel:
    """Scores by bucket (embeddings times weights), bias, languages, temperature and the
    score that accepted rows reach."""

    table: np.ndarray
    bias: np.ndarray
    languages: list[str]
    temperature: float
    accept: float

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts @ self.table[buckets] / max(1, counts.sum()) + self.bias

    def text_logits(self, text: str) -> np.ndarray:
        """Logits of a whole text, a piece at a time."""
        total, n = np.zeros(len(self.languages)), 0
        for points, old in point_pieces(text):
            for buckets in gram_buckets(points, old):
                total += np.take(self.table, buckets, axis=0).sum(axis=0, dtype=np.float64)
                n += len(buckets)
        return total / max(1, n) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, accepted); ('und', 0, False) for a text without a letter."""
        if not has_letter(text):
            return "und", 0.0, False
        scaled = self.text_logits(text) / self.temperature
        odds = np.exp(scaled - scaled.max())
        best = int(odds.argmax())
        score = float(odds[best] / odds.sum())
        return self.languages[best], score, score >= self.accept


def training_parts(rows: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(label, fold, buckets binary, counts binary) of the parts that each whole text is cut into:
    every character is in one. A part gives its n-grams counted by bucket, so its size is bounded
    by the number of buckets however long the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not has_letter(text):
                    continue
                size = max(PART, -(-len(text) // PARTS))
                for at in range(0, len(text), size):
                    buckets, counts = bag_of(text[at : at + size])
                    out.append((label, fold, buckets.astype("<u2").tobytes(), counts.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int32(), pa.binary(), pa.binary()))], names=["label", "fold", "buckets", "counts"])

    return rows.select(F.col(text_col).cast("string"), F.col(label_col), F.col("fold__")).mapInArrow(tidy(run), "label string, fold int, buckets binary, counts binary")


def fit(examples: list[tuple[str, int, bytes, bytes]], seed: int = 7) -> LanguageModel:
    """Train on examples of folds other than 0 and calibrate on fold 0."""
    languages = sorted({label for label, *_ in examples})
    if not languages:
        return LanguageModel(np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0), [], 1.0, 1.0)
    number = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (1 << BUCKET_BITS, SIZE)) / SIZE
    weights, bias = np.zeros((len(languages), SIZE)), np.zeros(len(languages))
    rows = [(number[label], fold, np.frombuffer(buckets, "<u2").astype(np.int64), np.frombuffer(counts, "<u4").astype(np.float64)) for label, fold, buckets, counts in sorted(examples)]
    train = [r for r in rows if r[1]] or rows
    held = [r for r in rows if not r[1]] or rows
    steps, step = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for at in rng.permutation(len(train)):
            label, _, buckets, counts = train[at]
            rate = RATE * (1 - step / steps)
            step += 1
            part = counts / counts.sum()
            mean = part @ table[buckets]
            odds = weights @ mean + bias
            odds = np.exp(odds - odds.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = weights.T @ error
            weights -= rate * 4 * np.outer(error, mean)
            bias -= rate * 0.05 * error
            table[buckets] -= np.outer(part, rate * 4 * back)
    joined = (table @ weights.T).astype(np.float32)
    model = LanguageModel(joined, bias, languages, 1.0, 0.0)
    return calibrate(model, [(label, model.logits(buckets, counts)) for label, _, buckets, counts in held])


def calibrate(model: LanguageModel, held: list[tuple[int, np.ndarray]]) -> LanguageModel:
    """Temperature of least log loss on held-out rows, and the lowest score from which on
    the rows accepted are right at the rate PRECISION."""
    logits, labels = np.stack([x for _, x in held]), np.array([label for label, _ in held])

    def probabilities(t):
        odds = np.exp((logits - logits.max(axis=1, keepdims=True)) / t)
        return odds / odds.sum(axis=1, keepdims=True)

    loss = lambda t: -np.log(probabilities(t)[np.arange(len(labels)), labels] + 1e-12).mean()
    temperature = float(min(np.geomspace(0.1, 10, 41), key=loss))
    p = probabilities(temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-score)
    precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(precise >= PRECISION)
    accept = float(score[order][good[-1]]) if len(good) else 1.0
    return LanguageModel(model.table, model.bias, model.languages, temperature, accept)


def train_language_model(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", max_rows: int = MAX_TRAINING_ROWS) -> LanguageModel:
    """Fit a model on a sample of labelled rows, in equal parts by label.

    The sample is drawn by a hash of the id: max_rows / labels rows a label are expected, and
    max_rows of all at most. Each row gives the n-grams of its whole text, counted by bucket in
    PARTS parts; that bound is what reaches the driver. Rows with a null id, label or text
    teach nothing. Any number of labels will do: their counts are a table, joined to the rows.
    """
    label = F.col(label_col).cast("string").alias("label__")
    rows = labelled.select(F.col(id_col).alias("id__"), label, F.col(text_col).cast("string").alias("text__")).where("id__ is not null and label__ is not null and text__ is not null")
    counts = staged(rows.groupBy("label__").agg(F.count("*").alias("n__")), "labels")
    labels = counts.count()
    if not labels:
        return fit([])
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col("id__")), F.lit(1 << 20)) / float(1 << 20)
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("id__")), F.lit(5)).cast("int")
    sample = rows.join(counts, "label__").where(draw * F.col("n__") < max_rows / labels).select("text__", "label__", fold.alias("fold__"))
    return fit([(r[0], r[1], bytes(r[2]), bytes(r[3])) for r in training_parts(sample, "text__", "label__").collect()])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with lang string, score double, accepted boolean in place of text_col, from the
    whole of each text.

    A null text, or one without a letter, gives ('und', 0, false); so does every text if
    the model learned no language. Other columns are passed on as they are; columns that
    have the three names already are to be renamed before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = StructType([*kept, StructField("lang", StringType()), StructField("score", DoubleType()), StructField("accepted", BooleanType())])
    kinds = (pa.string(), pa.float64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = [own.predict(text.as_py()) if own.languages else ("und", 0.0, False) for text in batch.column(at)]
            found = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), *found], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)
