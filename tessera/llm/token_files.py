"""Token-id files: each document compressed by itself with one shared dictionary.

Format (a folder): `shards` holds rows of (part, shard, dict_hash, blob, ...); a blob
is the documents' zstandard frames end to end. Beside the blob stand, for its
documents in order: keys, byte offsets and lengths of the frames, ids before each in the
shard, and numbers of ids; that is the index, which Parquet reads without the blobs. `dictionary` holds the dictionary with its hash, which every shard repeats. One
short document costs one index row and one slice of one shard.

The tables are written by Spark, so they may live in any store Spark reaches. Parts
and shards are numbered in ascending order of the document id.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import rows_to_batches, tidy
from tessera.llm.pretoken import splitter

#: Bytes of frames, and documents, after which a shard ends.
SHARD_BYTES, SHARD_DOCS = 1 << 20, 16384
#: The dictionary: documents it is trained on at most, their ids taken at most, its bytes.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 1000, 20_000, 64 << 10
#: Largest tokenizer file that is broadcast, and words remembered between documents.
MAX_TOKENIZER_BYTES, MEMORY_WORDS = 64 << 20, 250_000
LEVEL = 3


def _byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write each byte as: printable Latin-1 as
    it is, the other bytes in order from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _KnownWords(dict):
    """Ids (32-bit, packed) by word; a word that isn't known yet is encoded."""

    def __init__(self, tokenize):
        super().__init__()
        self.tokenize = tokenize
        self.characters = _byte_characters()

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            written = word.replace(" ", "\u0120")
        else:
            written = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.characters)
        self[word] = ids = array("I", [t.id for t in self.tokenize(written)]).tobytes()
        return ids


class WordEncoder:
    """Ids of texts by a tokenizers file, each distinct word encoded once while it is
    remembered. Words are the matches of the byte-level split pattern, within which all
    merges happen, so a text's ids are its words' ids in a row. A tokenizer that isn't
    byte-level, or normalizes, encodes texts as a whole, and so does any for a text that
    holds the spelling of one of its added tokens (such as an end mark), which then gives that
    token's id. special_as_text takes such spellings for ordinary text instead."""

    def __init__(self, tokenizer_json: str, pattern: str | None, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        split = self.tokenizer.pre_tokenizer
        by_word = pattern and self.tokenizer.normalizer is None and isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space
        self.find = splitter(pattern) if by_word else None
        if by_word:
            model = self.tokenizer.model
            model._resize_cache(0)  # words are remembered here
            self.known = _KnownWords(model.tokenize)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if self.find is None:
            return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.known) > MEMORY_WORDS:
            self.known.clear()
        return [self._by_word(t) for t in texts]

    def _by_word(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.find(text))), np.uint32)


@lru_cache(maxsize=2)
def _word_encoder(tokenizer_json: str, pattern: str | None, special_as_text: bool = False) -> WordEncoder:
    return WordEncoder(tokenizer_json, pattern, special_as_text)


def load_tokenizer(path: str) -> str:
    if (size := os.path.getsize(path)) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} has {size} bytes; up to {MAX_TOKENIZER_BYTES} are broadcast")
    with open(path, encoding="utf-8") as f:
        return f.read()


def serialize(ids: np.ndarray, width: int) -> bytes:
    """Little-endian numbers of `width` bytes."""
    return ids.astype(f"<u{width}").tobytes()


def _batches_of(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of slices of a batch that hold about `size` characters."""
    first, held, chars = 0, [], 0
    for at, text in enumerate(batch.column(column)):
        text = text.as_py() or ""
        held.append(text)
        chars += len(text)
        if chars >= size:
            yield first, held
            first, held, chars = at + 1, [], 0
    if held:
        yield first, held


def train_dictionary(docs: DataFrame, tokenizer: str, pattern: str | None, end_id: int, width: int, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> bytes:
    """A zstandard dictionary trained on serialized ids of at most SAMPLE_DOCS documents.

    The sample are the documents whose ids have the smallest hashes, found in the ids alone;
    rows with one id give one. Of each, at most SAMPLE_IDS ids evenly spread over the document
    are used, cut where they are encoded, which bounds what reaches the driver. Too small a
    sample gives an empty dictionary.
    """
    order = F.xxhash64(F.lit("dictionary"), F.col(id_col))
    last = docs.select(order.alias("order__")).orderBy("order__").limit(SAMPLE_DOCS).agg(F.max("order__")).first()[0]
    texts = docs.select(order.alias("order__"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull() & (F.col("order__") <= F.lit(last)))
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        encode = _word_encoder(shared.value, pattern, special_as_text)
        for batch in batches:
            for first, held in _batches_of(batch, 1):
                ids = [np.append(i, np.uint32(end_id)) for i in encode(held)]
                ids = [i if len(i) <= SAMPLE_IDS else np.concatenate([i[s : s + SAMPLE_IDS // 10] for s in np.linspace(0, len(i) - SAMPLE_IDS // 10, 10).astype(int)]) for i in ids]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ids)), pa.array([serialize(i, width) for i in ids], pa.binary())], names=["order__", "ids"])

    sample = texts.mapInArrow(tidy(run), "order__ bigint, ids binary").groupBy("order__").agg(F.min("ids").alias("ids"))
    samples = [bytes(r["ids"]) for r in sample.orderBy("order__").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, pattern: str | None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", width: int = 2, special_as_text: bool = False) -> None:
    """Encode every whole text, append end_id, and write the files in ascending id order.

    Null texts count as empty, so every row gives a document of at least one id.
    Rows with equal ids follow each other, by a hash of the text; null ids come first.
    `width` is the bytes of a stored id: 2 for vocabularies up to 65,536, else 4. Ids are those
    of the library as it loads the file, without special tokens added: a text that spells an
    added token has its id there. special_as_text encodes such spellings as text.
    """
    spark = docs.sparkSession
    tokenizer = load_tokenizer(tokenizer_path)
    dictionary = train_dictionary(docs, tokenizer, pattern, end_id, width, id_col, text_col, special_as_text)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), width)], "dict_hash string, dictionary binary, width int").write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((tokenizer, dictionary))
    kind = dict(docs.select(id_col).dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    ddl = f"part int, shard int, blob binary, keys array<{kind}>, offsets array<bigint>, lengths array<bigint>, starts array<bigint>, counts array<bigint>"
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("blob", pa.binary()), ("keys", pa.list_(to_arrow_type(ordered.schema["key"].dataType))), *[(name, pa.list_(pa.int64())) for name in ("offsets", "lengths", "starts", "counts")]])

    def shards(batches):
        tokenizer, dictionary = shared.value
        encode, part, shard = _word_encoder(tokenizer, pattern, special_as_text), TaskContext.get().partitionId(), 0
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        keys, frames, counts, size = [], [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, held in _batches_of(batch, 1):
                for key, ids in zip(names[first : first + len(held)], encode(held), strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    keys.append(key)
                    frames.append(packer.compress(serialize(ids, width)))
                    counts.append(len(ids))
                    size += len(frames[-1])
                    if size >= SHARD_BYTES or len(keys) >= SHARD_DOCS:
                        yield _shard_row(part, shard, keys, frames, counts)
                        keys, frames, counts, size, shard = [], [], [], 0, shard + 1
        if keys:
            yield _shard_row(part, shard, keys, frames, counts)

    written = ordered.mapInArrow(tidy(lambda batches: rows_to_batches(shards(batches), schema, lambda r: len(r[2]) + 20 * len(r[3]))), ddl)
    written.withColumn("dict_hash", F.lit(digest)).write.option("compression", "none").parquet(f"{path}/shards")


def _shard_row(part: int, shard: int, keys: list, frames: list[bytes], counts: list[int]) -> tuple:
    lengths = list(map(len, frames))
    before = lambda numbers: [0, *accumulate(numbers)][:-1]
    return part, shard, b"".join(frames), keys, before(lengths), lengths, before(counts), counts


def open_token_files(spark: SparkSession, path: str) -> tuple[DataFrame, bytes, int]:
    """(shards, dictionary, width); fails if the dictionary isn't the one its hash names."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["dict_hash"]:
        raise ValueError(f"{path}: the dictionary doesn't have the hash written with it")
    return spark.read.parquet(f"{path}/shards"), dictionary, row["width"]


def _bases(shards: DataFrame) -> DataFrame:
    """(part, shard, base): ids of all documents before the shard.

    Running sums over the shards of a part, and over the parts, whose number is that of
    the write's tasks.
    """
    sums = shards.select("part", "shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("ids"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = sums.withColumn("in_part", F.coalesce(F.sum("ids").over(upto(Window.partitionBy("part").orderBy("shard"))), F.lit(0)))
    parts = sums.groupBy("part").agg(F.sum("ids").alias("ids"))
    parts = parts.select("part", F.coalesce(F.sum("ids").over(upto(Window.orderBy("part"))), F.lit(0)).alias("before"))
    return within.join(parts, "part").select("part", "shard", (F.col("in_part") + F.col("before")).alias("base"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: (key, part, shard, offset, length, start, n_tokens) of every
    document; start is the number of ids of all documents before it. Reads no blob."""
    shards = open_token_files(spark, path)[0].drop("blob")
    each = F.posexplode(F.arrays_zip("keys", "offsets", "lengths", "starts", "counts")).alias("place", "z")
    return shards.join(_bases(shards), ["part", "shard"]).select("part", "shard", "base", each).select(
        F.col("z.keys").alias("key"), "part", "shard", F.col("z.offsets").alias("offset"), F.col("z.lengths").alias("length"), (F.col("base") + F.col("z.starts")).alias("start"), F.col("z.counts").alias("n_tokens")
    )


def _check_hash(shards: DataFrame, dictionary: bytes) -> DataFrame:
    """shards, failing where a row was written with another dictionary."""
    digest = hashlib.sha256(dictionary).hexdigest()
    return shards.where(F.when(F.col("dict_hash") == digest, True).otherwise(F.raise_error(F.lit("a shard was written with another dictionary")).cast("boolean")))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start long, n_tokens long, ids binary) of every document, read back from
    the files; ids are little-endian unsigned 32-bit numbers."""
    shards, dictionary, width = open_token_files(spark, path)
    shards = _check_hash(shards, dictionary)
    based = shards.join(_bases(shards.drop("blob")), ["part", "shard"]).select("blob", "keys", "offsets", "lengths", F.transform("starts", lambda s: s + F.col("base")).alias("starts"), "counts")
    from pyspark.sql.pandas.types import to_arrow_type

    kind = based.schema["keys"].dataType.elementType
    schema = pa.schema([(id_col, to_arrow_type(kind)), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    shared = spark.sparkContext.broadcast(dictionary)

    def documents(batches):
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))
        for batch in batches:
            for at in range(batch.num_rows):
                blob, keys, offsets, lengths, starts, counts = (c[at].as_py() for c in batch.columns)
                for key, offset, length, start, count in zip(keys, offsets, lengths, starts, counts, strict=True):
                    yield key, start, count, _ids(unpacker, blob[offset : offset + length], width)

    return based.mapInArrow(tidy(lambda batches: rows_to_batches(documents(batches), schema, lambda r: 32 + len(r[3]))), f"`{id_col}` {kind.simpleString()}, start bigint, n_tokens bigint, ids binary")


def _ids(unpacker: zstandard.ZstdDecompressor, frame: bytes, width: int) -> bytes:
    return np.frombuffer(unpacker.decompress(frame), f"<u{width}").astype("<u4").tobytes()


def fetch_document(spark: SparkSession, path: str, key) -> list[np.ndarray]:
    """Ids of the documents with this key: the index names their shards, whose frames at
    the offsets are all that is decompressed."""
    places = read_index(spark, path).where(F.col("key").eqNullSafe(F.lit(key)))
    shards, dictionary, width = open_token_files(spark, path)
    frames = places.join(_check_hash(shards, dictionary).select("part", "shard", "blob"), ["part", "shard"]).orderBy("start")
    unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    return [np.frombuffer(_ids(unpacker, bytes(r[0]), width), "<u4") for r in frames.select(F.expr("substring(blob, cast(offset + 1 as int), cast(length as int))")).collect()]
