"""Byte-level BPE over a global shuffle of distinct words.

Encoding:

1. explode: pre-tokens of each document with their positions. A task packs its
   documents into blocks of about BLOCK_BYTES of text; within a block every distinct
   word has a slot, which the block's position lists refer to. Only packed, compressed
   rows leave a task, so a word that fills a third of the corpus costs one entry a block.
2. encode: the blocks' words are shuffled by word (in hash buckets). All entries of a
   word meet in one task, which encodes the word once and answers every block.
3. reassemble: answers and position lists meet by block, and each document's ids are
   gathered by position.

Words and position lists come from a scan each, so that the position lists, most of the
bytes, are shuffled once. Both scans see the same blocks as long as the input reads the
same way twice; each block's word checksum is compared to make sure.

Decoding joins ids with the token-byte table. That table is as large as the
vocabulary file, whose size is checked before it is broadcast.
"""

from __future__ import annotations

import base64
import os
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import xor
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import rows_of, rows_to_batches, tidy
from tessera.llm.pretoken import splitter

#: UTF-8 bytes of text after which a block ends.
BLOCK_BYTES = 16 << 20
#: Bytes of text whose position lists share a row.
CHUNK_BYTES = 1 << 20
#: Hash buckets that words are shuffled in: so many at least and at most, and so many an input
#: partition. A task holds its bucket's words, up to MEMORY_WORDS; beyond, it begins anew, and a
#: word may be encoded again.
BUCKETS, MAX_BUCKETS, PARTITION_BUCKETS, MEMORY_WORDS = 1024, 1 << 16, 16, 1 << 20
#: Largest vocabulary file that is broadcast.
MAX_VOCABULARY_BYTES = 64 << 20
WORDS, DOCS = 0, 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file (base64 and number a line)."""
    if (size := os.path.getsize(path)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; up to {MAX_VOCABULARY_BYTES} are broadcast")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


@lru_cache(maxsize=1)
def _encoder(pattern: str, vocabulary: Broadcast):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=vocabulary.value, special_tokens={})


class TokenTable:
    """Bytes of tokens by id: all of them in a row, where each starts, and its length."""

    def __init__(self, ranks: dict[bytes, int]):
        self.lengths = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        sizes = np.maximum(self.lengths, 0)
        self.starts = np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(token for token, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids' tokens, joined."""
        if len(ids) and (ids.max() >= len(self.lengths) or (self.lengths[ids] < 0).any()):
            raise ValueError("an id that the token table lacks")
        return _gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their bytes in planes, compressed."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _deltas(slots: np.ndarray) -> np.ndarray:
    return np.diff(slots, prepend=slots.dtype.type(0))


def _repeats(slots: np.ndarray, base: int) -> np.ndarray:
    """Position list as codes: 0 where the block's next new word stands, else slot + 1."""
    slots = slots.astype(np.int64)
    seen = np.maximum.accumulate(np.concatenate([[base - 1], slots]))
    return np.where(slots > seen[:-1], 0, slots + 1).astype(np.uint32)


def _slots(codes: np.ndarray, base: int) -> np.ndarray:
    new = codes == 0
    return np.where(new, base + np.cumsum(new) - 1, codes.astype(np.int64) - 1)


_ROW = "key bigint, kind int, block bigint, first bigint, check bigint, slots binary, counts binary, payload binary, ids array<{id}>"


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("check", pa.int64()), ("slots", pa.binary()), ("counts", pa.binary()), ("payload", pa.binary()), ("ids", pa.list_(id_type))])


def _weigh(row: tuple) -> int:
    return 64 + sum(len(x) for x in row[5:8]) + 8 * len(row[8])


class _Block:
    """The words of one block, or the position lists of its documents."""

    def __init__(self, number: int, kind: int):
        self.number, self.kind = number, kind
        self.size = 0
        self.words: dict[str, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.rows: list[tuple] = []
        self._start()

    def _start(self):
        self.first, self.ids, self.counts, self.slots, self.chunk = len(self.words), [], [], [], 0

    def add(self, doc_id, tokens: list[str], size: int):
        self.size += size
        slots = map(self.words.__getitem__, tokens)
        if self.kind == WORDS:
            deque(slots, maxlen=0)
            return
        self.ids.append(doc_id)
        self.counts.append(len(tokens))
        self.slots.append(np.fromiter(slots, np.uint32, len(tokens)))
        self.chunk += size
        if self.chunk >= CHUNK_BYTES:
            self._end_chunk()

    def _end_chunk(self):
        codes = _repeats(np.concatenate(self.slots), self.first)
        self.rows.append((self.first, _pack(codes), _pack(np.array(self.counts, np.uint32)), self.ids))
        self._start()

    def finish(self, buckets: int) -> Iterator[tuple]:
        if self.kind == DOCS:
            if self.ids:
                self._end_chunk()
            check = reduce(xor, (_checksum(w.encode("utf-8", "surrogatepass"), slot) for w, slot in self.words.items()), 0)
            for first, slots, counts, ids in self.rows:
                yield 0, DOCS, self.number, first, check, slots, counts, b"", ids
            return
        found: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        for word, slot in self.words.items():
            data = word.encode("utf-8", "surrogatepass")
            found[crc32(data) % buckets].append((data, slot))
        for bucket, entries in found.items():
            words = [w for w, _ in entries]
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(words))
            check = reduce(xor, (_checksum(w, slot) for w, slot in entries), 0)
            slots = np.array([slot for _, slot in entries], np.uint32)
            yield bucket, WORDS, self.number, 0, check, _pack(_deltas(slots)), _pack(np.fromiter(map(len, words), np.uint32, len(words))), blob, []


def _checksum(word: bytes, slot: int) -> int:
    return crc32(word, slot & 0xFFFFFFFF)


def _explode(kind: int, pattern: str, buckets: int, block_bytes: int, schema: pa.Schema):
    def rows(batches):
        find = splitter(pattern)
        block = None
        for batch in batches:
            for doc_id, text, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                block = block or _Block(part << 32, kind)
                text = text.as_py() or ""
                block.add(doc_id, find(text), len(text))
                if block.size >= block_bytes:
                    yield from block.finish(buckets)
                    block = _Block(block.number + 1, kind)
        if block:
            yield from block.finish(buckets)

    return tidy(lambda batches: rows_to_batches(rows(batches), schema, _weigh))


def _encode_words(pattern: str, ranks, schema: pa.Schema):
    def rows(batches):
        encode = _encoder(pattern, ranks).encode_ordinary
        bucket, known = None, {}
        for batch in batches:
            for row in rows_of(batch):
                if row["key"] != bucket:
                    bucket, known = row["key"], {}
                ends = np.cumsum(_unpack(row["counts"])).tolist()
                blob = zstandard.ZstdDecompressor().decompress(row["payload"])
                ids = []
                for start, end in zip([0, *ends], ends, strict=False):
                    word = blob[start:end]
                    if word not in known:
                        if len(known) >= MEMORY_WORDS:
                            known = {}
                        known[word] = encode(word.decode("utf-8", "surrogatepass"))
                    ids.append(known[word])
                counts = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter((i for word in ids for i in word), np.uint32, int(counts.sum()))
                yield row["block"], WORDS, row["block"], 0, row["check"], row["slots"], _pack(counts), _pack(flat), []

    return tidy(lambda batches: rows_to_batches(rows(batches), schema, _weigh))


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of each pair, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(total)]


def _reassemble(schema: pa.Schema, tokens: Broadcast | None):
    def documents(batches):
        block = None
        for batch in batches:
            for row in rows_of(batch):
                if row["block"] != block:
                    block, parts, table, check = row["block"], [], None, 0
                if row["kind"] == WORDS:
                    check ^= row["check"]
                    parts.append((np.cumsum(_unpack(row["slots"]), dtype=np.uint32), _unpack(row["counts"]), _unpack(row["payload"])))
                    continue
                if check != row["check"]:
                    raise RuntimeError("the input did not read the same way twice; write it to a table first")
                if table is None:
                    table = _table(parts)
                    parts = []
                flat, starts, lengths = table
                slots = _slots(_unpack(row["slots"]), row["first"])
                begin = 0
                for doc_id, n in zip(row["ids"], _unpack(row["counts"]).tolist(), strict=True):
                    own = slots[begin : begin + n]
                    begin += n
                    ids = _gather(flat, starts[own], lengths[own])
                    yield doc_id, len(ids), ids.astype("<u4").tobytes(), *([tokens.value.decode(ids)] if tokens else [])

    return tidy(lambda batches: rows_to_batches(documents(batches), schema, lambda row: 32 + sum(map(len, row[2:]))))


def _table(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a block's words, and where each slot's ids start and how many they are."""
    n = sum(len(slots) for slots, _, _ in parts)
    starts, lengths, base = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for slots, counts, flat in parts:
        starts[slots] = base + np.cumsum(counts, dtype=np.int64) - counts
        lengths[slots] = counts
        base += len(flat)
    return (np.concatenate([flat for _, _, flat in parts]) if parts else np.empty(0, np.uint32)), starts, lengths


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, buckets: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, n_tokens long, ids binary [, decoded binary]) for every row of docs; ids
    are little-endian unsigned 32-bit numbers.

    A null or empty text has no ids. Each row is encoded by itself: repeated rows and
    repeated or null ids give a row each. Other columns are not read. An empty table
    gives an empty table. Documents are dealt to blocks by input partition, so the
    input should be a scan or a written table, which a retry reads in the same order.
    buckets follow the number of input partitions unless given.
    decoded adds what the ids decode to, by the token-byte table, in the task that has
    put them together.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text__"), F.spark_partition_id().alias("part__"))
    buckets = buckets or min(MAX_BUCKETS, max(BUCKETS, PARTITION_BUCKETS * source._jdf.queryExecution().toRdd().getNumPartitions()))
    kind = source.schema[0].dataType
    packed, ddl = _schema(to_arrow_type(kind)), _ROW.format(id=kind.simpleString())
    ranks = load_ranks(vocabulary)
    shared = spark.sparkContext.broadcast(ranks)
    tokens = spark.sparkContext.broadcast(TokenTable(ranks)) if decoded else None
    exploded = lambda kind: source.mapInArrow(_explode(kind, pattern, buckets, block_bytes, packed), ddl)
    encoded = exploded(WORDS).repartition("key").sortWithinPartitions("key").mapInArrow(_encode_words(pattern, shared, packed), ddl)
    more = [("decoded", pa.binary())] if decoded else []
    result = pa.schema([(id_col, to_arrow_type(kind)), ("n_tokens", pa.int64()), ("ids", pa.binary()), *more])
    columns = f"`{id_col}` {kind.simpleString()}, n_tokens bigint, ids binary" + (", decoded binary" if decoded else "")
    return encoded.unionByName(exploded(DOCS)).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_reassemble(result, tokens), columns)


def token_table(spark: SparkSession, vocabulary: str) -> DataFrame:
    """(id, token binary) of a rank file."""
    return spark.createDataFrame([(rank, bytearray(token)) for token, rank in load_ranks(vocabulary).items()], "id bigint, token binary")


def decode_documents(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with out_col binary: the bytes of its ids' tokens, joined.

    Null ids give null, no ids give no bytes; an id that the table lacks fails. The
    token-byte table (bounded by MAX_VOCABULARY_BYTES) is broadcast and joined to the
    ids by number, a column of documents at a time.
    """
    tokens = encoded.sparkSession.sparkContext.broadcast(TokenTable(load_ranks(vocabulary)))

    @F.pandas_udf("binary")
    def decode(column):
        return column.map(lambda ids: None if ids is None else tokens.value.decode(np.frombuffer(ids, "<u4")))

    return encoded.withColumn(out_col, decode(F.col(ids_col)))
