"""SimHash near-duplicate search by pigeonhole blocks.

A 64-bit fingerprint is cut into `blocks` ranges of bits. Two fingerprints that
differ in at most `radius` bits agree on at least `blocks - radius` of the ranges,
so they share the key of at least one such choice of ranges. Distinct fingerprints
are exploded into these keys, sorted by key, and every run of equal keys is
verified by Hamming distance.

A run never emits all its pairs: it emits a spanning forest of its links, which
keeps every component whole while a group of thousands of near copies costs about
as many rows as it has members. Copies with equal fingerprints are collapsed before
the keys are made.

Near-duplicate groups (near_duplicate_groups) are of texts that share 0.8 of their shingles
or more. Such texts differ in up to 15 % of the bits, too many for 64 bits and whole choices
of ranges: their fingerprints are wider, and cut into so many blocks that a pair at the
limit shares one almost surely. Hamming distance verifies, and every link is counted exactly.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged, tidy
from tessera.llm.components import connected_components

SEED = 42
#: Shingle hashes whose bits are counted at once, so that a very long text stays small in memory.
BITS_AT_ONCE = 1 << 16
#: Runs up to this long are compared as one matrix.
MATRIX_RUN = 256
#: Parts in which the members of a component meet its smallest id.
SALTS = 64
#: Part of the bits in which texts differ that share 0.8 of their shingles: their angle is
#: acos(2 * 0.8 / 1.8) where they are of one size, less where they aren't.
LIMIT_BITS = math.acos(2 * 0.8 / 1.8) / math.pi
#: Part of such pairs that share a block, and unrelated texts a value of a block.
RECALL, CHANCE_ROWS = 0.98, 128
#: Bits of a wide fingerprint at least, so that the distance of all of them tells pairs apart.
LEAST_BITS = 1024
#: Members of a run that meet all others first.
HEADS = 4
#: What a hash is mixed with for each word of a wide fingerprint, up to 65,536 bits.
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 64, (2, 1024), np.uint64)
_FACTORS, _TERMS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes.split cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of `size` words joined by single spaces, repeats included;
    a shorter text is one shingle, a text without words has none."""
    if not words:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(whole, SEED)], np.uint64)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(whole[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :], strict=False)], np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each distinct word."""
    return np.array([xxhash.xxh64_intdigest(w, SEED) for w in set(words)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes give zero. Signed, for a long."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BITS_AT_ONCE):
        part = np.ascontiguousarray(hashes[at : at + BITS_AT_ONCE], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id_col, fingerprint long) for every row of docs.

    A null or empty text has fingerprint zero. Other columns are not read, so they
    may have any names.
    """
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text__"))
    kind = source.schema[0].dataType
    ddl = f"`{id_col}` {kind.simpleString()}, fingerprint bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(words_of(text.as_py()), shingle)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=[id_col, "fingerprint"])

    return source.mapInArrow(tidy(run), ddl)


def block_masks(blocks: int, radius: int) -> list[int]:
    """Masks of all choices of blocks - radius bit ranges out of `blocks`, as signed longs."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    ranges = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(ranges, blocks - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _forest(run: np.ndarray, near) -> Iterator[tuple[int, np.ndarray]]:
    """Links (i, several j) that join each component of a run: breadth-first search that
    compares a reached row with the rows not yet reached only."""
    left = np.arange(len(run))
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            hit = near(run[at], run[left])
            if hit.any():
                found, left = left[hit], left[~hit]
                yield at, found
                reached.extend(found)


def run_links(rows: np.ndarray, radii: tuple[int, ...]) -> np.ndarray:
    """Links within one run of equal keys; rows[:, k] is fingerprint k (unsigned) and
    radii[k] its largest distance. Returns pairs of row numbers: all links of a short
    run, or a spanning forest of them."""

    def near(one, many):
        ok = np.bitwise_count(one[0] ^ many[:, 0]) <= radii[0]
        for k in range(1, len(radii)):
            ok &= np.bitwise_count(one[k] ^ many[:, k]) <= radii[k]
        return ok

    n = len(rows)
    if n <= MATRIX_RUN:
        ok = np.bitwise_count(rows[:, None, 0] ^ rows[None, :, 0]) <= radii[0]
        for k in range(1, len(radii)):
            ok &= np.bitwise_count(rows[:, None, k] ^ rows[None, :, k]) <= radii[k]
        i, j = np.nonzero(np.triu(ok, 1))
        if len(i) <= 2 * n:
            return np.stack([i, j], axis=1)
    links = [np.stack([np.full(len(js), i), js], axis=1) for i, js in _forest(rows, near)]
    return np.concatenate(links) if links else np.empty((0, 2), np.int64)


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Whole runs of equal (choice, key) from sorted batches, with the node number and
    the fingerprints of their rows. What is held is 8 bytes a number of one run."""
    held: list[np.ndarray] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(width)], axis=1)
        change = np.flatnonzero((table[1:, :2] != table[:-1, :2]).any(axis=1)) + 1
        parts = np.split(table, change)
        for part in parts:
            key = (part[0, 0], part[0, 1])
            if key != last and held:
                yield np.concatenate(held)
                held = []
            held.append(part)
            last = key
    if held:
        yield np.concatenate(held)


def near_links(nodes: DataFrame, columns: list[str], radii: list[int], blocks: int) -> DataFrame:
    """Links (a, b) between rows of nodes(node, *columns) whose columns[k] differ in
    at most radii[k] bits, for all k; enough of them to keep every component whole.

    Blocks are taken from columns[0]. A key held by a single node is dropped in the
    JVM, before anything reaches Python.
    """
    masks = block_masks(blocks, radii[0])
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col(columns[0]).bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])).alias("key")
    spread = nodes.select("node", *columns, keys).select("key.choice", "key.part", "node", *columns)
    shared = spread.withColumn("n__", F.count("*").over(Window.partitionBy("choice", "part"))).where("n__ > 1").drop("n__")
    width, limits = 3 + len(columns), tuple(radii)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, width):
            links = run_links(rows[:, 3:].view(np.uint64), limits)
            if len(links):
                yield pa.RecordBatch.from_arrays([pa.array(rows[links[:, 0], 2]), pa.array(rows[links[:, 1], 2])], names=["a", "b"])

    return shared.mapInArrow(tidy(run), "a bigint, b bigint").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 7) -> DataFrame:
    """(id_col, fingerprint string, component_id) for every row of docs.

    component_id is the smallest id reachable over links of at most `radius` differing
    bits. Texts without words share fingerprint zero, which links like any other.
    Rows that repeat an id keep a row each. A row with a null id keeps its
    fingerprint, takes no part in components, and has a null component_id.
    """
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    held = prints.where(F.col(id_col).isNotNull()).groupBy("fingerprint").agg(F.min(id_col).alias("low__"))
    nodes = held.select(F.col("fingerprint").alias("node"), "fingerprint")
    roots = connected_components(near_links(nodes, ["fingerprint"], [radius], blocks))
    # only fingerprints with a link have a root; a large component's members meet it in SALTS parts
    members = held.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint")
    smallest = members.groupBy("root").agg(F.min("low__").alias("component_id"))
    salted = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = members.withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"])
    linked = joined.select("fingerprint", "component_id")
    named = linked.unionByName(held.join(roots.select(F.col("node").alias("fingerprint")), "fingerprint", "left_anti").select("fingerprint", F.col("low__").alias("component_id")))
    return prints.join(named, "fingerprint", "left").select(
        id_col,
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"),
    )


def block_plan(n: int) -> tuple[int, int]:
    """(blocks, bits a block) of the wide fingerprints of n texts.

    A block gains a bit with each doubling of the corpus, so that its values are shared by
    CHANCE_ROWS unrelated texts on average at every size; there are as many blocks as let a
    pair at the limit share one with a probability of RECALL. Their number, and with it the
    comparisons a text, grows with n ** 0.23, not with n.
    """
    bits = max(4, math.ceil(math.log2(max(n, 2) / CHANCE_ROWS)))
    return math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - LIMIT_BITS) ** bits)), bits


def wide_fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """SimHash of 64 * words bits: each hash is mixed with a number a word, and a bit is 1 if
    it is set in over half of what comes out. As signed longs."""
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), 255):
        mixed = (hashes[at : at + 255, None] ^ _TERMS[:words]) * _FACTORS[:words]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        bits = np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(len(mixed), -1), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")


def wide_prints(docs: DataFrame, id_col: str, text_col: str, shingle: int, words: int) -> DataFrame:
    """(id_col, digest of the words, n distinct shingles, wide array<bigint>) for every row of docs."""
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text__"))
    ddl = f"`{id_col}` {source.schema[0].dataType.simpleString()}, digest binary, n int, wide array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, wide = [], [], []
            for text in batch.column(1):
                found = words_of(text.as_py())
                hashes = np.unique(shingle_hashes(found, shingle))
                digests.append(hashlib.blake2b(b" ".join(found), digest_size=16).digest())
                sizes.append(len(hashes))
                wide.append(wide_fingerprint(hashes, words))
            columns = [pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(wide, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "digest", "n", "wide"])

    return source.mapInArrow(tidy(run), ddl)


def block_rows(held: DataFrame, blocks: int, bits: int) -> DataFrame:
    """(key, node, f0, f1): a row a block of held(node, n, wide); f0 and f1 are the first 128
    bits. Texts without shingles have none."""
    powers = 1 << np.arange(bits, dtype=np.int64)
    kind = held.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = np.ascontiguousarray(batch.column(1).flatten().to_numpy(), "<i8").reshape(batch.num_rows, -1)
                cut = np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")[:, : blocks * bits].reshape(-1, blocks, bits)
                keys = (cut @ powers) | (np.arange(blocks, dtype=np.int64) << bits)
                first = rows[:, :2]
                nodes = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), blocks)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), nodes, *(pa.array(np.repeat(first[:, k], blocks)) for k in (0, 1))], names=["key", "node", "f0", "f1"])

    return held.where("n > 0").select("node", "wide").mapInArrow(tidy(run), f"key bigint, node {kind}, f0 bigint, f1 bigint")


def radius_of(bits: int, deviations: float) -> int:
    """Bits in which pairs at the limit differ, with so many standard deviations added."""
    return math.ceil(bits * LIMIT_BITS + deviations * math.sqrt(bits * LIMIT_BITS * (1 - LIMIT_BITS)))


def _differ(left: list[str], right: list[str]) -> Column:
    """Bits in which longs differ."""
    return reduce(Column.__add__, [F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(left, right, strict=True)])


def _meet(rows: DataFrame, heads: DataFrame, also: Column | None = None) -> DataFrame:
    """(node, node_h, far): pairs of rows and heads(key, node, w0, w1, ...) that share a key and
    whose whole fingerprints are within the radius, far bits apart."""
    words = [c for c in rows.columns if re.fullmatch(r"w\d+", c)]
    heads = heads.select("key", *[F.col(c).alias(f"{c}_h") for c in heads.columns if c != "key"])
    far = _differ(words, [f"{w}_h" for w in words])
    met = rows.join(heads, "key").where((F.col("node") != F.col("node_h")) & (far <= radius_of(64 * len(words), 2)))
    return (met if also is None else met.where(also)).select("node", "node_h", far.alias("far"))


def _nearest(met: DataFrame) -> DataFrame:
    """Each node's pair with the nearest, as (a < b)."""
    best = met.groupBy("node").agg(F.min(F.struct("far", "node_h")).alias("best")).select("node", "best.node_h")
    return best.select(F.least("node", "node_h").alias("a"), F.greatest("node", "node_h").alias("b")).distinct()


def _alike(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Pairs (a, b) whose texts(node, text) share at least `least` of their shingles, counted
    exactly. The larger ends' texts travel to the smaller ends: the end of many pairs is the
    smallest of its group, whose own text is then not repeated in a shuffle."""
    sides = {x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b")}
    both = pairs.select("a", "b").join(sides["b"], "b").join(sides["a"], "a").select("a", "b", "text_a", "text_b")
    kind = both.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(None, None), (None, None)]
        for batch in batches:
            near = []
            for row in range(batch.num_rows):
                for side in (0, 1):
                    text = batch.column(2 + side)[row].as_py()
                    if held[side][1] is None or text != held[side][0]:
                        held[side] = (text, np.unique(shingle_hashes(words_of(text), shingle)))
                x, y = held[0][1], held[1][1]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                near.append(shared > 0 and shared / (len(x) + len(y) - shared) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(tidy(run), f"a {kind}, b {kind}").distinct()


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """(id_col, group_id) for every row of docs with an id; group_id is the smallest id
    of its group of near copies.

    Two texts are near copies if they share `least` or more of their distinct shingles of
    `shingle` words; groups are the components of such pairs. Texts of equal words collapse
    first, so repeated rows and exact copies are one text. Null and empty texts are copies of
    each other and of nothing else. An empty table gives an empty table.

    The wide fingerprint is cut into blocks (block_plan). Texts that share a block are
    compared by Hamming distance where they meet, on 128 bits first: a semi join keeps a
    block's row only if another one of its value is near, and emits no pairs. What is left is
    compared on whole fingerprints, and pairs near in all bits are counted exactly before they
    link. A pair at the limit shares a block with a probability of RECALL, and is near with one
    of 0.98 (2 standard deviations); closer pairs soon with certainty. LIMIT_BITS belongs to
    `least` of 0.8.

    In a run of one block's value up to HEADS members meet all others first, and every text's
    nearest of those is counted. After that, members whose group isn't that of the run's smallest
    id meet all members of other groups: each pair of a run is compared, or lies within one
    group. Of the near pairs so found, again each text's nearest is counted first, and then those
    whose groups still differ. All is joins that AQE splits and partial aggregation, without a
    window or a sort of a whole run, so that one value may belong to a third of all texts.
    """
    blocks, bits = block_plan(docs.count())
    words = max(-(-blocks * bits // 64), LEAST_BITS // 64)
    prints = staged(wide_prints(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle, words), "prints")
    held = staged(prints.groupBy("digest").agg(F.min(id_col).alias("node"), F.first("n").alias("n"), F.first("wide").alias("wide")), "distinct")
    sources = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    counted, links, roots = [], [], None

    def count(pairs: DataFrame) -> None:
        """Count pairs exactly, and take up the links found."""
        nonlocal roots
        pairs = staged(pairs, "pairs")
        needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        counted.append(pairs)
        links.append(staged(_alike(pairs, sources.join(needed, "node", "left_semi"), shingle, least), "links"))
        roots = staged(connected_components(reduce(DataFrame.unionByName, links)), "roots")

    def rooted(rows: DataFrame, column: str, name: str) -> DataFrame:
        known = roots.select(F.col("node").alias(column), F.col("root").alias(name))
        return rows.join(known, column, "left").withColumn(name, F.coalesce(name, column))

    rows = block_rows(held, blocks, bits)
    others = rows.select(*[F.col(c).alias(f"{c}_h") for c in rows.columns])
    near = (F.col("key") == F.col("key_h")) & (F.col("node") != F.col("node_h")) & (_differ(["f0", "f1"], ["f0_h", "f1_h"]) <= radius_of(128, 3.5))
    near_rows = staged(rows.join(others, near, "left_semi").select("key", "node"), "near_rows")
    prints_of = held.select("node", *[F.get("wide", F.lit(k)).alias(f"w{k}") for k in range(words)])
    rows = staged(near_rows.join(prints_of, "node"), "rows")
    heads = near_rows.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(HEADS)).alias("part")).agg(F.min("node").alias("node"))
    first = staged(heads, "heads")
    met = staged(_meet(rows, first.select("key", "node").join(prints_of, "node")), "met")
    count(_nearest(met))
    leads = rooted(first.groupBy("key").agg(F.min("node").alias("lead")), "lead", "lead_root").select("key", "lead_root")
    members = rooted(rows, "node", "root").join(leads, "key")
    # a pair is made by the first block that both share; of two members that both lie outside
    # the lead's group, the smaller meets the larger
    keys = near_rows.groupBy("node").agg(F.collect_list("key").alias("keys"))
    members = members.join(keys, "node")
    once = (F.col("root") != F.col("root_h")) & ((F.col("root") == F.col("lead_root")) | (F.col("node") < F.col("node_h")))
    once = once & (F.array_min(F.array_intersect("keys", "keys_h")) == F.col("key"))
    met = staged(_meet(members, members.where("root != lead_root").drop("lead_root"), once), "met")
    count(_nearest(met))
    pairs = met.select(F.least("node", "node_h").alias("a"), F.greatest("node", "node_h").alias("b")).distinct()
    apart = rooted(rooted(pairs, "a", "root_a"), "b", "root_b").where("root_a != root_b").select("a", "b")
    for done in counted:
        apart = apart.join(done, ["a", "b"], "left_anti")
    count(apart)
    named = rooted(held.select("digest", "node"), "node", "group_id")
    return prints.join(named.select("digest", "group_id"), "digest").select(id_col, "group_id")


def keep_one_per_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that are the smallest id of their group, unchanged. If rows repeat an
    id with equal contents one of them stays. Rows with a null id stay, but of those that are
    equal in all columns one does."""
    gone = groups.where(F.col(id_col) != F.col("group_id")).select(id_col).distinct()
    repeated = groups.groupBy(id_col).count().where("count > 1").select(id_col)
    named = docs.where(F.col(id_col).isNotNull()).join(gone, id_col, "left_anti").select(docs.columns)
    nameless = docs.where(F.col(id_col).isNull()).dropDuplicates()
    if repeated.isEmpty():
        return named.unionByName(nameless)
    once = named.join(repeated, id_col, "left_semi").select(docs.columns).dropDuplicates()
    return named.join(repeated, id_col, "left_anti").select(docs.columns).unionByName(once).unionByName(nameless)
