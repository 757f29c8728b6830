"""SimHash, components, and the near-duplicate groups."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.components import connected_components


def brute_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    ids = {i for i, _ in prints if i is not None}
    links = [(a, b) for a, x in prints for b, y in prints if a is not None and b is not None and a < b and (x ^ y).bit_count() <= 4]
    root = brute_components(ids, links)
    expected = sorted((f"{x:016x}", -1 if i is None else i, -1 if i is None else root[i]) for i, x in prints)
    got = simhash.simhash_components(df)
    assert sorted((r["fingerprint"], -1 if r["doc_id"] is None else r["doc_id"], -1 if r["component_id"] is None else r["component_id"]) for r in got.collect()) == expected


def test_against_brute_force(documents):
    check(documents)


def test_odd_rows(odd):
    check(odd)


def test_empty(empty):
    assert simhash.simhash_components(empty).collect() == []
    assert simhash.near_duplicate_groups(empty).collect() == []


def test_links_of_random_fingerprints(spark):
    """Planted pairs at every distance, a large tight group and random rest: no link lost."""
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(400)}
    for v in list(values)[:60]:
        for distance in (1, 3, 4, 5):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), distance)))
    centre = rng.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(700)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame([(v,) for v in signed], "node long").withColumn("f", F.col("node"))
    links = simhash.near_links(nodes, ["f"], [4], 7)
    assert links.count() < 5 * len(signed)
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    array = np.array(signed, np.int64).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 4
    expected = brute_components(signed, [(signed[i], signed[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)])
    assert {v: found.get(v, v) for v in signed} == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (100, 101)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicate_groups(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    rows, expected = [], {}
    for g in range(40):
        words = rng.choices(vocabulary, k=400)
        for copy in range(3):
            text = list(words)
            for at in rng.sample(range(400), 0 if copy < 2 else 3):  # Jaccard of five-word shingles near 0.93
                text[at] = rng.choice(vocabulary)
            rows.append((3 * g + copy, " ".join(text)))
            expected[3 * g + copy] = 3 * g
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = simhash.near_duplicate_groups(docs)
    found = {r["doc_id"]: r["group_id"] for r in groups.collect()}
    assert sum(found[i] == expected[i] for i in expected) >= 0.97 * len(expected)
    assert all(found[i] // 3 == i // 3 for i in found)
    assert simhash.keep_one_per_group(docs, groups).count() == len(set(found.values()))


def test_keep_one_per_group_of_odd_rows(odd):
    kept = simhash.keep_one_per_group(odd, simhash.near_duplicate_groups(odd))
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and ids.count(None) == 1 and 7 not in ids and 6 in ids
    assert kept.columns == odd.columns


def shingle_similarity(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


def test_near_copies_with_a_passage_added_or_cut(spark):
    """Copies of similarity 0.80 to 0.90 that differ in one passage, of other words, at either end."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    other = ["".join(rng.choices("qrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for g in range(120):
        words = rng.choices(vocabulary, k=rng.randint(150, 1200))
        n = len(words) * rng.randint(11, 23) // 100
        passage = rng.choices(other, k=n)
        copy = (words + passage, passage + words, words[: len(words) - 4 * n // 5])[g % 3]
        assert 0.8 <= shingle_similarity(words, copy) <= 0.92
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
    found = {r["doc_id"]: r["group_id"] for r in simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[2 * g] == 2 * g for g in range(120))
    assert sum(found[2 * g + 1] == 2 * g for g in range(120)) >= 119


def test_texts_below_the_limit_stay_apart(spark):
    """Copies of similarity 0.60 to 0.79 by scattered edits are no near copies, alone or as a chain."""
    rng = random.Random(13)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    rows = []
    for g in range(40):
        words = rng.choices(vocabulary, k=400)
        for copy in range(3):
            rows.append((3 * g + copy, " ".join(words)))
            edited = list(words)
            while shingle_similarity(words, edited) > 0.78:
                edited[rng.randrange(400)] = rng.choice(vocabulary)
            assert shingle_similarity(words, edited) >= 0.6
            words = edited
    groups = simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(groups) == len(rows) and all(r["doc_id"] == r["group_id"] for r in groups)
