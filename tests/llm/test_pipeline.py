"""Each stage of the pipeline against a brute-force version, on its own input."""

import base64
import collections
import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as cp
from tests.llm.test_operators import brute_measure, fill

DATA = "/root/testdata/sf0.001"


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """(input, output) of each stage, as lists of rows."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), documents, []
    for k, (_, stage) in enumerate(cp.STAGES):
        result = stage(spark, docs, DATA)
        assert k == 4 or result.columns == cp.COLUMNS
        result.write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_names():
    assert [name for name, _ in cp.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "mix to weights", "byte-level bpe"]


def test_quality(stages):
    before, after = stages[0]
    measured = {r["doc_id"]: (r["source"], brute_measure(r["text"])) for r in before}

    def base(m):
        return m[0] < 50 or 100 * m[5] > 50 * m[0]

    def soft(m, slack):
        words, chars, symbols, dup, lines, _ = m
        return symbols * 100 > words * 20 * slack or dup * 100 > lines * 30 * slack or chars * slack < words * 2 or chars > words * 15 * slack

    hosts = collections.defaultdict(list)
    for source, m in measured.values():
        hosts[source].append(base(m) or soft(m, 1.0))
    n, bad = len(measured), sum(map(sum, hosts.values()))
    mean = bad / n
    square = sum(len(x) * (sum(x) / len(x)) ** 2 for x in hosts.values()) / n
    between = square - mean**2 - mean * (1 - mean) * len(hosts) / n
    strength = max(mean * (1 - mean) / between - 1, 2.0) if between > 0 else max(n / len(hosts), 2.0)
    rate = {h: (sum(x) + mean * strength) / (len(x) + strength) for h, x in hosts.items()}
    kept = {i for i, (h, m) in measured.items() if not base(m) and rate[h] < 0.95 and not soft(m, 1.0 if rate[h] >= 0.5 else 1.5)}
    assert collections.Counter(after) == collections.Counter(r for r in before if r["doc_id"] in kept)


def test_lines(stages):
    before, after = stages[1]
    lines = collections.Counter((r["source"], x) for r in before for x in set(r["text"].split("\n")) if x.strip())
    pages = collections.Counter(r["source"] for r in before)
    boiler = {k for k, n in lines.items() if n >= 5 and n > 0.1 * pages[k[0]]}
    expected = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if (r["source"], x) not in boiler) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_duplicates(stages):
    """Components of all pairs that share 0.8 or more of their distinct five-word shingles."""
    before, after = stages[2]
    shingles = {}
    for r in before:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        shingles[r["doc_id"]] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in shingles}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(shingles)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(shingles[a] & shingles[b])
            if shared >= 0.8 * (len(shingles[a]) + len(shingles[b]) - shared):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    expected = [r for r in before if find(r["doc_id"]) == r["doc_id"]]
    assert len(expected) < len(before) and collections.Counter(after) == collections.Counter(expected)


def test_mix(stages):
    before, after = stages[3]
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in before}
    domain = lambda r: ["web", "forum", "news", "reference"][int(hashlib.md5((r["source"] or "").encode()).hexdigest()[0], 16) % 4]
    leaves = collections.defaultdict(list)
    for r in before:
        leaves[(domain(r), r["lang"] or "", r["source"] or "")].append(r["doc_id"])
    tokens = {leaf: sum(words[i] for i in ids) for leaf, ids in leaves.items()}
    total = sum(tokens.values())
    budget = total * 80 // 100
    of = lambda *key: sum(t for leaf, t in tokens.items() if leaf[: len(key)] == key)
    by_size = lambda own, whole, given: own if whole <= given else own * given // max(whole, 1)
    expected = set()
    for d in {leaf[0] for leaf in leaves}:
        d_share = by_size(of(d), total, budget)
        langs = fill({k: (cp.WEIGHTS["lang"].get(k, 1), of(d, k)) for k in {leaf[1] for leaf in leaves if leaf[0] == d}}, d_share)
        for leaf, ids in leaves.items():
            if leaf[0] == d:
                left = by_size(tokens[leaf], of(d, leaf[1]), langs[leaf[1]])
                if left == tokens[leaf]:
                    expected |= set(ids)
                    continue
                for i in sorted(ids, key=lambda i: (hashlib.md5(f"42:0:{i}".encode()).hexdigest(), i)):
                    left -= words[i]
                    if left < 0:
                        break
                    expected.add(i)
    assert collections.Counter(after) == collections.Counter(r for r in before if r["doc_id"] in expected)
    assert 0 < sum(words[r["doc_id"]] for r in after) <= budget


def test_bpe(stages):
    before, after = stages[4]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for r in before:
        ids = encoding.encode_ordinary(r["text"])
        expected.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(expected)


def test_mix_reaches_its_weights(spark):
    """On more documents: languages within 0.04 of their target shares."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken = cp.mix(spark, docs, DATA).collect()
    words = collections.Counter()
    for r in taken:
        words[r["lang"]] += len((r["text"] or "").split())
    target = cp.WEIGHTS["lang"]
    reached = {k: words[k] / sum(words.values()) for k in target}
    assert all(abs(reached[k] - w / sum(target.values())) < 0.04 for k, w in target.items()), reached


def test_run_leaves_its_result_only(spark):
    """run() gives what the stages give one by one, and clears what they left."""
    import os

    from tessera.llm.common import shared_dir

    folder = f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder))
    out = cp.run(spark, DATA)
    assert len(set(os.listdir(folder)) - before) == 1
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_odd_rows(spark, odd):
    """Null ids and texts, repeated rows and clashing names, each stage on the same odd table."""
    quality, lines, near, mix, bpe = (stage(spark, odd, DATA) for _, stage in cp.STAGES)
    assert all(df.columns == cp.COLUMNS for df in (quality, lines, near, mix))
    assert quality.collect() == []  # each of the odd texts is short or repeats itself
    assert rows(lines.select("doc_id", "lang", "source")) == rows(odd.select("doc_id", "lang", "source"))
    assert all((r["n_chars"] is None) == (r["text"] is None) for r in lines.collect())
    ids = collections.Counter(r["doc_id"] for r in near.collect())
    assert ids[4] == 1 and ids[None] == 1 and ids[7] == 0 and ids[0] == 1 and ids[1] == 0  # null and empty texts are copies
    assert not rows(mix) - rows(odd.select(cp.COLUMNS))
    assert rows(bpe.select("doc_id")) == rows(odd.select("doc_id"))
    assert all(r["n_tokens"] == 0 for r in bpe.where("doc_id in (0, 1)").collect())


def test_empty_table(spark, empty, tmp_path):
    docs = empty
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.collect() == []
