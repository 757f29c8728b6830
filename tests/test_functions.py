import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import labels, similarity, text


def one(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Foo & Co. KG", "foo and"),
        ("SA", ""),
        ("Sp. z o.o.", "sp z o o"),
        ("Ørsted A/S", "rsted a s"),
        ("A–C", "ac"),
        ("Université de León GmbH Ltd", "universite de leon"),
        ("Αθήνα", ""),
        (None, ""),
        ("  ", ""),
        ("½ cup", "12 cup"),
        ("ﬁrm", "firm"),
    ],
)
def test_normalize_name(spark, raw, expected):
    assert one(spark, raw, text.normalize_name) == expected


@pytest.mark.parametrize(("raw", "expected"), [("b a b", "a b b"), ("", ""), (None, "")])
def test_token_sort_key(spark, raw, expected):
    assert one(spark, raw, text.token_sort_key) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("https://www.Example.org:80/path", "example.org"),
        ("user:pw@host.org", "host.org"),
        ("example.org.", "example.org"),
        ("mailto:x@y.z", "y.z"),
        ("//c.d", "//c.d"),
        ("www.www.a.b", "www.a.b"),
        ("http://a.b?q=1", "a.b"),
        ("", ""),
        (None, ""),
        ("  ", ""),
    ],
)
def test_normalize_domain(spark, raw, expected):
    assert one(spark, raw, text.normalize_domain) == expected


@pytest.mark.parametrize(("raw", "expected"), [("https://ror.org/01ggx4157/", "01ggx4157"), ("01ABC", "01ABC"), (None, ""), ("///", "")])
def test_short_ror_id(spark, raw, expected):
    assert one(spark, raw, text.short_ror_id) == expected


def test_identifiers(spark):
    assert one(spark, "123456789", text.classify_provided_id) == "ror"
    assert one(spark, "edmo:12", text.classify_provided_id) == "edmo"
    assert one(spark, " ", text.classify_provided_id) == "none"
    assert one(spark, "12345678A", text.classify_provided_id) == "other"
    assert one(spark, "123456789\n", text.looks_like_ror_id) is False
    assert one(spark, " 0000 0001 ", lambda c: text.normalize_identifier("isni", c)) == "00000001"
    assert one(spark, " Grid.1 ", lambda c: text.normalize_identifier("grid", c)) == "grid.1"


def test_titles_and_json(spark):
    assert one(spark, '{"de": "x", "en": "y"}', text.localized_title) == "y"
    assert one(spark, '{"de": "x"}', text.localized_title) == "x"
    assert one(spark, " plain ", text.localized_title) == "plain"
    assert one(spark, '["a", null, "b"]', text.json_strings) == ["a", "b"]
    assert one(spark, "nonsense", text.json_strings) == []
    assert one(spark, None, text.json_strings) == []


def test_meaningful(spark):
    for name, alias, fuzzy in (("", False, False), ("university", False, False), ("abc", False, False), ("abcd", True, False), ("abcdefgh", True, True), ("a b", True, True), ("gmbh", False, False)):
        assert one(spark, name, text.is_meaningful_alias) is alias
        assert one(spark, name, text.is_meaningful_fuzzy) is fuzzy


def test_block_keys(spark):
    assert set(one(spark, "university of x", text.fuzzy_block_keys)) == {"compact:univer", "first:univ", "last:x"}
    assert one(spark, "", text.fuzzy_block_keys) == []


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc ", k=rng.randrange(0, 90))) for _ in range(2))
        assert similarity.common_subsequence(a, b) == brute_lcs(a, b)


def test_similarity_scores(spark):
    assert similarity.ratio("abc", "abc") == 100
    assert similarity.token_sort_ratio("b a", "a b") == 100
    assert similarity.token_set_ratio("university of x", "university of x campus") == 100
    assert similarity.token_set_ratio("", "x") == 0
    assert math.isclose(similarity.ratio("abcd", "abce"), 75)
    row = spark.createDataFrame([("a b", "b a")], "a string, b string").select(similarity.similarity("a", "b").alias("s")).first()["s"]
    assert row["token_sort"] == 100 and row["ratio"] < 100


def test_bounds_lose_no_pair(spark):
    """Whatever reaches the threshold passes the letter masks and the bound."""
    from tessera.operators import fuzzy

    rng = random.Random(7)
    words = ["university", "of", "x", "lab", "labs", "alpha", "alpah", "institute", "a", "b1", "b2"]
    pairs = [(" ".join(rng.choices(words, k=rng.randint(1, 6))), " ".join(rng.choices(words, k=rng.randint(1, 6)))) for _ in range(4000)]
    best = lambda a, b: max(similarity.ratio(a, b), similarity.token_sort_ratio(a, b), similarity.token_set_ratio(a, b))
    good = {(a, b) for a, b in pairs if best(a, b) >= 95}
    assert len(good) > 20 and similarity.may_reach(*map(pd.Series, zip(*sorted(good), strict=True)), 95.0).all()
    assert not similarity.may_reach(*map(pd.Series, zip(*pairs, strict=True)), 95.0).all()
    left = spark.createDataFrame([(a, "c") for a, _ in pairs], "normalized string, country string")
    right = spark.createDataFrame([(b, "c") for _, b in pairs], "target_normalized string, country string")
    every = {(r[0], r[2]) for r in fuzzy.blocked_pairs(left, right).collect()}
    kept = {(r[0], r[2]) for r in fuzzy.blocked_pairs(left, right, 95.0).collect()}
    assert kept <= every and all(p in kept for p in every if best(*p) >= 95)


def test_best_unique_match_against_brute_force(spark):
    """All pairs that share a country and a block, scored one by one; a lead of five points."""
    from tessera.operators import fuzzy

    rng = random.Random(9)
    words = ["university", "institute", "alpha", "alphas", "northern", "center", "centre", "labs", "of", "x1"]
    name = lambda: " ".join(rng.choices(words, k=rng.randint(2, 5)))
    targets = [(c, name(), f"r{k}") for k, c in enumerate(rng.choices("AB", k=60))]
    records = [(f"o{k}", 0, n, n, rng.choice("AB")) for k in range(60) for n in [name()]]
    left = spark.createDataFrame(records, "record string, position int, raw string, normalized string, country string")
    right = spark.createDataFrame([(*t, t[1]) for t in targets], "country string, target_normalized string, ror_id string, target_name string")
    scores = lambda a, b: (similarity.ratio(a, b), similarity.token_sort_ratio(a, b), similarity.token_set_ratio(a, b))
    keys = lambda n: {n.replace(" ", "")[:6], "f" + n.split()[0][:4], "l" + n.split()[-1][:4]}
    near = {(n, c, t) for *_, n, c in records for d, t, _ in targets if c == d and keys(n) & keys(t) and max(scores(n, t)) >= 95}
    every = 1000  # more than a name has targets, so that no scorer leaves one out
    found = fuzzy.scored_pairs(fuzzy.blocked_pairs(left, right, 95.0), limit=every)
    assert near and {tuple(r)[:3] for r in found.collect()} == near
    expected = {}
    for record, _, _, n, c in records:
        best = {}
        for d, t, ror in targets:
            if (n, c, t) in near and d == c:
                best[ror] = max(best.get(ror, 0), round(max(scores(n, t)), 1))
        ranked = sorted(best.values(), reverse=True)
        if ranked and (len(ranked) == 1 or ranked[0] - ranked[1] >= 5):
            expected[record] = max(best, key=best.get)
    got = {r["record"]: r["ror_id"] for r in fuzzy.best_unique_match(left, right, limit=every).collect()}
    assert got == expected and got


def test_round_tenth(spark):
    rows = spark.createDataFrame([(0.15,), (62.25,), (None,)], "x double").select(similarity.round_tenth("x").alias("y")).collect()
    assert [r["y"] for r in rows] == [0.1, 62.2, None]


def test_labels(spark):
    assert one(spark, "direct_unique", lambda c: labels.lookup(c, labels.RULES)) == "direct ROR link in OpenAIRE"
    assert one(spark, "some_new_code", lambda c: labels.lookup(c, labels.RULES)) == "some new code"
    assert one(spark, "openaire:direct_unique", labels.supporter_label) == "OpenAIRE: direct ROR link in OpenAIRE"
