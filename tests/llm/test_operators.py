"""Mixing, top-k, licenses, lines, quality, language and toxicity."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import host_quality, langid, license_scan, line_dedup, mixing, queries, topk, toxicity
from tessera.llm.sql import ORACLES

DATA = "/root/testdata/sf0.01"


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    found = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = con.execute(ORACLES[name])
    names = [x[0] for x in cursor.description]
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(names) == columns
    assert sorted(found, key=str) == sorted(expected, key=str)


# --- mixing -----------------------------------------------------------------


def fill(children, budget):
    """Water filling: {name: (weight, capacity)} by repeated shares."""
    out, left, rest = {}, budget, dict(children)
    while rest:
        total = sum(w for w, _ in rest.values())
        full = [n for n, (w, c) in rest.items() if c * total <= w * left]
        if not full:
            return out | {n: w * left // total for n, (w, _) in rest.items()}
        for n in full:
            out[n] = rest.pop(n)[1]
        left = budget - sum(out.values())
    return out


def test_shares_against_repeated_filling(spark):
    rng = np.random.default_rng(0)
    for _ in range(3):
        leaves = [(f"d{d}", f"l{k}", f"s{s}", int(rng.integers(0, 1000))) for d in range(3) for k in range(3) for s in range(int(rng.integers(1, 5)))]
        weights = {"domain": {"d0": 5, "d1": 2}, "lang": {"l0": 3}, "source": {"s0": 4}}
        budget = int(rng.integers(100, 9000))
        df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
        got = {(r["domain"], r["lang"], r["source"]): r["share"] for r in mixing.allocate(df, F.lit(budget), weights, 2).collect()}
        capacity = lambda *key: sum(2 * t for *k, t in leaves if tuple(k[: len(key)]) == key)
        weight = lambda level, name: weights[level].get(name, 1)
        domains = fill({d: (weight("domain", d), capacity(d)) for d in {x[0] for x in leaves}}, min(budget, capacity()))
        expected = {}
        for d, b in domains.items():
            for k, c in fill({k: (weight("lang", k), capacity(d, k)) for k in {x[1] for x in leaves if x[0] == d}}, b).items():
                for s, share in fill({x[2]: (weight("source", x[2]), 2 * x[3]) for x in leaves if x[:2] == (d, k)}, c).items():
                    expected[(d, k, s)] = share
        assert got == expected


def test_a_large_family_in_ranges(spark):
    """A family of many sources, some empty or equal, shared in ranges as one by one."""
    rng = np.random.default_rng(6)
    sizes = [*(int(2 ** x) for x in rng.uniform(0, 20, 400)), *[0] * 5, *[777] * 60]
    rows = [("f", f"s{k}", int(rng.integers(1, 5)), size) for k, size in enumerate(sizes)] + [("g", "only", 1, 50), ("h", "a", 1, 0)]
    capacity = {f: sum(r[3] for r in rows if r[0] == f) for f in "fgh"}
    for part in (0.0, 0.003, 0.2, 0.7, 1.0):
        given = [(*r, int(capacity[r[0]] * part)) for r in rows]
        df = spark.createDataFrame(given, "family string, name string, weight long, capacity long, budget long").repartition(5)
        found = {(r["family"], r["name"]): r["out"] for r in mixing.share_in_ranges(df, ["family"], "budget", "name", "weight", "capacity", "out").collect()}
        for f in "fgh":
            expected = fill({r[1]: (r[2], r[3]) for r in rows if r[0] == f}, int(capacity[f] * part))
            assert {n: x for (g, n), x in found.items() if g == f} == expected


def test_levels_that_keep_their_proportions(spark):
    leaves = [("d0", "en", "a", 600), ("d0", "en", "b", 300), ("d0", "de", "a", 100), ("d1", "de", "c", 100), ("d1", "fr", "", 0)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    weights = {"domain": None, "lang": {"en": 1, "de": 1}, "source": None}
    found = {tuple(r)[:3]: r["share"] for r in mixing.allocate(df, F.lit(550), weights, 1).collect()}
    assert found == {("d0", "en", "a"): 266, ("d0", "en", "b"): 133, ("d0", "de", "a"): 100, ("d1", "de", "c"): 50, ("d1", "fr", ""): 0}


def mixed(df, budget=None, epochs=2):
    budget = F.lit(60) if budget is None else budget
    return mixing.mix(df, F.lit("d"), F.col("lang"), F.col("source"), F.size(F.split("text", " ")), budget, {}, epochs)


def test_mix_odd_rows(odd, empty):
    rows = mixed(odd, F.expr("total * 9 div 10")).collect()
    assert rows and sum(r["n_tokens"] for r in rows) <= 0.9 * sum(len((r["text"] or "").split(" ")) for r in odd.collect())
    everything = mixed(odd, F.expr("total * 2")).collect()
    assert len(everything) == 2 * odd.count()
    assert mixed(empty).collect() == []


def test_mix_takes_prefixes_of_epochs(spark):
    df = spark.createDataFrame([(i, "a b c d", "en", "s") for i in range(50)], "doc_id long, text string, lang string, source string")
    rows = mixed(df, F.lit(50 * 4 + 37)).collect()
    epochs = collections.Counter(r["epoch"] for r in rows)
    assert epochs == {0: 50, 1: 9}
    import hashlib

    order = sorted(range(50), key=lambda i: (hashlib.md5(f"42:1:{i}".encode()).hexdigest(), i))
    assert {r["doc_id"] for r in rows if r["epoch"] == 1} == set(order[:9])


# --- top-k ------------------------------------------------------------------


def brute_topk(rows, k):
    vectors = [(n, i, [int(np.floor(1024 * float(x))) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, q, a in vectors:
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for m, i, b in vectors if m != n and len(b) == len(a))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile", [5, 8192])
def test_topk_against_brute_force(spark, tile):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=20)]) for i in range(250)]
    rows += [(i, rows[7][1]) for i in range(300, 340)]  # ties
    rows += [rows[5], rows[5], rows[100], (200, rows[9][1])]  # repeated rows, a repeated query, a query's id with another vector
    rows += [(400, [1.0] * 3), (500, [2.0] * 3), (501, None), (502, [None] * 20), (503, [float("nan")] * 20), (504, [float("inf")] * 20), (None, rows[0][1]), (600, [])]
    df = spark.createDataFrame([(*r, "?", "?") for r in rows], "vec_id long, embedding array<double>, v string, row string")
    found = topk.exact_topk(topk.integer_vectors(df, "vec_id", "embedding"), F.col("id") % 100 == 0, 10, tile=tile, query_tile=3)
    assert sorted(tuple(r) for r in found.collect()) == brute_topk(rows, 10)
    assert topk.exact_topk(topk.integer_vectors(df.limit(0), "vec_id", "embedding"), F.col("id") % 100 == 0).collect() == []


def test_topk_counts_every_copy(spark):
    """Rows repeated in full are due each, as is a copy of the query's own row."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.exact_topk(topk.integer_vectors(df, "vec_id", "embedding"), F.col("id") % 100 == 0, 10).collect()
    assert sorted(r["vec_id"] for r in found) == [0, 0, 1, 1, 1, 1, 1, 1]


def test_topk_of_large_numbers():
    rng = np.random.default_rng(2)
    rows = rng.integers(-(1 << 28), 1 << 28, (50, 40))
    got = sorted(topk.tile_topk(np.arange(100, 105), rows[:5], np.arange(50), np.arange(50), rows, 3))
    expected = []
    for q in range(5):
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(rows[q], rows[i], strict=True)), i) for i in range(50))[:3]
        expected += [(q, i, -s) for s, i in scores]
    assert sorted(got) == sorted(expected)


# --- licenses ---------------------------------------------------------------


def test_rules():
    assert 300 <= len(license_scan.rules()) <= 1000
    assert all(r.keywords and all(r.keywords) for r in license_scan.rules())


def test_prefilter_loses_nothing():
    """Every rule, run without its keywords, finds what it finds with them."""
    texts = ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-3.0", "released under the MIT license. cc by-nc-sa 4.0; Creative Commons Attribution ShareAlike 3.0", "GNU General Public License as published by the Free Software Foundation; either version 2", "All rights reserved. Copyright (c) 2020. see LICENSE file", "Mozilla Public License v2 0 / BSD-3-Clause License / zlib licence"]
    for text in texts:
        words, _ = license_scan.normalized(text)
        every = set()
        for rule in license_scan.rules():
            for m in re.finditer(rf"(?<![^ ])(?=({rule.pattern})(?![^ ]))".encode(), words):
                first = words[: m.start()].count(b" ")
                every.add((rule.label, first, first + m.group(1).count(b" "), rule.priority))
        assert every == {(d.label, d.first, d.last, d.priority) for d in license_scan.detect(words)}
        assert every


def test_suppression():
    n, base, kept = license_scan.scan("Licensed under the Apache License, Version 2.0")
    assert n == 7 or n == 8
    assert [d.label for d in base] == ["apache"] and {d.label for d in kept} == {"apache-2.0"}
    d = license_scan.Detection
    assert license_scan.resolve([d("a", 0, 5, 1, 1, False), d("b", 1, 3, 0, 1, False), d("c", 2, 4, 2, 1, False), d("e", 4, 7, 2, 1, False)]) == [d("a", 0, 5, 1, 1, False), d("b", 1, 3, 0, 1, False), d("e", 4, 7, 2, 1, False)]
    assert {x.label for x in license_scan.scan("GNU General Public License, version 3")[2]} == {"gpl-3.0"}


def test_scan_against_brute_force(spark, odd, empty):
    phrases = license_scan.BASE
    for df in (odd, spark.read.parquet(f"{DATA}/documents.parquet")):
        got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], [(d["label"], d["first"]) for d in r["base"]]) for r in license_scan.scan_licenses(df).collect()), key=str)
        expected = []
        for doc_id, text in df.select("doc_id", "text").collect():
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
            joined = " ".join(words)
            places = sorted((k, label) for phrase, label in phrases.items() if phrase in joined for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
            expected.append((doc_id is None, doc_id or 0, len(words), [(label, k) for k, label in places]))
        assert got == sorted(expected, key=str)
    assert license_scan.scan_licenses(empty).collect() == []


# --- lines ------------------------------------------------------------------


def test_line_dedup_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        host = ["a", "b", None, ""][i % 4] if i % 3 else "a"
        lines = [f"own {i}", "menu" if rng.random() < 0.6 else "other", "", "menu", *(["rare"] if i == 5 else [])]
        rows.append((i, host, None if i == 8 else "" if i == 9 else "\n".join(lines)))
    rows += [rows[0], (None, "a", "menu\nx")]
    df = spark.createDataFrame(rows, "page_id long, host string, text string").withColumn("boiler", F.lit("?")).withColumn("salt", F.lit(1))
    got = line_dedup.drop_boilerplate(df, "text", F.col("host"), 0.2, 3, "n_dropped")
    assert got.columns == [*df.columns, "n_dropped"]
    pages = collections.Counter(h for _, h, _ in rows)
    held = collections.Counter((h, line) for _, h, t in rows for line in set((t or "").split("\n")) if line.strip())
    boiler = {k for k, n in held.items() if n >= 3 and n > 0.2 * pages[k[0]]}
    expected = []
    for i, h, t in rows:
        kept = None if t is None else "\n".join(line for line in t.split("\n") if (h, line) not in boiler)
        expected.append((i, kept, 0 if t is None else sum((h, line) in boiler for line in t.split("\n"))))
    assert sorted(((r["page_id"], r["text"], r["n_dropped"]) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_line_dedup_odd_rows(odd, empty):
    assert line_dedup.drop_boilerplate(odd, "text", F.col("source")).count() == odd.count()
    assert line_dedup.drop_boilerplate(empty, "text", F.col("source")).collect() == []


def test_line_dedup_stays_in_the_jvm(spark):
    df = queries.op7_line_dedup(spark, "/root/testdata/sf0.001")
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


# --- quality ----------------------------------------------------------------


def brute_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = collections.Counter(windows)
    covered = {p for k, w in enumerate(windows) if seen[w] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), sum(x in lines[:k] for k, x in enumerate(lines)), len(lines), len(covered)


def test_measure(documents, odd):
    for df in (documents, odd):
        for (text,) in df.select("text").collect():
            if len(text or "") < 40_000:
                assert host_quality.measure(text) == brute_measure(text)


def test_quality_odd_rows(odd, empty):
    judged = host_quality.judge_documents(odd)
    assert judged.count() == odd.count()
    assert all(not r["kept"] for r in judged.collect() if r["base_failed"])
    assert sorted(host_quality.keep_documents(odd).select("text").collect()) == sorted(odd.join(judged.where("kept").select("doc_id").distinct(), "doc_id").select("text").collect())
    assert host_quality.judge_documents(empty).collect() == [] and host_quality.keep_documents(empty).collect() == []


def test_hosts(spark):
    rows = [("bad", True)] * 400 + [("good", False)] * 380 + [("good", True)] * 20 + [("tiny", True)]
    verdicts = {r["host"]: (r["verdict"], r["shrunk_rate"]) for r in host_quality.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    assert verdicts["bad"][0] == "blocked" and verdicts["good"][0] == "normal"
    assert verdicts["tiny"][0] != "blocked" and verdicts["tiny"][1] < 1
    assert host_quality.beta_prior(0, 0, 0, 0) == (0.0, 2.0)


def test_quality_against_labels(spark):
    judged = {r["doc_id"]: r["kept"] for r in queries.op8_host_quality(spark, DATA).collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    assert np.mean([judged[r["doc_id"]] for r in labels if r["quality"] == 0]) < 0.1
    base = {r["doc_id"] for r in queries.op8_host_quality(spark, DATA).where("base_failed").collect()}
    assert all(judged[r["doc_id"]] for r in labels if r["quality"] == 1 and r["doc_id"] not in base)


# --- language and toxicity --------------------------------------------------


def test_language_held_out(spark):
    rows = queries.op4_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(odd, empty, documents):
    model = langid.train_language_model(documents)
    texts = odd.select("text", F.col("text").alias("again"), "v")
    rows = langid.identify(texts, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["lang"] == "und") == (not any(map(str.isalpha, r["again"] or "")))
    nothing = langid.train_language_model(empty)
    assert {r["lang"] for r in langid.identify(texts, nothing).collect()} == {"und"}
    assert langid.identify(texts.limit(0), model).collect() == []


def brute_language(model, text):
    """The model's answer by plain loops over the letters of a whole text."""
    points = [32]
    for c in text.lower():
        c = ord(c) if c.isalpha() else 32
        if c != 32 or points[-1] != 32:
            points.append(c)
    if points[-1] != 32:
        points.append(32)
    total, n, low = [0.0] * len(model.languages), 0, (1 << 32) - 1
    for size in langid.GRAMS:
        for at in range(len(points) - size + 1):
            value = 0
            for k in range(size):
                value = (value ^ points[at + k]) * int(langid._MULTIPLIERS[k]) & low
                value ^= value >> 13
            row = model.table[(value * 0x2C1B3C6D & low) >> (32 - langid.BUCKET_BITS)]
            total, n = [a + float(b) for a, b in zip(total, row, strict=True)], n + 1
    odds = [np.exp((a / n + b) / model.temperature) for a, b in zip(total, model.bias, strict=True)]
    return max(zip((x / sum(odds) for x in odds), model.languages, strict=True))


@pytest.mark.parametrize("piece", [7, 1 << 16])
def test_language_against_brute_force(spark, documents, odd, monkeypatch, piece):
    """Whole texts, whatever the pieces that they are read in."""
    model = langid.train_language_model(documents)
    monkeypatch.setattr(langid, "PIECE", piece)
    texts = [r["text"] for r in documents.limit(25).collect()] + [r["text"] for r in odd.collect()]
    for text in texts:
        text = text and text[:3000]
        found, score, _ = model.predict(text)
        if not any(map(str.isalpha, text or "")):
            assert (found, score) == ("und", 0.0)
            continue
        expected, language = brute_language(model, text)
        assert found == language and abs(score - expected) < 1e-4


def test_training_parts_hold_whole_texts(spark):
    """Each character of a long text is in one part, and any number of labels will do."""
    text = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(5000))
    rows = spark.createDataFrame([(text, "en", 1), ("ab", "x", 0)], "text string, lang string, fold__ int")
    parts = langid.training_parts(rows, "text", "lang").collect()
    grams = sum(int(np.frombuffer(r["counts"], "<u4").sum()) for r in parts if r["label"] == "en")
    whole = int(langid.bag_of(text)[1].sum())
    assert len(parts) == langid.PARTS + 1 and abs(grams - whole) <= langid.PARTS * 40
    many = spark.createDataFrame([(k, f"text number {k}", f"label {k}") for k in range(3000)], "doc_id long, text string, lang string")
    assert len(langid.train_language_model(many, max_rows=100).languages) < 300


def test_toxicity_against_brute_force(spark, documents, odd):
    """Matches by one regex a term over the folded text, exceptions one by one, trained model."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    trained = toxicity.train_toxicity(documents, labels)
    model = toxicity.ToxicityModel(trained.weights | {"clown": 1.0, "trash": 0.5, "pathetic*": 2.0}, trained.curve)
    texts = [r["text"] for r in documents.collect()] + [r["text"] for r in odd.collect()]
    texts += ["A cl0wn, class clown, clown car; TRASH can trash. pathetical pathetic fallacy $tupid " * 30, "clown" * 50]
    for text in texts:
        folded = toxicity.fold((text or "")[:20_000])
        spared = [(m.start(), m.end()) for p in model.exceptions for m in re.finditer(rf"(?=(?<![^\W_])({re.escape(p)})(?![^\W_]))", folded) for m in [re.compile(re.escape(p)).match(folded, m.start())]]
        found = {}
        for term, weight in model.weights.items():
            stem = term.endswith("*")
            tail = "" if stem else r"(?![^\W_])"
            for m in re.finditer(rf"(?<![^\W_]){re.escape(term.removesuffix('*'))}{tail}", folded):
                if weight > found.get(m.start(), (0, -1.0))[1]:
                    found[m.start()] = m.end(), weight
        expected = [(a, b, w) for a, (b, w) in sorted(found.items()) if not any(x <= a and b <= y for x, y in spared)]
        assert sorted(w for *_, w in model.matches(folded)) == sorted(w for *_, w in expected)
    scored = toxicity.score_documents(odd, model)
    assert [r["score"] for r in scored.collect()] == [model.score(r["text"]) for r in odd.collect()]


def test_resolve_against_brute_force():
    rng = np.random.default_rng(8)
    d = license_scan.Detection
    for _ in range(60):
        found = [d(f"l{rng.integers(4)}", int(a), int(a + rng.integers(0, 9)), int(rng.integers(3)), 1.0, False) for a in rng.integers(0, 40, 50)]
        better = sorted(set(found), key=lambda x: (x.priority, x.first - x.last, x.first, x.label))
        kept = []
        for x in better:
            if not any(k.first <= x.first and x.last <= k.last for k in kept):
                kept.append(x)
        assert license_scan.resolve(found) == sorted(kept, key=lambda x: (x.first, x.last))


def test_license_labels_against_brute_force(spark):
    """Every rule without its prefilter, resolved pair by pair, on texts that name licenses."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r["text"] and "licen" in r["text"].lower()}
    got = {r["doc_id"]: r for r in queries.op5_license_scan(spark, "/root/testdata/sf0.001").collect()}
    assert texts
    for doc_id, text in texts.items():
        words, _ = license_scan.normalized(text)
        every = set()
        for rule in license_scan.rules():
            for m in re.finditer(rf"(?<![^ ])(?=({rule.pattern})(?![^ ]))".encode(), words):
                first = words[: m.start()].count(b" ")
                every.add((rule.priority, -m.group(1).count(b" "), first, rule.label, first + m.group(1).count(b" "), rule.weight, license_scan.BASE.get(rule.pattern) == rule.label))
        kept = []
        for x in sorted(every):
            if not any(k[2] <= x[2] and x[4] <= k[4] for k in kept):
                kept.append(x)
        base = {x[3] for x in every if x[6]}
        assert got[doc_id]["labels"] == ",".join(sorted({x[3] for x in kept} | base))
        assert got[doc_id]["score"] == max([x[5] for x in kept] + [x[5] for x in every if x[6]], default=0.0)


def test_folding():
    assert toxicity.fold("1D10T іdіоt ｉｄｉｏｔ ïdïót id!ot $cum") == "idiot idiot idiot idiot idiot scum"
    assert toxicity.fold("the$$$ end!!") == "the$$$ end!!"


def test_matches():
    model = toxicity.ToxicityModel({"clown": 1.0, "shut up": 2.0}, [-2, 1, 1, 1])
    find = lambda t: [m[2] for m in model.matches(toxicity.fold(t))]
    assert find("a CL0WN, clowns and clown fish; Shut up!") == [1.0, 2.0]
    stems = toxicity.ToxicityModel({"clown": 1.0, "clow*": 3.0, "fish*": 0.5}, [-2, 1, 1, 1])
    assert [m[2] for m in stems.matches("clown clowning aclown clown fish fishes")] == [3.0, 3.0, 0.5]
    assert model.score("clown clown") > model.score("clown " + "word " * 500) > model.score("") == model.score(None)


def test_toxicity_held_out(spark):
    rows = queries.op10_toxicity(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.9
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 0]) < 0.02


def test_toxicity_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train_toxicity(odd, labels)
    assert toxicity.score_documents(odd, model).where("score between 0 and 1").count() == odd.count()
    assert toxicity.score_documents(empty, model).collect() == []
