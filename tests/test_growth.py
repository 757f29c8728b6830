"""Rows that joins make, where keys are shared by many rows on both sides."""

from pyspark.sql import functions as F

from tessera.operators import awards, community, fuzzy, reports
from tessera.plans.bindings import QUERIES

DATA = "/root/testdata/sf0.001"


def nodes(plan):
    yield plan
    children = plan.children()
    for at in range(children.size()):
        yield from nodes(children.apply(at))


def run(spark, df):
    """Rows of df, and the most that one of its joins makes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.collect()
        joins = [n.metrics().get("numOutputRows").get().value() for n in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return rows, max(joins)


def awards_of(spark, communities, awards):
    return spark.range(communities * awards).select(F.expr(f"concat('s', id % {communities})").alias("slug"), F.expr(f"concat('a', id div {communities})").alias("award_number"), F.lit(False).alias("is_deleted"))


def people_of(spark, awards, codes):
    confidence = F.expr(f"element_at(array('high', 'medium', 'review', ''), cast(id % {codes} % 4 as int) + 1)")
    rows = spark.range(awards * codes).select(F.expr(f"concat('a', id div {codes})").alias("award_number"), F.expr(f"concat('p', id % {codes})").alias("pic"), F.expr(f"if(id div {codes} = 0, 'cordis', 'community')").alias("source"), confidence.alias("resolution_confidence"))
    return rows.withColumn("ror_id", F.when(F.col("resolution_confidence") != "", F.lit("r1")).otherwise(""))


def test_types_count_communities_before_participants(spark):
    ror = spark.createDataFrame([("r1", ["company"])], "ror_id string, types array<string>")
    rows, most = run(spark, reports.resolved_types(awards_of(spark, 200, 1), people_of(spark, 1, 200), ror))
    assert [tuple(r) for r in rows] == [("company", 200 * 150, 150)]
    assert most <= 400


def test_coverage_packs_communities(spark):
    awards = awards_of(spark, 100, 20).where("not (slug = 's7' and award_number = 'a0')")
    rows, most = run(spark, reports.community_coverage(awards.unionByName(spark.createDataFrame([("s100", "none", False)], awards.schema)), people_of(spark, 20, 50)))
    found = {r["slug"]: tuple(r[c] for c in ("award_count", "participants", "high", "high_medium", "any", "source_bucket")) for r in rows}
    expected = {f"s{k}": (20, 50, 13, 26, 38, "mixed") for k in range(100)} | {"s7": (19, 50, 13, 26, 38, "community"), "s100": (1, 0, 0, 0, 0, "none")}
    assert found == expected
    # a row each would make 100,000
    assert most <= 20_000


def test_shared_names_meet_two_entries(spark):
    entries = [(f"r{k}", "x", ["institute of shared names"]) for k in range(60)] + [("u", "x", ["laboratory of single things", "single laboratory things"])]
    targets = fuzzy.fuzzy_targets(spark.createDataFrame(entries, "ror_id string, country_code string, names array<string>"))
    names = [(f"o{k}", 0, "Institute of shared names", "institute of shared names", "x") for k in range(60)]
    names += [("v", 0, "Laboratory of single things", "laboratory of single things", "x"), ("v", 1, "laboratory single of things", "laboratory single of things", "x")]
    names += [("w", 0, "Laboratory of single things", "laboratory of single things", "x"), ("w", 1, "Institute of shared names", "institute of shared names", "x")]
    given = spark.createDataFrame(names, "record string, position int, raw string, normalized string, country string")
    rows, most = run(spark, fuzzy.best_unique_match(given, targets))
    assert [(r["record"], r["ror_id"], r["fuzzy"]["score"], r["fuzzy"]["matched_names"]) for r in rows] == [("v", "u", 100.0, ["Laboratory of single things", "laboratory single of things"])]
    # a row a record and entry would make 3,600
    assert most <= 400


def test_labels_of_a_name_gather_its_entries_once(spark):
    ror = spark.createDataFrame([(f"r{k:02}", "Shared", "x", ["shared"]) for k in range(50)], "ror_id string, display_name string, country_code string, normalized_names array<string>")
    labels = spark.createDataFrame([("s", k, "Shared", "shared", "r00" if k == 0 else "q", "Other", "why") for k in range(50)], "slug string, org_order int, name string, normalized_name string, ror_id string, ror_display_name string, reason string")
    rows, most = run(spark, reports.likely_wrong(labels, ror))
    assert {r["org_order"]: r["other_ror_count"] for r in rows} == {0: 49} | dict.fromkeys(range(1, 50), 50)
    assert most <= 100


def test_links_of_a_code_are_no_array(spark):
    counted = spark.createDataFrame([("p1", "r1"), ("p1", "r2"), ("p2", "r1"), ("p3", None)], "pic string, ror_id string")
    direct = spark.createDataFrame([("p1", "r1"), ("p1", "r9"), ("p3", "r1")], "pic string, ror_id string")
    out = community.against_direct(counted, direct)
    assert {(r[0], r[1]): (r[2], r[3]) for r in out.collect()} == {("p1", "r1"): (1, 0), ("p1", "r2"): (0, 1), ("p2", "r1"): (0, 0), ("p3", None): (0, 0)}
    assert "collect_set" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_stored_tables_are_not_broadcast_by_their_files(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("label_review_summary", "likely_wrong_labels"):
            assert "BroadcastHashJoin" not in QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString(), name
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def scans(spark, name, table):
    """How often a query's plan reads a table."""
    leaves = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(table in leaves.apply(at).output().mkString(" ") for at in range(leaves.size()))


def test_coverage_orders_no_participants(spark):
    for name in ("community_coverage", "award_coverage", "size_bands", "source_bucket", "coverage_medians", "coverage_bins"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "participant_name" not in plan, name


def test_codes_are_those_of_the_best_participants(spark):
    given = spark.createDataFrame([("a1", "cordis", "HE"), ("a2", "community", "s1")], "award_number string, source string, source_origin string")
    official = spark.createDataFrame([("a1", "HE", k, "participant", p, "n", "x", "") for k, p in enumerate(("p1", "p1", "p2", "", None))] + [("a1", "FP7", 1, "participant", "p9", "n", "x", "")], "award_number string, origin string, participant_order int, participant_type string, pic string, legal_name string, country_code string, website_url string")
    pooled = spark.createDataFrame([("a2", "p1", "N", 1), ("a2", "p1", "M", 2), ("a2", "p3", "N", 3), ("a2", None, "N", 4), ("a1", "p7", "N", 1)], "award_number string, pic string, participant_name string, participant_order int")
    known = spark.createDataFrame([("p1", "r1", "high", "s"), ("p3", "r3", "review", "s")], "pic string, ror_id string, confidence string, source string")
    found = awards.best_codes(given, official, pooled, known)
    best = awards.best_participants(given, official, pooled, known).select(found.columns)
    order = lambda rows: sorted(map(str, rows))
    assert order(found.collect()) == order(best.distinct().collect())


def test_coordinators_need_the_coverage_once(spark):
    # the coverage reads line items for official and for pooled participants, the coordinators once more
    assert scans(spark, "coordinator_coverage", "l_orderkey") == 3


def test_queue_makes_participants_once(spark):
    assert scans(spark, "review_queue", "l_orderkey") == 1


def test_queue_takes_the_first_seen_of_equals(spark):
    rows = [("p1", "HE", "a2", 1, "x", "S", "late", ""), ("p1", "HE", "a1", 2, "y", "", "early", "w2"), ("p1", "FP7", "a1", 3, "y", None, "late", "w1"), ("p1", "FP7", "a1", 1, "x", "", "early", ""), ("p2", "HE", "a1", 9, "x", "", "", ""), ("p3", "HE", "a1", 4, "x", "S", "n", "w"), ("", "HE", "a1", 5, "x", "S", "n", "w")]
    people = spark.createDataFrame(rows, "pic string, origin string, award_number string, participant_order int, country_code string, short_name string, legal_name string, website_url string")
    known = spark.createDataFrame([("p3", "r3", "high", "s"), ("p2", "r2", "review", "t")], "pic string, ror_id string, confidence string, source string")
    signals = spark.createDataFrame([("p1", "names", "ids")], "pic string, openaire_alt_names string, openaire_external_ids string")
    found = {tuple(r) for r in reports.review_queue(people, known, signals).collect()}
    assert found == {("p1", 4, 2, 2, "x", "S", "early", "w1", "names", "ids", "", "", ""), ("p2", 1, 0, 1, "x", "", "", "", "", "", "r2", "review", "t")}
