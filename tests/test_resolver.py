import pytest

from tessera.operators import community, publish, resolve
from tessera.sources.tables import overrides_table

D, E, W, N, T, Z = "direct_unique", "external_id_unique", "domain_unique", "name_country_unique", "token_sort_name_country_unique", "fuzzy_name_country_unique"
A, P = "direct_ambiguous", "participant_name_country_unique"

BRANCHES = [
    ("direct", [(D, "r1"), (E, "r2")], None, ("r1", "high", "openaire_direct")),
    ("two direct", [(D, "r1"), (D, "r2"), (E, "r2")], None, ("r2", "review", "openaire_external")),
    ("supported", [(E, "r1")], ("r1", 1), ("r1", "high", "community_supported")),
    ("not by fuzzy", [(Z, "r1")], ("r1", 1), ("r1", "review", "openaire_fuzzy_name")),
    ("ambiguous external", [(A, "r1"), (A, "r2"), (E, "r2")], None, ("r2", "medium", "openaire_ambiguous_external")),
    ("ambiguous domain", [(A, "r1"), (A, "r2"), (W, "r1")], None, ("r1", "medium", "openaire_ambiguous_domain")),
    ("ambiguous name", [(A, "r1"), (A, "r2"), (N, "r1")], None, ("r1", "medium", "openaire_ambiguous_exact_name")),
    ("ambiguous sorted", [(A, "r1"), (A, "r2"), (T, "r1")], None, ("r1", "review", "openaire_ambiguous_token_sort")),
    ("ambiguous fuzzy", [(A, "r1"), (A, "r2"), (Z, "r1")], None, ("r1", "review", "openaire_ambiguous_fuzzy_name")),
    ("external domain", [(E, "r1"), (W, "r1")], None, ("r1", "medium", "openaire_external_domain")),
    ("external name", [(E, "r1"), (N, "r1"), (W, "r2")], None, ("r1", "medium", "openaire_external_name")),
    ("domain name", [(W, "r1"), (N, "r1")], None, ("r1", "medium", "openaire_domain_name")),
    ("domain fuzzy", [(W, "r1"), (Z, "r1")], None, ("r1", "medium", "openaire_domain_fuzzy_name")),
    ("repeat", [(E, "r2")], ("r1", 2), ("r1", "medium", "community_repeat")),
    ("external", [(E, "r1")], None, ("r1", "review", "openaire_external")),
    ("domain", [(W, "r1")], None, ("r1", "review", "openaire_domain")),
    ("name", [(N, "r1")], None, ("r1", "review", "openaire_name_country")),
    ("two names", [(N, "r1"), ("alt_name_country_unique", "r1")], None, ("r1", "review", "exact_name")),
    ("sorted", [(T, "r1")], None, ("r1", "review", "openaire_token_sort_name")),
    ("fuzzy", [(Z, "r1")], None, ("r1", "review", "openaire_fuzzy_name")),
    ("single", [], ("r1", 1), ("r1", "review", "community_single")),
    ("none", [(E, "r1"), (E, "r2")], None, None),
]


@pytest.fixture(scope="module")
def resolved(spark):
    rows = [(name, ror, s) for name, found, _, _ in BRANCHES for s, ror in found]
    openaire = spark.createDataFrame([(p, r, s) for p, r, s in rows], "pic string, ror_id string, strategy string")
    participant = spark.createDataFrame([("participant", "r1", P)], "pic string, ror_id string, strategy string")
    seen = [(name, c[0], c[1], "stable") for name, _, c, _ in BRANCHES if c]
    matches = spark.createDataFrame(seen, "pic string, ror_id string, observation_count long, community_status string")
    return {r["pic"]: (r["ror_id"], r["confidence"], r["source"]) for r in resolve.resolutions(openaire, participant, matches).collect()}


@pytest.mark.parametrize(("name", "expected"), [(b[0], b[3]) for b in BRANCHES])
def test_branch(resolved, name, expected):
    assert resolved.get(name) == expected


def test_participant_source(resolved):
    assert resolved["participant"] == ("r1", "review", "participant_name_country")


def test_community_layer(spark):
    ror = spark.createDataFrame([("r1", "One", "FR", ["One"], ["one"]), ("r2", "Two", "FR", ["Two", "Dos"], ["dos", "two"])], "ror_id string, display_name string, country_code string, names array<string>, normalized_names array<string>")
    for s in ("grid", "isni", "wikidata", "fundref"):
        ror = ror.selectExpr("*", f"cast(array() as array<string>) as {s}_ids")
    ror = ror.selectExpr("*", "cast(array() as array<string>) as domains")
    orgs = spark.createDataFrame([("s", 1, "One", "one", "r1"), ("s", 2, "Wrong", "wrong", "r2"), ("s", 3, "X", "x", "r9"), ("s", 4, "No", "no", ""), ("t", 1, "Two", "two", "r2")], "slug string, org_order int, name string, normalized_name string, ror_id string")
    found = community.suspicious_orgs(orgs, ror)
    assert {(r["org_order"], r["reason"]) for r in found.collect()} == {(2, "name-not-in-ror-aliases"), (3, "missing-ror-record")}
    people = spark.createDataFrame([("s", "a", 1, "p1", "One", "one"), ("s", "a", 2, "p1", "ONE", "one"), ("t", "b", 1, "p1", "Dos", "dos"), ("t", "b", 2, "p2", "Dos", "dos"), ("t", "b", 3, "", "Dos", "dos")], "slug string, award_number string, participant_order int, pic string, participant_name string, normalized_name string")
    observed = community.observations(people, orgs, found, ror)
    rows = {(r["pic"], r["ror_id"], r["slug"], r["participant_name"]) for r in observed.collect()}
    assert rows == {("p1", "r1", "s", "One"), ("p1", "r2", "t", "Dos"), ("p2", "r2", "t", "Dos")}
    direct = spark.createDataFrame([("p1", "r1", "direct_unique")], "pic string, ror_id string, strategy string")
    matches = {(r["pic"], r["ror_id"]): (r["community_status"], r["agrees_with_openaire_direct"], r["conflicts_with_openaire_direct"]) for r in community.community_matches(observed, direct).collect()}
    assert matches == {("p1", "r1"): ("ambiguous", 1, 0), ("p1", "r2"): ("ambiguous", 0, 1), ("p2", "r2"): ("stable", 0, 0)}


def test_overrides(spark):
    rows = spark.createDataFrame([("1", "a", "high", "s", "{}"), ("2", "b", "review", "s", "{}"), ("3", "c", "high", "s", "{}"), ("4", "d", "medium", "s", "{}")], "pic string, ror_id string, confidence string, source string, evidence_json string")
    entries = [{"pic": "1", "ror": "z", "note": "n"}, {"pic": "3", "ror": ""}, {"pic": "9", "ror": "y", "reasoning": "why"}, {"pic": "8", "ror": ""}, {"ror": "q"}, "junk", {"pic": "1", "ror": "zz"}]
    merged = publish.merge_overrides(rows, overrides_table(spark, entries))
    got = {r["pic"]: (r["ror_id"], r["confidence"], r["source"], r["evidence_json"], r["override_note"]) for r in merged.collect()}
    assert got == {"1": ("zz", "manual", "manual_override", None, None), "4": ("d", "medium", "s", "{}", None), "9": ("y", "manual", "manual_override", None, "why")}
