"""The whole run on hand-made dumps."""

import gzip
import io
import json
import os
import tarfile
import zipfile

import pytest

from tessera.operators import reports
from tessera.plans import pipeline, render
from tessera.schemas import DuplicateKeyError
from tessera.sources import archives, projects, tables
from tessera.sources.tables import overrides_table
from tessera.streaming.dumps import follow_communities

PROJECT = """<project xmlns="http://x"><id>{id}</id><acronym>ACR</acronym><title>T {id}</title>
<relations><associations>
<organization type="coordinator"><id>100</id><legalName>Université Alpha</legalName><shortName>UA</shortName><address><country>FR</country><url>http://alpha.fr</url></address></organization>
<organization type="participant"><legalName>No Code</legalName></organization>
<organization type="participant"><id>200</id><legalName>Beta Gamma Labs GmbH</legalName><address><country>DE</country></address></organization>
</associations>
<programme type="relatedLegalBasis"><code>H2020-LONG</code></programme><programme type="relatedLegalBasis" uniqueProgrammePart="true"><code>H2020-EU.1.1</code></programme>
<programme type="relatedLegalBasis" uniqueProgrammePart="true"><code>H2020</code></programme><programme type="other"><code>X</code></programme>
<webLink type="relatedWebsite" represents="project"><physUrl>http://proj</physUrl></webLink></relations></project>"""


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    d = tmp_path_factory.mktemp("dumps")
    for origin in ("he", "fp7"):
        with zipfile.ZipFile(d / f"{origin}.zip", "w") as z:
            z.writestr("b.xml", PROJECT.format(id="1"))
            z.writestr("a.XML", PROJECT.format(id="2"))
            z.writestr("bad.xml", "<project>")
            z.writestr("noid.xml", "<project><title>x</title></project>")
            z.writestr("readme.txt", "no")
    award = {"number": " 1 ", "acronym": "A", "title": {"en": "Title"}, "identifiers": [{"scheme": "url", "identifier": "http://a"}], "organizations": [{"id": "300", "scheme": "pic", "organization": "Delta Institute"}, {"id": "x", "scheme": "other", "organization": "Y"}]}
    other = award | {"number": "77", "title": "Plain"}
    community = {"id": "u", "slug": "c1", "parent": {"slug": "eu"}, "metadata": {"funding": [{"award": {"number": ""}}, {"award": award}, {"award": other}], "organizations": [{"id": "04delta00", "name": "Delta Institute"}, {"name": "Bad Label", "identifiers": [{"scheme": "ror", "identifier": "https://ror.org/02beta000"}]}]}}
    with open(d / "communities.jsonl", "w") as f:
        f.write(json.dumps(community) + "\n" + json.dumps({"slug": "n", "parent": {"slug": "us"}, "metadata": {}}) + "\n" + json.dumps({"slug": "m", "parent": None}) + "\n")
    records = [
        {"id": "o1", "legalName": "Université Alpha", "country": {"code": "FR"}, "websiteUrl": "http://www.alpha.fr/x", "alternativeNames": ["Alpha U", " "], "pids": [{"scheme": "PIC", "value": "100"}, {"scheme": "ROR", "value": "https://ror.org/01alpha00"}]},
        {"id": "o2", "legalName": "Zeta", "country": {"code": "DE"}, "websiteUrl": "https://beta.de", "pids": [{"scheme": "PIC", "value": "400"}, {"scheme": "GRID", "value": "Grid.2"}]},
        {"id": "o3", "legalName": "No code", "pids": []},
    ]
    with tarfile.open(d / "orgs.tar", "w") as t:
        data = gzip.compress("\n".join(map(json.dumps, records)).encode())
        info = tarfile.TarInfo("part-0.json.gz")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    entry = lambda i, name, cc, **more: {"id": f"https://ror.org/{i}", "names": [{"value": name, "types": ["ror_display"]}], "locations": [{"geonames_details": {"country_code": cc}}], "types": ["education"]} | more
    registry = [
        entry("01alpha00", "University Alpha", "FR"),
        entry("02beta000", "Beta Gamma Lab", "DE", links=[{"type": "website", "value": "https://beta.de/"}], external_ids=[{"type": "grid", "all": ["grid.2"], "preferred": None}]),
        entry("04delta00", "Delta Institute", "IT", external_ids=[{"type": "isni", "all": "0000 1", "preferred": None}]),
        entry("", "Nothing", "IT", id=""),
    ]
    with zipfile.ZipFile(d / "ror.zip", "w") as z:
        z.writestr("ror.json", json.dumps(registry))
    return d


@pytest.fixture(scope="module")
def root(spark, dumps, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("db"))
    out = pipeline.import_sources(spark, root, cordis_archives=projects.parse_archive_arguments([f"he={dumps}/he.zip", f"FP7={dumps}/fp7.zip"]), community_dump=f"{dumps}/communities.jsonl", openaire_tar=f"{dumps}/orgs.tar", ror_zip=f"{dumps}/ror.zip")
    assert out == {"cordis_projects": 4, "cordis_participants": 8, "community_awards": 2, "community_award_participants": 2, "community_orgs": 2, "openaire_orgs": 3, "ror_orgs": 3}
    pipeline.derive_tables(spark, root)
    return root


def rows(spark, root, name):
    return [r.asDict() for r in tables.load(spark, root, name).collect()]


def test_raw_tables(spark, root):
    project = next(r for r in rows(spark, root, "cordis_projects") if r["award_number"] == "1" and r["origin"] == "HE")
    assert project["programme"] == "H2020" and project["project_website"] == "http://proj"
    people = sorted((r["participant_order"], r["pic"], r["normalized_legal_name"], r["country_code"]) for r in rows(spark, root, "cordis_participants") if r["award_number"] == "1" and r["origin"] == "HE")
    assert people == [(1, "100", "universite alpha", "FR"), (3, "200", "beta gamma labs", "DE")]
    listed = {r["award_number"]: r for r in rows(spark, root, "community_awards")}
    assert listed["1"]["award_order"] == 2 and listed["1"]["award_title"] == "Title" and listed["1"]["award_url"] == "http://a" and listed["77"]["award_title"] == "Plain"
    labels = {r["name"]: (r["ror_id"], r["provided_id_kind"]) for r in rows(spark, root, "community_orgs")}
    assert labels == {"Delta Institute": ("04delta00", "ror"), "Bad Label": ("02beta000", "none")}
    record = next(r for r in rows(spark, root, "openaire_orgs") if r["record_id"] == "o1")
    assert (record["rors"], record["domains"], record["alt_names"]) == (["01alpha00"], ["alpha.fr"], ["Alpha U"])
    entry = next(r for r in rows(spark, root, "ror_orgs") if r["ror_id"] == "04delta00")
    assert entry["isni_ids"] == ["00001"] and entry["types"] == ["education"]


def test_resolutions_and_trace(spark, root):
    found = {r["pic"]: r for r in rows(spark, root, "pic_ror_resolutions")}
    assert {p: (r["ror_id"], r["confidence"], r["source"]) for p, r in found.items()} == {
        "100": ("01alpha00", "high", "openaire_direct"),
        "200": ("02beta000", "review", "participant_fuzzy_name"),
        "300": ("04delta00", "medium", "community_repeat"),
        "400": ("02beta000", "medium", "openaire_external_domain"),
    }
    trace = json.loads(found["400"]["evidence_json"])
    assert [g["signal_code"] for g in trace["agreement_summary"]] == ["domain", "external"]
    assert trace["picked_match"]["target"] == {"country_code": "DE", "name": "Beta Gamma Lab", "ror_id": "02beta000"}
    checks = {m["rule_code"]: m["comparison"]["checked"] for m in trace["matches_checked"]["openaire"]}
    assert checks["external_id_unique"] == [{"field": "GRID id", "source_value": "grid.2", "target_value": "grid.2"}]
    assert checks["domain_unique"][0]["matched_value"] == "beta.de"
    picked = json.loads(found["200"]["evidence_json"])["picked_match"]["score"]
    assert picked["used"] is True and picked["value"] >= 95 and picked["runner_up"] == 0.0
    assert json.loads(found["300"]["evidence_json"])["matches_checked"]["community"][0]["times_seen"] == 2


def test_awards(spark, root):
    best = {r["award_number"]: (r["source"], r["source_origin"]) for r in rows(spark, root, "awards_best")}
    assert best == {"1": ("cordis", "HE"), "2": ("cordis", "HE"), "77": ("community", "c1")}
    people = {(r["award_number"], r["participant_order"]): (r["pic"], r["ror_id"]) for r in rows(spark, root, "award_participants_best")}
    assert people[("77", 1)] == ("300", "04delta00") and people[("1", 3)] == ("200", "02beta000")


def test_exports_and_reports(spark, root, tmp_path):
    pipeline.export_tables(spark, root, str(tmp_path / "out"))
    back = tables.read_csv(spark, str(tmp_path / "out/pic_ror_resolutions.csv"), ("pic", "ror_id"))
    assert back.count() == 4 and json.loads(back.orderBy("pic").first()["evidence_json"])
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "out/awards_best.csv"), ("nothing",))
    summary = pipeline.build_summary(spark, root)
    assert summary["resolution_confidence"] == {"high": 1, "medium": 2, "review": 1}
    assert sum(summary["resolution_source"].values()) == summary["table_counts"]["pic_ror_resolutions"]
    assert sum(summary["community_label_quality"].values()) == summary["table_counts"]["community_orgs"]
    report = pipeline.build_coverage_report(spark, root)
    assert report["communities_in_scope"] == 1 and report["participant_list_availability"]["pct_with_participants"] == 100
    assert "## Resolved ROR Types" in render.coverage_markdown(report)
    review = pipeline.build_label_review(spark, root)
    text = render.label_review_markdown(review["summary"], *([r.asDict() for r in review[k].collect()] for k in ("likely_wrong_rows", "review_rows", "conflict_rows")))
    assert "Bad Label" in text
    queue = pipeline.build_review_queue(spark, root)
    assert [(r["pic"], r["count"], r["count_fp7"], r["count_he"], r["pipeline_source"]) for r in queue.orderBy(*reports.queue_order()).collect()] == [("200", 4, 2, 2, "participant_fuzzy_name")]
    merged = pipeline.publish_mapping(spark, root, overrides_table(spark, [{"pic": "200", "ror": "m", "note": "checked"}]), str(tmp_path / "pub"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "pub/pic_mapping.jsonl")).collect()]
    assert [x["pic"] for x in lines] == ["100", "200", "300", "400"] and lines[1]["evidence"] is None and lines[1]["override_note"] == "checked"
    data = pipeline.dashboard_data(summary, merged, queue)
    assert data["review_queue"]["coverage_curve"] == [{"top_n": 1, "appearances": 4, "pct": 1.0}]
    tables.write_dashboard(data, str(tmp_path / "data.js"))


def test_import_again_replaces_one_origin(spark, dumps, root):
    pipeline.import_sources(spark, root, cordis_archives=[("FP7", f"{dumps}/fp7.zip")])
    assert tables.load(spark, root, "cordis_projects").count() == 4


def test_duplicate_key_fails(spark, dumps, tmp_path):
    with zipfile.ZipFile(tmp_path / "dup.zip", "w") as z:
        z.writestr("a.xml", PROJECT.format(id="1"))
        z.writestr("b.xml", PROJECT.format(id="1"))
    with pytest.raises(DuplicateKeyError):
        pipeline.import_sources(spark, str(tmp_path / "db"), cordis_archives=[("HE", str(tmp_path / "dup.zip"))])


def test_a_failing_import_changes_nothing(spark, dumps, tmp_path):
    """Duplicate keys and unreadable dumps leave every stored table as it was."""
    root = str(tmp_path / "db")
    pipeline.import_sources(spark, root, cordis_archives=[("HE", f"{dumps}/he.zip")], ror_zip=f"{dumps}/ror.zip")
    before = {name: sorted(map(str, rows(spark, root, name))) for name in ("cordis_projects", "cordis_participants", "ror_orgs")}
    with zipfile.ZipFile(tmp_path / "dup.zip", "w") as z:
        z.writestr("a.xml", PROJECT.format(id="8"))
        z.writestr("b.xml", PROJECT.format(id="8"))
    with pytest.raises(DuplicateKeyError):
        pipeline.import_sources(spark, root, ror_zip=f"{dumps}/ror.zip", cordis_archives=[("HE", str(tmp_path / "dup.zip"))])
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="zip"):
        pipeline.import_sources(spark, root, cordis_archives=[("HE", f"{dumps}/fp7.zip")], ror_zip=str(tmp_path / "bad.zip"))
    assert before == {name: sorted(map(str, rows(spark, root, name))) for name in before}
    assert not [f for f in os.listdir(root) if f.startswith(".aside")]


@pytest.mark.parametrize("whole", [1 << 30, 0])
def test_encodings_addresses_and_counters(spark, tmp_path, monkeypatch, whole):
    """Members in the encoding that they name; the first country found over all addresses; what
    an import has seen. Also from archives that are opened where they lie."""
    monkeypatch.setattr(archives, "WHOLE_BYTES", whole)
    latin = """<?xml version="1.0" encoding="ISO-8859-1"?><project><id>5</id><title>T</title><organization><id>9</id><legalName>Universit\u00e9</legalName>
        <address><city>X</city></address><address><country>FR</country></address></organization></project>"""
    with zipfile.ZipFile(tmp_path / "l.zip", "w") as z:
        z.writestr("a.xml", latin.encode("latin-1"))
        z.writestr("b.xml", PROJECT.format(id="6").encode("utf-16"))
        z.writestr("c.xml", b"<project>\xff")
        z.writestr("d.xml", b'<?xml version="1.0" encoding="nothing"?><project/>')
    counters = []
    root = str(tmp_path / "db")
    pipeline.import_sources(spark, root, cordis_archives=[("HE", str(tmp_path / "l.zip"))], counters=counters)
    assert counters == [{"origin": "HE", "path": str(tmp_path / "l.zip"), "seen_xml": 4, "projects": 2, "participants": 3}]
    people = {r["pic"]: (r["legal_name"], r["country_code"]) for r in rows(spark, root, "cordis_participants")}
    assert people["9"] == ("Universit\u00e9", "FR") and people["100"] == ("Universit\u00e9 Alpha", "FR")


def test_arguments():
    with pytest.raises(ValueError):
        projects.parse_archive_arguments(["XX=/a"])
    assert projects.parse_archive_arguments(["h2020=/a"]) == [("H2020", "/a")]


def test_follow_communities(spark, dumps, tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    (folder / "d.jsonl").write_text((dumps / "communities.jsonl").read_text())
    for _ in range(2):
        follow_communities(spark, str(folder), str(tmp_path / "db"), str(tmp_path / "cp")).awaitTermination(60)
    assert tables.load(spark, str(tmp_path / "db"), "community_awards").count() == 2
