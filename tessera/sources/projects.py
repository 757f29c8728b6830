"""Project XML: one project with its participants a file."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.labels import ORIGINS
from tessera.functions.text import normalize_name
from tessera.schemas import RAW, fit
from tessera.sources.archives import dealt_out, read_zip_xml

# Fixed value: address of a project's page.
PROJECT_PAGE = "https://cordis.europa.eu/project/id/"

_PERSON = ("participant_order", "participant_type", "pic", "legal_name", "short_name", "country_code", "website_url", "vat_number", "rcn")
_PROJECT = ("award_number", "acronym", "title", "programme", "project_website")
_ARROW = pa.struct([(c, pa.string()) for c in _PROJECT] + [("participants", pa.list_(pa.struct([(c, pa.int32() if c == "participant_order" else pa.string()) for c in _PERSON])))])
_DDL = "project struct<" + ", ".join(f"{c}: string" for c in _PROJECT) + ", participants: array<struct<" + ", ".join(f"{c}: {'int' if c == 'participant_order' else 'string'}" for c in _PERSON) + ">>>"


def _name(node: ET.Element) -> str:
    return node.tag.rpartition("}")[2]


def _found(node: ET.Element, path: tuple[str, ...]) -> ET.Element | None:
    """The first element, in document order, that a whole path of local names leads to."""
    if not path:
        return node
    below = (_found(child, path[1:]) for child in node if _name(child) == path[0])
    return next((n for n in below if n is not None), None)


def _text(node: ET.Element, *path: str) -> str:
    """Trimmed text of that element; '' if there is none."""
    found = _found(node, path)
    return (found.text or "").strip() if found is not None else ""


def parse_project(xml: str | bytes) -> dict | None:
    """A project, or None if it can't be parsed or lacks an id or a title.

    Participants are numbered by their place among all organisations of the file, before
    those without a code or name are left out.
    """
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, LookupError, ValueError):  # LookupError: an encoding that isn't known
        return None
    project = {"award_number": _text(root, "id"), "title": _text(root, "title"), "acronym": _text(root, "acronym")}
    if not (project["award_number"] and project["title"]):
        return None
    below: dict[str, list[ET.Element]] = {"programme": [], "webLink": [], "organization": []}
    for node in root.iter():
        if node is not root and _name(node) in below:
            below[_name(node)].append(node)
    # the shortest code, of the unique programme part where there is one
    legal = [(n.get("uniqueProgrammePart", "").lower() != "true", len(code), at, code) for at, n in enumerate(below["programme"]) if n.get("type") == "relatedLegalBasis" and (code := _text(n, "code"))]
    project["programme"] = min(legal)[-1] if legal else ""
    sites = (_text(n, "physUrl") for n in below["webLink"] if n.get("type") == "relatedWebsite" and n.get("represents") == "project")
    project["project_website"] = next(filter(None, sites), "")
    people = (
        {
            "participant_order": at,
            "participant_type": n.get("type", ""),
            "pic": _text(n, "id"),
            "legal_name": _text(n, "legalName"),
            "short_name": _text(n, "shortName"),
            "country_code": _text(n, "address", "country"),
            "website_url": _text(n, "address", "url"),
            "vat_number": _text(n, "vatNumber"),
            "rcn": _text(n, "rcn"),
        }
        for at, n in enumerate(below["organization"], 1)
    )
    project["participants"] = [p for p in people if p["pic"] and p["legal_name"]]
    return project


def parse_projects(members: DataFrame) -> DataFrame:
    """project struct of each member that holds one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [p for value in batch.column(0).to_pylist() if (p := parse_project(value))]
            yield pa.RecordBatch.from_arrays([pa.array(found, _ARROW)], names=["project"])

    return members.select("value").mapInArrow(run, _DDL)


def read_projects(spark: SparkSession, path: str, origin: str, seen: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """cordis_projects and cordis_participants of one archive. `seen` observes the number of
    XML members (seen_xml) as the first of the two is computed."""
    members = read_zip_xml(spark, path)
    if seen is not None:
        members = members.observe(seen, F.count(F.lit(1)).alias("seen_xml"))
    return project_tables(parse_projects(dealt_out(members)), origin)


def project_tables(parsed: DataFrame, origin: str) -> tuple[DataFrame, DataFrame]:
    flat = parsed.select("project.*").withColumn("origin", F.lit(origin))
    projects = flat.withColumn("project_url", F.concat(F.lit(PROJECT_PAGE), "award_number"))
    people = flat.select("award_number", "origin", F.explode("participants").alias("p")).select("award_number", "origin", "p.*")
    people = people.withColumn("normalized_legal_name", normalize_name(F.col("legal_name")))
    return fit(projects, RAW["cordis_projects"]), fit(people, RAW["cordis_participants"])


def parse_archive_arguments(values: list[str]) -> list[tuple[str, str]]:
    """(origin, path) of ORIGIN=PATH arguments; origins are read in any case."""
    out = []
    for value in values:
        origin, equals, path = value.partition("=")
        origin = origin.strip().upper()
        if not equals or not path.strip() or origin not in ORIGINS:
            raise ValueError(f"{value!r}: ORIGIN=PATH is needed, ORIGIN one of {', '.join(ORIGINS)}")
        out.append((origin, path.strip()))
    return out
