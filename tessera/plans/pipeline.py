"""The whole run: dumps to stored tables, derived tables, exports and reports.

Every stage reads stored Parquet tables and replaces its own, so that a stage can be
run again by itself, and a lost executor costs one stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators import awards, candidates, community, publish, reports, resolve
from tessera.sources import communities, organizations, projects, tables


def import_sources(spark: SparkSession, root: str, *, cordis_archives: Sequence[tuple[str, str]] = (), community_dump: str | None = None, openaire_tar: str | None = None, ror_zip: str | None = None, community_parent_slug: str = "eu", counters: list[dict] | None = None) -> dict[str, int]:
    """Read the dumps that are given and replace their tables. Projects are replaced by
    origin, other sources as a whole. Counts of stored rows by table.

    Everything is written aside and checked first, and only then put in its place by renaming:
    a dump that can't be read, or a key that occurs twice, leaves all stored tables as they
    were. counters receives a dict for each dump: its path, what was seen and what was kept.
    """
    aside = f"{root.rstrip('/')}/.aside-{uuid.uuid4().hex}"
    written: dict[str, str | None] = {}
    counted: list[dict] = []
    try:
        _import_aside(spark, aside, written, counted, cordis_archives, community_dump, openaire_tar, ror_zip, community_parent_slug)
    except BaseException:
        tables.swap(spark, aside, root, {})
        raise
    tables.swap(spark, aside, root, written)
    if counters is not None:
        counters += counted
    return {name: tables.load(spark, root, name).count() for name in written}


def _import_aside(spark: SparkSession, aside: str, written: dict[str, str | None], counted: list[dict], cordis_archives: Sequence[tuple[str, str]], community_dump: str | None, openaire_tar: str | None, ror_zip: str | None, community_parent_slug: str) -> None:
    """Write and check the tables of all dumps in a folder; written and counted take up what is done."""

    def keep(name: str, df: DataFrame, by: str | None = None) -> int:
        tables.save(df, aside, name, by)
        stored = tables.load(spark, aside, name)
        schemas.assert_unique(stored, schemas.KEYS[name], name)
        written[name] = by
        return stored.count()

    for origin, path in cordis_archives:
        seen = Observation()
        found, people = projects.read_projects(spark, path, origin, seen)
        before = [c for c in counted if "seen_xml" in c]
        totals = [keep(name, df, by="origin") - sum(c[kind] for c in before) for name, kind, df in (("cordis_projects", "projects", found), ("cordis_participants", "participants", people))]
        counted.append({"origin": origin, "path": path, "seen_xml": seen.get["seen_xml"], "projects": totals[0], "participants": totals[1]})
    if community_dump:
        names = ("community_awards", "community_award_participants", "community_orgs")
        kept = [keep(name, df) for name, df in zip(names, communities.read_communities(spark, community_dump, community_parent_slug), strict=True)]
        records = spark.read.text(community_dump).where("trim(value) <> ''").count()
        counted.append({"path": community_dump, "records": records, "awards": kept[0], "participants": kept[1], "organizations": kept[2]})
    if openaire_tar:
        counted.append({"path": openaire_tar, "organizations": keep("openaire_orgs", organizations.read_records(spark, openaire_tar))})
    if ror_zip:
        counted.append({"path": ror_zip, "organizations": keep("ror_orgs", organizations.read_registry(spark, ror_zip))})


def raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored raw tables; those that were never imported are empty."""
    return {name: tables.load(spark, root, name).select(*_columns(spark, ddl)) if tables.exists(spark, root, name) else spark.createDataFrame([], ddl) for name, ddl in schemas.RAW.items()}


def _columns(spark: SparkSession, ddl: str) -> list[str]:
    return spark.createDataFrame([], ddl).columns


def derive_tables(spark: SparkSession, root: str) -> dict[str, int]:
    """Rebuild all derived tables, each from stored ones. Counts of rows by table. They are
    written aside and put in place together once the last of them stands."""
    raw, aside = raw_tables(spark, root), f"{root.rstrip('/')}/.aside-{uuid.uuid4().hex}"
    ror, orgs = raw["ror_orgs"], raw["openaire_orgs"]
    done: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        tables.save(schemas.fit(df, schemas.DERIVED[name]), aside, name)
        done[name] = tables.load(spark, aside, name)
        return done[name]

    suspicious = keep("suspicious_community_orgs", community.suspicious_orgs(raw["community_orgs"], ror))
    openaire = keep("openaire_pic_ror_matches", candidates.openaire_matches(orgs, ror))
    people = keep("participant_pic_ror_matches", candidates.participant_matches(raw["cordis_participants"], orgs, ror))
    observed = keep("community_pic_ror_observations", community.observations(raw["community_award_participants"], raw["community_orgs"], suspicious, ror))
    matches = keep("community_pic_ror_matches", community.community_matches(observed, openaire))
    resolved = keep("pic_ror_resolutions", resolve.traced_resolutions(openaire, people, matches, observed, ror))
    best = keep("awards_best", awards.best_awards(raw["cordis_projects"], raw["community_awards"]))
    keep("award_participants_best", awards.best_participants(best, raw["cordis_participants"], raw["community_award_participants"], resolved))
    counts = {name: df.count() for name, df in done.items()}
    tables.swap(spark, aside, root, dict.fromkeys(done))
    return counts


def derived_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: tables.load(spark, root, name) for name in schemas.DERIVED}


def export_tables(spark: SparkSession, root: str, folder: str) -> list[str]:
    return tables.export_tables(derived_tables(spark, root), folder)


def build_summary(spark: SparkSession, root: str) -> dict:
    raw, derived = raw_tables(spark, root), derived_tables(spark, root)
    by = lambda column: {r[column]: r["count"] for r in reports.counts_by(derived["pic_ror_resolutions"], column).collect()}
    quality = reports.label_quality(raw["community_orgs"], derived["suspicious_community_orgs"]).collect()
    return {
        "db": root,
        "table_counts": reports.table_counts(raw | derived),
        "resolution_confidence": by("confidence"),
        "resolution_source": by("source"),
        "community_label_quality": {r["bucket"]: r["count"] for r in quality},
    }


def run_pipeline(spark: SparkSession, root: str, export_dir: str, summary_path: str | None = None, **sources) -> dict:
    import_sources(spark, root, **sources)
    derive_tables(spark, root)
    export_tables(spark, root, export_dir)
    summary = build_summary(spark, root)
    if summary_path:
        tables.write_summary(summary, summary_path)
    return summary


def _rounded(value):
    """To one decimal, halves of the binary value to even; whole numbers as integers."""
    if value is None or isinstance(value, int):
        return value
    value = round(value, 1)
    return int(value) if value.is_integer() else value


def _row(df: DataFrame) -> dict:
    return {k: _rounded(v) for k, v in df.first().asDict().items()}


def _labelled(df: DataFrame, label: str) -> dict:
    return {r[label]: {k: _rounded(v) for k, v in r.asDict().items() if k not in (label, "position")} for r in df.orderBy("position").collect()}


def build_coverage_report(spark: SparkSession, root: str, with_types: bool = True) -> dict:
    """Coverage of communities and awards. Only aggregates reach the driver."""
    raw, derived = raw_tables(spark, root), derived_tables(spark, root)
    listed, people = raw["community_awards"], derived["award_participants_best"]
    by_community = reports.community_coverage(listed, people).persist()
    by_award = reports.award_coverage(listed, people).persist()
    bins = lambda column: {r["bin"]: r["n"] for r in reports.coverage_distribution(by_community, column).orderBy("position").collect()}
    report = {
        "generated_at": datetime.now(UTC).replace(microsecond=0).isoformat(),
        "db_path": root,
        "communities_in_scope": by_community.count(),
        "active_awards_in_scope": by_award.count(),
        "participant_list_availability": _row(reports.availability(by_community)),
        "coverage_per_community": _row(reports.coverage_summary(by_community)) | {"distribution_high_medium_pct": bins("high_medium"), "distribution_any_pct": bins("any")},
        "coverage_per_award": _row(reports.award_summary(by_award)),
        "coverage_by_source_bucket": _labelled(reports.coverage_by_source_bucket(by_community), "source_bucket"),
        "coverage_by_project_size": _labelled(reports.coverage_by_size(by_community), "band"),
        "coordinator_coverage_cordis_only": _row(reports.coordinator_coverage(listed, people, by_community)),
    }
    if with_types:
        found = reports.resolved_types(listed, people, raw["ror_orgs"]).collect()
        report["resolved_ror_types"] = {column: {r["ror_type"]: r[column] for r in sorted(found, key=lambda r: -r[column]) if r[column]} for column in ("occurrences", "unique_pic")}
    by_community.unpersist()
    by_award.unpersist()
    return report


def build_label_review(spark: SparkSession, root: str) -> dict[str, DataFrame | dict]:
    raw, derived = raw_tables(spark, root), derived_tables(spark, root)
    suspicious = derived["suspicious_community_orgs"]
    wrong = reports.likely_wrong(suspicious, raw["ror_orgs"])
    review = reports.review_rows(suspicious, wrong)
    conflicts = reports.conflict_rows(derived["community_pic_ror_observations"], derived["community_pic_ror_matches"], derived["openaire_pic_ror_matches"], raw["ror_orgs"])
    return {"likely_wrong_rows": wrong, "review_rows": review, "conflict_rows": conflicts, "summary": reports.label_summary(suspicious, wrong, review, conflicts)}


def write_label_review_csvs(review: Mapping[str, DataFrame], folder: str) -> None:
    for name, key, order in (("likely-wrong-community-orgs", "likely_wrong_rows", ["slug", "org_order"]), ("review-community-orgs", "review_rows", ["slug", "org_order"]), ("community-org-conflicts", "conflict_rows", ["slug", "pic"])):
        tables.write_csv_or_nothing(review[key], f"{folder}/{name}.csv", order)


def build_review_queue(spark: SparkSession, root: str) -> DataFrame:
    raw, derived = raw_tables(spark, root), derived_tables(spark, root)
    return reports.review_queue(raw["cordis_participants"], derived["pic_ror_resolutions"], reports.openaire_signals(raw["openaire_orgs"]))


def write_review_queue(queue: DataFrame, path: str) -> None:
    tables.write_csv(queue, path, reports.queue_order())


def publish_mapping(spark: SparkSession, root: str, overrides: DataFrame, folder: str) -> DataFrame:
    """The mapping with overrides: a slim CSV and JSON lines with the trace."""
    merged = publish.merge_overrides(derived_tables(spark, root)["pic_ror_resolutions"], overrides)
    tables.write_csv(merged.select("pic", "ror_id", "confidence", "source"), f"{folder}/pic_mapping.csv", ["pic"])
    tables.write_jsonl(merged, f"{folder}/pic_mapping.jsonl")
    return merged


def dashboard_data(summary: Mapping, mapping: DataFrame, queue: DataFrame, reviewed: DataFrame | None = None, preview: int = 50, ticks: Sequence[int] = (10, 30, 100, 300, 1000, 3000, 10000)) -> dict:
    """What the static pages show; curves are sampled before they are collected."""
    from tessera.operators import select

    n = queue.count()
    curve = select.running_share(queue.select("pic", "count"), "count", *reports.queue_order())
    totals = reports.queue_totals(queue).first()
    shown = ["pic", "count", "country", "short_name", "legal_name", "pipeline_ror", "pipeline_confidence"]
    points = lambda df: [{k: v for k, v in r.asDict().items() if k != "rank"} for r in df.orderBy("rank").collect()]
    return {
        "summary": {k: summary.get(k, {}) for k in ("table_counts", "resolution_confidence", "resolution_source", "community_label_quality")},
        "resolutions": {
            "total": mapping.count(),
            "by_confidence": {r["confidence"]: r["count"] for r in reports.counts_by(mapping, "confidence").orderBy(F.desc("count"), "confidence").collect()},
            "by_source": [r.asDict() for r in reports.top_sources(mapping).collect()],
        },
        "review_queue": {
            "total_pics": n,
            "total_appearances": totals["appearances"],
            "top": [r.asDict() for r in queue.orderBy(*reports.queue_order()).limit(preview).select(*shown).collect()],
            "coverage_curve": points(select.at_ranks(curve, ticks, n).select(F.col("rank").alias("top_n"), F.col("cumulative").alias("appearances"), F.col("share").alias("pct"), "rank")) if n else [],
            "cumulative": points(select.every_step(curve, n).select(F.col("rank").alias("top_n"), F.col("share").alias("pct"), "rank")) if n else [],
        },
        "ai_review": reports.review_statistics(reviewed, queue).first().asDict() if reviewed is not None else None,
    }
