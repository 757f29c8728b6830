"""Command line: python -m tessera.cli COMMAND --db FOLDER ...

Commands: import, derive, report, pipeline, coverage, label-review, review-queue, export, docs.
"""

from __future__ import annotations

import argparse
import json
import shlex
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators import reports
from tessera.plans import pipeline, render
from tessera.sources import projects, tables

DEFAULT_DB, DEFAULT_EXPORTS, DEFAULT_SUMMARY = "tmp/org-pipeline/tables", "tmp/org-pipeline/exports", "tmp/org-pipeline/summary.json"


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tessera", description="Entity resolution from dumps to a published mapping.")
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *, sources: bool = False, exports: bool = False, summary: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--db", default=DEFAULT_DB, help="folder of the stored tables")
        if sources:
            sub.add_argument("--cordis-archive", action="append", default=[], metavar="ORIGIN=PATH", help="project archive; may be given for each origin")
            for flag in ("--community-dump", "--openaire-tar", "--ror-zip"):
                sub.add_argument(flag)
            sub.add_argument("--community-parent-slug", default="eu")
        if exports:
            sub.add_argument("--out", default=DEFAULT_EXPORTS, help="folder of the exports")
        if summary:
            sub.add_argument("--summary-json", default=DEFAULT_SUMMARY)
        return sub

    command("import", "read the dumps that are given", sources=True)
    command("derive", "rebuild the derived tables and export them", exports=True)
    command("report", "print and write the summary", summary=True)
    command("pipeline", "import, derive, export and report", sources=True, exports=True, summary=True)
    sub = command("coverage", "coverage report")
    sub.add_argument("--json-out")
    sub.add_argument("--markdown-out")
    sub = command("label-review", "suspicious labels")
    sub.add_argument("--csv-out-dir")
    sub.add_argument("--markdown-out")
    sub = command("review-queue", "codes to look at, most frequent first")
    sub.add_argument("--out", default=f"{DEFAULT_EXPORTS}/review_queue.csv")
    sub.add_argument("--top", type=int, default=30)
    sub = command("export", "mapping with overrides", summary=True)
    sub.add_argument("--overrides")
    sub.add_argument("--out", default="output")
    sub = command("docs", "data of the static pages", summary=True)
    sub.add_argument("--reviewed", help="YAML list of reviewed codes")
    sub.add_argument("--overrides")
    sub.add_argument("--out", default="docs/data.js")
    return out


def _write(path: str | None, text: str) -> None:
    if path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text, encoding="utf-8")


def _sources(args: argparse.Namespace) -> dict:
    return {
        "cordis_archives": projects.parse_archive_arguments(args.cordis_archive),
        "community_dump": args.community_dump,
        "openaire_tar": args.openaire_tar,
        "ror_zip": args.ror_zip,
        "community_parent_slug": args.community_parent_slug,
    }


def _show(value) -> None:
    print(json.dumps(value, indent=2, sort_keys=True))


def queue_summary(queue, top: int = 30, ticks: Sequence[int] = (10, 30, 100, 500, 1000)) -> str:
    """Totals, the first rows, and how much the most frequent codes account for."""
    from tessera.operators import select

    totals = reports.queue_totals(queue).first()
    lines = [f"{totals['pics']} unresolved PICs, {totals['appearances']} total appearances. {totals['with_candidate']} have a review candidate; {totals['without_candidate']} have no guess."]
    for r in queue.orderBy(*reports.queue_order()).limit(top).collect():
        lines.append(f"  {r['pic']:<12} {r['count']:>5}  {r['country']:<3} {r['pipeline_ror'] or '-':<12} {(r['pipeline_source'] or '(no candidate)')[:28]:<28} {r['legal_name'][:55]}")
    if totals["pics"]:
        curve = select.running_share(queue.select("pic", "count"), "count", *reports.queue_order())
        reached = {r["rank"]: r for r in select.at_ranks(curve, ticks, totals["pics"]).collect()}
        last = reached[totals["pics"]]
        for n in ticks:
            r = reached.get(n, last)
            lines.append(f"  top {n:4d}: {r['cumulative']:>6} appearances ({100 * r['share']:.1f}% of unresolved)")
    return "\n".join(lines)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    root = args.db
    if args.command == "import":
        _show(pipeline.import_sources(spark, root, **_sources(args)))
    elif args.command == "derive":
        counts = pipeline.derive_tables(spark, root)
        pipeline.export_tables(spark, root, args.out)
        _show(counts)
    elif args.command == "report":
        summary = pipeline.build_summary(spark, root)
        tables.write_summary(summary, args.summary_json)
        _show(summary)
    elif args.command == "pipeline":
        _show(pipeline.run_pipeline(spark, root, args.out, args.summary_json, **_sources(args)))
    elif args.command == "coverage":
        report = pipeline.build_coverage_report(spark, root)
        _write(args.json_out, json.dumps(report, indent=2, sort_keys=True) + "\n")
        _write(args.markdown_out, render.coverage_markdown(report))
        _show(report)
    elif args.command == "label-review":
        review = pipeline.build_label_review(spark, root)
        if args.csv_out_dir:
            pipeline.write_label_review_csvs(review, args.csv_out_dir)
        if args.markdown_out:
            # these rows are for reading, one by one
            rows = [[r.asDict() for r in review[k].orderBy("slug").collect()] for k in ("likely_wrong_rows", "review_rows", "conflict_rows")]
            again = " ".join(["python", "-m", "tessera.cli", "label-review", "--db", shlex.quote(str(args.db)), "--markdown-out", shlex.quote(str(args.markdown_out))] + (["--csv-out-dir", shlex.quote(str(args.csv_out_dir))] if args.csv_out_dir else []))
            _write(args.markdown_out, render.label_review_markdown(review["summary"], *rows) + f"\n## Rerun\n\n```bash\n{again}\n```\n")
        _show(review["summary"])
    elif args.command == "review-queue":
        queue = pipeline.build_review_queue(spark, root)
        pipeline.write_review_queue(queue, args.out)
        print(queue_summary(queue, args.top))
    elif args.command == "export":
        _export(spark, args)
    elif args.command == "docs":
        summary = json.loads(Path(args.summary_json).read_text(encoding="utf-8")) if Path(args.summary_json).exists() else {}
        queue = pipeline.build_review_queue(spark, root)
        tables.write_dashboard(pipeline.dashboard_data(summary, _merged(spark, args), queue, _reviewed(spark, args.reviewed)), args.out)


def _overrides(spark: SparkSession, path: str | None):
    return tables.read_overrides(spark, path) if path else tables.overrides_table(spark, [])


def _merged(spark: SparkSession, args: argparse.Namespace):
    from tessera.operators.publish import merge_overrides

    return merge_overrides(pipeline.derived_tables(spark, args.db)["pic_ror_resolutions"], _overrides(spark, args.overrides))


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    merged = pipeline.publish_mapping(spark, args.db, _overrides(spark, args.overrides), args.out)
    if Path(args.summary_json).exists():
        _write(f"{args.out}/summary.json", Path(args.summary_json).read_text(encoding="utf-8"))
    manual = merged.where(F.col("source") == "manual_override").count()
    print(f"{merged.count()} rows, {manual} of them manual, in {args.out}")


def _reviewed(spark: SparkSession, path: str | None):
    if not path or not Path(path).exists():
        return None
    import yaml

    entries = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or []
    return spark.createDataFrame([tuple(str(e.get(k) or "") for k in ("pic", "ror", "reasoning")) for e in entries], "pic string, ror string, reasoning string")


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, args)


if __name__ == "__main__":
    main()
