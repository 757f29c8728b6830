"""Reports as Markdown. Input is small: aggregates, and rows meant for reading."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence


def cell(value) -> str:
    """Text of a table cell; bars are escaped, nothing is a dash."""
    return "-" if value is None else str(value).replace("|", "\\|")


def table(header: Sequence[str], rows: Iterable[Sequence], right: Sequence[int] = ()) -> list[str]:
    rule = ["---:" if at in right else "---" for at in range(len(header))]
    return [f"| {' | '.join(line)} |" for line in (header, rule, *([cell(v) for v in row] for row in rows))]


def coverage_markdown(report: Mapping) -> str:
    """The coverage report: scope, medians, bands, sizes, sources, coordinators, types."""
    seen, community, award = report["participant_list_availability"], report["coverage_per_community"], report["coverage_per_award"]
    lead = report["coordinator_coverage_cordis_only"]
    out = [
        "# Organizations ROR Coverage", "", f"Generated from `{report['db_path']}` on {report['generated_at']}.", "", "## Scope", "",
        f"- Award-bearing active EU communities in scope: `{report['communities_in_scope']}`",
        f"- Active awards in scope: `{report['active_awards_in_scope']}`",
        f"- Communities with any participant list: `{seen['communities_with_participants']}` (`{seen['pct_with_participants']}%`)",
        f"- Communities without any participant list: `{seen['communities_without_participants']}`", "", "## Key Numbers", "",
    ]
    for name, block in (("community", community), ("award", award)):
        for label, key in (("high+medium", "median_high_medium_pct"), ("any", "median_any_pct")):
            out.append(f"- Median per {name}, `{label}` ROR coverage: `{block[key]}%`")
    out += ["", "## Coverage Bands Per Community", ""]
    for label, key in (("High+Medium band", "distribution_high_medium_pct"), ("Any-confidence band", "distribution_any_pct")):
        out += [*table([label, "Communities"], community[key].items(), [1]), ""]
    out += ["## Coverage By Project Size", "", *table(["Participant count", "Communities", "Median high+medium %", "Median any %"], ((k, v["communities"], v["median_hm_pct"], v["median_any_pct"]) for k, v in report["coverage_by_project_size"].items()), [1, 2, 3]), ""]
    columns = ("communities", "with_participants", "median_participants", "median_hm_pct", "median_any_pct")
    out += ["## Coverage By Participant Source", "", *table(["Source bucket", "Communities", "With participants", "Median participants", "Median high+medium %", "Median any %"], ((k, *(v[c] for c in columns)) for k, v in report["coverage_by_source_bucket"].items()), range(1, 6)), ""]
    out += ["## Coordinator Coverage", "", f"- Communities with official participant rows: `{lead['communities_with_cordis_participants']}`"]
    for label, key in (("high+medium", "hm"), ("any", "any")):
        out.append(f"- Communities with a coordinator resolved at `{label}`: `{lead[f'communities_with_resolved_coordinator_{key}']}` (`{lead[f'pct_with_resolved_coordinator_{key}']}%`)")
    if kinds := report.get("resolved_ror_types"):
        names = sorted({*kinds["unique_pic"], *kinds["occurrences"]})
        out += ["", "## Resolved ROR Types", "", *table(["ROR type", "Unique resolved PICs", "Participant occurrences"], ((k, kinds["unique_pic"].get(k, 0), kinds["occurrences"].get(k, 0)) for k in names), [1, 2])]
    return "\n".join(out) + "\n"


def label_review_markdown(summary: Mapping, wrong: Iterable[Mapping], review: Iterable[Mapping], conflicts: Iterable[Mapping]) -> str:
    """The label review: likely wrong links, weaker mismatches, conflicts."""
    out = ["# Community Organization Label Review", "", "## Summary", ""]
    for label, key in (
        ("Suspicious community org rows", "suspicious_rows"), ("Communities with any suspicious row", "suspicious_communities"), ("Likely wrong rows", "likely_wrong_rows"),
        ("Communities with likely wrong rows", "likely_wrong_communities"), ("Weaker review rows", "review_rows"), ("Participant/OpenAIRE conflict rows", "conflict_rows"),
    ):
        out.append(f"- {label}: `{summary[key]}`")
    assigned = lambda r: f"{r['ror_id']} ({r['ror_display_name']})"
    out += ["", "## Likely Wrong ROR Links", "", *table(["Community", "Org #", "Community label", "Assigned ROR", "Better exact ROR match"], ((r["slug"], r["org_order"], r["name"], assigned(r), r["other_rors"]) for r in wrong), [1])]
    out += ["", "## Weaker Label Mismatches", "", *table(["Community", "Org #", "Community label", "Assigned ROR", "Reason"], ((r["slug"], r["org_order"], r["name"], assigned(r), r["reason"]) for r in review), [1])]
    pair = lambda r, side: f"{r[f'{side}_ror_id']} ({r[f'{side}_ror_name']})"
    out += ["", "## Participant/OpenAIRE Conflicts", "", *table(["Community", "PIC", "Participant name", "Community-linked ROR", "OpenAIRE direct ROR"], ((r["slug"], r["pic"], r["participant_name"], pair(r, "community"), pair(r, "openaire")) for r in conflicts))]
    return "\n".join(out) + "\n"
