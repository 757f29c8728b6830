"""Every command on the hand-made dumps."""

import json

from tests.test_run import dumps, root  # noqa: F401

from tessera import cli


def run(spark, *argv):
    cli.run(spark, cli.parser().parse_args([str(a) for a in argv]))


def test_commands(spark, dumps, root, tmp_path, capsys):  # noqa: F811
    run(spark, "report", "--db", root, "--summary-json", tmp_path / "summary.json")
    assert json.loads((tmp_path / "summary.json").read_text())["table_counts"]["ror_orgs"] == 3
    run(spark, "coverage", "--db", root, "--json-out", tmp_path / "c.json", "--markdown-out", tmp_path / "c.md")
    assert json.loads((tmp_path / "c.json").read_text())["communities_in_scope"] == 1
    run(spark, "label-review", "--db", root, "--csv-out-dir", tmp_path / "labels", "--markdown-out", tmp_path / "l.md")
    assert "Bad Label" in (tmp_path / "l.md").read_text()
    run(spark, "review-queue", "--db", root, "--out", tmp_path / "queue.csv")
    assert "1 unresolved PICs, 4 total appearances" in capsys.readouterr().out
    (tmp_path / "o.yaml").write_text('- pic: "200"\n  ror: "x"\n')
    run(spark, "export", "--db", root, "--overrides", tmp_path / "o.yaml", "--out", tmp_path / "pub", "--summary-json", tmp_path / "summary.json")
    assert "4 rows, 1 of them manual" in capsys.readouterr().out
    (tmp_path / "r.yaml").write_text('- pic: "200"\n  ror: "x"\n  reasoning: "Generalized to parent"\n')
    run(spark, "docs", "--db", root, "--reviewed", tmp_path / "r.yaml", "--out", tmp_path / "data.js", "--summary-json", tmp_path / "summary.json")
    data = json.loads((tmp_path / "data.js").read_text().removeprefix("window.DATA = ").rstrip(";\n"))
    assert data["ai_review"] == {"total": 1, "accepted": 1, "unresolved": 0, "generalized": 1, "appearances_covered": 4, "total_unresolved_appearances": 4}


def test_import_and_derive(spark, dumps, tmp_path, capsys):  # noqa: F811
    run(spark, "import", "--db", tmp_path / "db", "--ror-zip", dumps / "ror.zip")
    run(spark, "derive", "--db", tmp_path / "db", "--out", tmp_path / "out")
    assert '"pic_ror_resolutions": 0' in capsys.readouterr().out
