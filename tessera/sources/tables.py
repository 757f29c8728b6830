"""Stored tables, exports and small configuration files."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import json_value
from tessera.operators.publish import last_override
from tessera.operators.select import unbroadcast

#: Columns and order of each export; arrays and structs become JSON text.
EXPORT_ORDER = {
    "awards_best": ["award_number"],
    "award_participants_best": ["award_number", "participant_order"],
    "pic_ror_resolutions": ["pic"],
    "community_pic_ror_matches": ["pic", "ror_id"],
    "community_pic_ror_observations": ["pic", "ror_id", "slug", "award_number"],
    "openaire_pic_ror_matches": ["pic", "strategy", "ror_id", "source_record_id"],
    "participant_pic_ror_matches": ["pic", "strategy", "ror_id", "participant_source", "source_origin", "award_number"],
    "suspicious_community_orgs": ["slug", "org_order"],
}
_CSV = {"header": True, "escape": '"', "emptyValue": "", "nullValue": "", "lineSep": "\r\n"}


def save(df: DataFrame, root: str, name: str, by: str | None = None) -> None:
    """Replace a stored table, or with `by` only the values of that column that df holds."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{root}/{name}")


def swap(spark: SparkSession, aside: str, root: str, names: Mapping[str, str | None]) -> None:
    """Put tables that were written aside in the place of the stored ones, by renaming; of a
    table with a column (names[table]), only the values that it holds there. Nothing is read or
    computed between the first rename and the last."""
    jvm = spark.sparkContext._jvm
    path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join(parts))
    store = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def put(new, old) -> None:
        store.delete(old, True)
        store.mkdirs(old.getParent())
        if not store.rename(new, old):
            raise OSError(f"{new} could not be renamed to {old}")

    for name, by in names.items():
        if by is None:
            put(path(aside, name), path(root, name))
            continue
        for part in store.listStatus(path(aside, name)):
            if part.isDirectory():
                put(part.getPath(), path(root, name, part.getPath().getName()))
    store.delete(path(aside), True)


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return unbroadcast(spark.read.parquet(f"{root}/{name}"))


def exists(spark: SparkSession, root: str, name: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def write_csv(df: DataFrame, path: str, order: list, single_file: bool = True) -> None:
    """Ordered CSV with a header; empty strings stay empty, quotes are doubled."""
    flat = df.select(*[json_value(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "struct") else F.col(f.name) for f in df.schema])
    ordered = flat.orderBy(*order)
    (ordered.coalesce(1) if single_file else ordered).write.mode("overwrite").options(**_CSV).csv(path)


def write_csv_or_nothing(df: DataFrame, path: str, order: list) -> None:
    """write_csv, or an empty file without a header where there are no rows."""
    if df.isEmpty():
        df.sparkSession.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        write_csv(df, path, order)


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """CSV as written by write_csv; fails if a required column is missing."""
    df = spark.read.options(header=True, escape='"', multiLine=True).csv(path).fillna("")
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks columns {missing}; it has {df.columns}")
    return df


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with members in order and nulls written; evidence becomes an object."""
    members = []
    for name in sorted(df.columns):
        value = F.coalesce(F.col(name), F.lit("null")) if name == "evidence_json" else json_value(F.col(name))
        members.append(F.concat(F.lit(f'"{name.removesuffix("_json")}":'), value))
    df.orderBy("pic").select(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))).coalesce(1).write.mode("overwrite").text(path)


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    for name, order in EXPORT_ORDER.items():
        write_csv(tables[name], f"{folder}/{name}.csv", order)
    return [f"{folder}/{name}.csv" for name in EXPORT_ORDER]


def write_summary(summary: Mapping, path: str) -> None:
    """A report of bounded size, as JSON with members in order."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(summary, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(pic, ror, note) of a YAML list of overrides; none if the file is missing."""
    entries: list = []
    if Path(path).exists():
        import yaml

        entries = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or []
        if not isinstance(entries, list):
            raise ValueError(f"{path} must hold a list, not {type(entries).__name__}")
    return overrides_table(spark, entries)


def overrides_table(spark: SparkSession, entries: list) -> DataFrame:
    as_text = lambda entry, key: str(entry.get(key) or "")
    rows = [(at, *(as_text(e, k) for k in ("pic", "ror", "note", "reasoning"))) for at, e in enumerate(entries) if isinstance(e, dict)]
    return last_override(spark.createDataFrame(rows, "position int, pic string, ror string, note string, reasoning string"))


def write_dashboard(data: Mapping, path: str) -> None:
    """window.DATA for the static pages."""
    Path(path).write_text(f"window.DATA = {json.dumps(data, indent=2, ensure_ascii=False)};\n", encoding="utf-8")
