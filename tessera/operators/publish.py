"""Merging hand-made overrides into the mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.reports import accepted

MANUAL = ("manual", "manual_override")


def merge_overrides(resolutions: DataFrame, overrides: DataFrame) -> DataFrame:
    """(pic, ror_id, confidence, source, evidence_json, override_note).

    An override replaces a code's row; one without a target drops it; an override of a
    code without a row adds one. Other rows are published if their confidence is accepted.
    overrides: (pic, ror, note), one row a code.
    """
    mine = overrides.select("pic", F.col("ror").alias("ror__"), F.col("note").alias("note__"))
    joined = resolutions.join(mine, "pic", "full_outer")
    manual = F.col("ror__").isNotNull()
    kept = joined.where((manual & (F.col("ror__") != "")) | (~manual & accepted(F.col("confidence"))))
    pick = lambda own, value: F.when(manual, own).otherwise(value)
    return kept.select(
        "pic",
        pick(F.col("ror__"), F.col("ror_id")).alias("ror_id"),
        pick(F.lit(MANUAL[0]), F.col("confidence")).alias("confidence"),
        pick(F.lit(MANUAL[1]), F.col("source")).alias("source"),
        F.when(~manual, F.col("evidence_json")).alias("evidence_json"),
        F.when(manual & (F.col("note__") != ""), F.col("note__")).alias("override_note"),
    )


def last_override(entries: DataFrame) -> DataFrame:
    """(pic, ror, note) from entries(position, pic, ror, note, reasoning): entries without
    a code are skipped, the last of a code counts, and a note falls back to the reasoning."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    note = F.when(F.coalesce("note", F.lit("")) != "", text("note")).otherwise(text("reasoning"))
    rows = entries.select("position", text("pic").alias("pic"), text("ror").alias("ror"), note.alias("note")).where("pic != ''")
    last = rows.groupBy("pic").agg(F.max_by(F.struct("ror", "note"), "position").alias("last"))
    return last.select("pic", "last.ror", "last.note")
