"""Queries that read all rows and whole texts of their tables."""

import re
import unicodedata

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.plans import standins
from tessera.plans.bindings import QUERIES

DATA = "/root/testdata/sf0.001"


def test_fuzzy_best_match_meets_every_record(spark):
    found = {r["record"][-1] for r in QUERIES["fuzzy_best_match"](spark, DATA).collect()}
    assert found - {"2", "7"}


def test_document_names_hold_every_line(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for row in QUERIES["normalize_document_names"](spark, DATA).collect():
        plain = unicodedata.normalize("NFKD", texts[row["doc_id"]]).encode("ascii", "ignore").decode().lower()
        words = re.sub("[^a-z0-9]+", " ", plain.replace("&", " and ")).split()
        found = row["normalized"].split()
        assert found == words[: len(found)]
        ending = " " + " ".join(words[len(found) :])
        assert ending == " " or re.fullmatch("(?: (?:" + "|".join(text.CORPORATE_SUFFIXES) + "))+", ending)


def test_participant_candidates_have_codes_that_no_record_lists(spark):
    listed = {r["pic"] for r in standins.orgs(spark, DATA).select(F.explode("pics").alias("pic")).collect()}
    found = {r["pic"] for r in QUERIES["participant_candidates"](spark, DATA).select("pic").collect()}
    assert found and not found & listed
