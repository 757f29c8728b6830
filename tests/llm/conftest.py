import pytest

SMALL = "/root/testdata/sf0.001"
#: Texts that operators must take: null, empty, blank, tiny, repeated, long, odd characters.
ODD_TEXTS = [
    None,
    "",
    " \t\n\r ",
    "word",
    "Two Words\nTwo Words\n\nend",
    "ﬁ ½ ​ Ünḯcödé 漢字 😀 \x1c\x85 '' 's we'll",
    "same text again " * 40,
    "same text again " * 40,
    "x" * 50_000 + " " + "long text of many words " * 4000,
    "Licensed under the Apache License, Version 2.0. CC BY-NC 4.0 MIT License.",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, ids null and repeated, rows repeated in full, columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4], (None, "a null id here", None, None), (3, "another text of id three", "fr", "src1")]
    clash = ["n_words", "fingerprint", "host", "key", "tokens", "id", "v", "part", "block", "lines", "row__", "text__", "verdict", "share", "group_id"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame([(*r, len(r[1] or ""), *(["?"] * len(clash))) for r in rows], schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
