"""Names, domains and identifiers as Spark columns.

Everything is a composition of built-in functions but for the one step Spark lacks:
compatibility decomposition of non-ASCII letters, an Arrow-batched function.
Missing values are empty strings, as in the stored tables.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Endings of company names, and words too general to be a name.
CORPORATE_SUFFIXES = (
    "ab", "ag", "aps", "as", "bv", "co", "doo", "eirl", "ev", "geie", "gmbh", "inc", "ivzw", "kft", "kg", "limited", "llc", "ltd",
    "nv", "oy", "oyj", "plc", "pte", "sa", "sarl", "sas", "sci", "sl", "slu", "spa", "sprl", "srl", "sro", "vzw", "zoo",
)
GENERIC_NAMES = ("agency", "association", "centre", "center", "college", "foundation", "institute", "museum", "university")

_SUFFIX_RUN = "(?:(?:^| )(?:" + "|".join(CORPORATE_SUFFIXES) + "))+$"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def strip(column: Column) -> Column:
    """Without white space of any script at either end; null gives ''."""
    return F.regexp_replace(text_or_empty(column), _EDGE_SPACE, "")


@F.pandas_udf(StringType())
def to_ascii(names: pd.Series) -> pd.Series:
    """Compatibility decomposition, without what then isn't ASCII."""
    return names.map(lambda s: unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii"), na_action="ignore")


def normalize_name(column: Column, ascii_input: bool = False) -> Column:
    """Lower-case ASCII words of a name without trailing company endings.

    Accents go with their base letter kept, other non-ASCII characters are deleted,
    '&' reads 'and', other ASCII punctuation separates words. ascii_input skips the
    decomposition, and with it Python, where the input is known to be ASCII.
    """
    text = text_or_empty(column)
    if not ascii_input:
        # only names that need it travel to Python; of the others it sees a null
        text = F.coalesce(to_ascii(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)
    text = F.lower(text)
    words = F.trim(F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))
    return F.regexp_replace(words, _SUFFIX_RUN, "")


def tokens(column: Column) -> Column:
    """Words of a normalized name; none for ''."""
    return F.filter(F.split(text_or_empty(column), " "), lambda t: t != "")


def token_sort_key(column: Column) -> Column:
    """The words in order, repeats kept."""
    return F.array_join(F.array_sort(tokens(column)), " ")


def is_meaningful_alias(normalized: Column) -> Column:
    """A name that can stand for an organisation: not empty, not a company ending, not
    a general word, not a single word of under four letters."""
    return (normalized != "") & ~normalized.isin(*CORPORATE_SUFFIXES, *GENERIC_NAMES) & (normalized.contains(" ") | (F.length(normalized) >= 4))


def is_meaningful_fuzzy(normalized: Column) -> Column:
    """A name long enough for inexact comparison: two words, or eight letters."""
    return is_meaningful_alias(normalized) & (normalized.contains(" ") | (F.length(normalized) >= 8))


def fuzzy_block_keys(normalized: Column) -> Column:
    """Keys that names to compare share at least one of: six first letters without
    spaces, four first letters of the first and of the last word."""
    words = tokens(normalized)
    compact = F.replace(normalized, F.lit(" "), F.lit(""))
    keys = F.array(
        F.concat(F.lit("compact:"), F.substring(compact, 1, 6)),
        F.concat(F.lit("first:"), F.substring(F.try_element_at(words, F.lit(1)), 1, 4)),
        F.concat(F.lit("last:"), F.substring(F.try_element_at(words, F.lit(-1)), 1, 4)),
    )
    return F.when(normalized == "", F.array().cast("array<string>")).otherwise(F.array_distinct(keys))


def letters_mask(normalized: Column) -> Column:
    """Bit set of the letters and digits that a normalized name holds."""
    alphabet = "abcdefghijklmnopqrstuvwxyz0123456789"
    out = F.lit(0).cast("long")
    for at, char in enumerate(alphabet):
        out = out.bitwiseOR(F.when(normalized.contains(char), F.lit(1 << at)).otherwise(F.lit(0)).cast("long"))
    return out


def normalize_domain(column: Column) -> Column:
    """Host of a URL or of a bare domain: lower case, without user, port, outer dots and
    one leading 'www.'."""
    given = F.regexp_replace(strip(column), "[\t\r\n]", "")
    url = F.when(given.contains("://"), given).otherwise(F.concat(F.lit("https://"), given))
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
    after = F.regexp_replace(url, scheme, "")
    host = F.regexp_extract(after, r"^//([^/?#]*)", 1)
    path = F.regexp_extract(F.regexp_replace(after, r"^//(?=[/?#]|$)", ""), r"^([^?#]*)", 1)
    host = F.lower(F.when(host != "", host).otherwise(path))
    host = F.substring_index(F.substring_index(host, "@", -1), ":", 1)
    host = F.regexp_replace(F.regexp_replace(host, r"^\.+|\.+$", ""), r"^www\.", "")
    return F.when(given == "", "").otherwise(host)


def domains_of(urls: Column) -> Column:
    """Distinct hosts of an array of URLs, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(urls, F.array().cast("array<string>")), normalize_domain), lambda h: h != "")))


def short_ror_id(column: Column) -> Column:
    """Last part of a registry URL, or the bare id; case is kept."""
    return strip(F.substring_index(F.regexp_replace(text_or_empty(column), "/+$", ""), "/", -1))


def normalize_identifier(scheme: str, column: Column) -> Column:
    out = F.lower(strip(column))
    return F.regexp_replace(out, r"(?U)\s+", "") if scheme == "isni" else out


def looks_like_ror_id(column: Column) -> Column:
    return text_or_empty(column).rlike(r"\A[0-9a-z]{9}\z")


def classify_provided_id(column: Column) -> Column:
    """none, edmo, ror or other."""
    value = strip(column)
    return F.when(value == "", "none").when(value.startswith("edmo:"), "edmo").when(looks_like_ror_id(value), "ror").otherwise("other")


def first_identifier(identifiers: Column, scheme: str) -> Column:
    """First non-empty identifier of a scheme in array<struct<scheme, identifier>>; '' if none."""
    hits = F.filter(F.coalesce(identifiers, F.array()), lambda i: (i["scheme"] == scheme) & (strip(i["identifier"]) != ""))
    return strip(F.get(hits, F.lit(0))["identifier"])


def community_ror_id(top_level: Column, identifiers: Column) -> Column:
    """The id itself where it has a registry id's shape, else the first 'ror' identifier."""
    own = strip(top_level)
    return F.when(looks_like_ror_id(own), own).otherwise(short_ror_id(first_identifier(identifiers, "ror")))


def localized_title(column: Column) -> Column:
    """A plain title, or the English (else the first) value of a JSON object of titles."""
    raw = text_or_empty(column)
    as_map = F.from_json(raw, "map<string,string>")
    english = F.try_element_at(as_map, F.lit("en"))
    chosen = F.when(text_or_empty(english) != "", english).otherwise(F.get(F.map_values(as_map), F.lit(0)))
    return strip(F.when(raw.startswith("{") & as_map.isNotNull(), chosen).otherwise(raw))


def json_strings(column: Column) -> Column:
    """Strings of a JSON array; none for anything else. Null members are left out."""
    return F.filter(F.coalesce(F.from_json(column, "array<string>"), F.array().cast("array<string>")), lambda x: x.isNotNull())


def sorted_set(column: Column) -> Column:
    """Distinct non-empty members, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(column, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))))


def json_value(column: Column) -> Column:
    """JSON text of any value, nulls as null."""
    wrapped = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / whole


def round_percent(part: Column, whole: Column) -> Column:
    """Percentage to one decimal, 0 where there is nothing to count."""
    return F.when(whole == 0, 0.0).otherwise(F.bround(percent(part, whole), 1))
