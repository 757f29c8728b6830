"""Codes and their texts. All of this is fixed values: consumers read these strings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ORIGINS = ("HE", "H2020", "FP7")

CONFIDENCE = {
    "direct_unique": "high",
    "external_id_unique": "medium",
    "domain_unique": "medium",
    "name_country_unique": "review",
    "alt_name_country_unique": "review",
    "short_name_country_unique": "review",
    "token_sort_name_country_unique": "review",
    "fuzzy_name_country_unique": "review",
    "fuzzy_alias_country_unique": "review",
    "direct_ambiguous": "review",
    "participant_name_country_unique": "review",
    "participant_token_sort_name_country_unique": "review",
    "participant_fuzzy_name_country_unique": "review",
}
GROUP = {
    "direct_unique": "direct_unique",
    "direct_ambiguous": "direct_ambiguous",
    "external_id_unique": "external",
    "domain_unique": "domain",
    "name_country_unique": "exact_name",
    "alt_name_country_unique": "exact_name",
    "short_name_country_unique": "exact_name",
    "participant_name_country_unique": "exact_name",
    "token_sort_name_country_unique": "token_sort",
    "participant_token_sort_name_country_unique": "token_sort",
    "fuzzy_name_country_unique": "fuzzy_name",
    "fuzzy_alias_country_unique": "fuzzy_name",
    "participant_fuzzy_name_country_unique": "fuzzy_name",
}
GROUPS = {
    "community": "community label",
    "direct_ambiguous": "direct ROR link, but ambiguous",
    "direct_unique": "direct ROR link",
    "domain": "website domain",
    "exact_name": "same name + same country",
    "external": "external id",
    "fuzzy_name": "close name + same country",
    "token_sort": "same name + same country, ignoring word order",
}
RULES = {
    "direct_unique": "direct ROR link in OpenAIRE",
    "direct_ambiguous": "multiple direct ROR links in OpenAIRE",
    "external_id_unique": "same external id",
    "domain_unique": "same website domain",
    "name_country_unique": "same name in the same country",
    "alt_name_country_unique": "same alternative name in the same country",
    "fuzzy_name_country_unique": "close name in the same country",
    "fuzzy_alias_country_unique": "close alternative name in the same country",
    "short_name_country_unique": "same short name in the same country",
    "token_sort_name_country_unique": "same name in the same country, ignoring word order",
    "participant_fuzzy_name_country_unique": "close participant name in the same country",
    "participant_name_country_unique": "same participant name in the same country",
    "participant_token_sort_name_country_unique": "same participant name in the same country, ignoring word order",
}
EXPLANATIONS = {
    "direct_unique": "OpenAIRE already links this PIC to exactly one ROR.",
    "direct_ambiguous": "OpenAIRE lists more than one ROR for this PIC.",
    "external_id_unique": "An external identifier points to exactly one ROR.",
    "domain_unique": "The website domain points to exactly one ROR.",
    "name_country_unique": "The organization name, after normalization, matches one ROR in the same country.",
    "alt_name_country_unique": "An alternative organization name matches one ROR in the same country.",
    "fuzzy_name_country_unique": "A close organization name match points to one ROR in the same country.",
    "fuzzy_alias_country_unique": "A close alternative organization name match points to one ROR in the same country.",
    "short_name_country_unique": "A short organization name matches one ROR in the same country.",
    "token_sort_name_country_unique": "The normalized name matches one ROR in the same country after ignoring word order.",
    "participant_fuzzy_name_country_unique": "A close participant legal name match points to one ROR in the same country.",
    "participant_name_country_unique": "The participant legal name matches one ROR in the same country.",
    "participant_token_sort_name_country_unique": "The participant legal name matches one ROR in the same country after ignoring word order.",
}
SOURCES = {
    "openaire_direct": "direct ROR link from OpenAIRE",
    "community_supported": "community match confirmed by other evidence",
    "openaire_ambiguous_external": "OpenAIRE had several RORs, external id picked one",
    "openaire_ambiguous_domain": "OpenAIRE had several RORs, website domain picked one",
    "openaire_ambiguous_exact_name": "OpenAIRE had several RORs, exact name picked one",
    "openaire_ambiguous_fuzzy_name": "OpenAIRE had several RORs, close name picked one",
    "openaire_ambiguous_token_sort": "OpenAIRE had several RORs, word-order-insensitive name picked one",
    "openaire_external_domain": "external id and website domain agree",
    "openaire_external_name": "external id and exact name agree",
    "openaire_domain_fuzzy_name": "website domain and close name agree",
    "openaire_domain_name": "website domain and exact name agree",
    "community_repeat": "same community-based match seen more than once",
    "openaire_external": "external id only",
    "openaire_domain": "website domain only",
    "openaire_name_country": "exact OpenAIRE name + country",
    "openaire_alt_name_country": "exact OpenAIRE alternative name + country",
    "openaire_fuzzy_name": "close OpenAIRE name + country",
    "openaire_fuzzy_alias_country": "close OpenAIRE alternative name + country",
    "openaire_short_name_country": "exact OpenAIRE short name + country",
    "participant_fuzzy_name": "close participant name + country",
    "participant_name_country": "exact participant name + country",
    "openaire_token_sort_name": "same OpenAIRE name + country, ignoring word order",
    "participant_token_sort_name": "same participant name + country, ignoring word order",
    "exact_name": "exact name + country",
    "fuzzy_name": "close name + country",
    "token_sort_name": "same name + country, ignoring word order",
    "community_single": "single community-based match",
}
SUPPORTERS = {"community": "community data", "openaire": "OpenAIRE", "participant": "project participant data"}
KINDS = {
    "external_id_unique": "exact identifier match",
    "domain_unique": "exact domain match",
    "name_country_unique": "exact name + country",
    "alt_name_country_unique": "exact alias + country",
    "short_name_country_unique": "exact alias + country",
    "fuzzy_name_country_unique": "fuzzy name + country",
    "fuzzy_alias_country_unique": "fuzzy name + country",
    "token_sort_name_country_unique": "same words + same country",
    "direct_unique": "direct ROR id check",
    "direct_ambiguous": "direct ROR id check",
    "participant_name_country_unique": "exact name + country",
    "participant_token_sort_name_country_unique": "same words + same country",
    "participant_fuzzy_name_country_unique": "fuzzy name + country",
}
NO_SCORE = "This rule is exact, so no similarity score was calculated."
NO_SCORE_PICKED = "The resolver only used exact rule outputs here. No fuzzy score was calculated."
FUZZY_ACCEPTED = "Accepted because the best same-country ROR cleared the fuzzy threshold and stayed ahead of the next-best ROR by the minimum margin."
FUZZY_METHOD = "max(ratio, token_sort_ratio, token_set_ratio)"
OBSERVED_RULE = "Same participant name inside this community"
OBSERVED_WHY = "Inside this community, the participant name matched a single ROR-backed organization label."
OBSERVED_KIND = "exact name inside one community"


def lookup(code: Column, table: Mapping[str, str]) -> Column:
    """Text of a code; an unknown code with spaces for underscores."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.replace(code, F.lit("_"), F.lit(" ")))


def supporter_label(code: Column) -> Column:
    where, rule = F.substring_index(code, ":", 1), F.regexp_replace(code, "^[^:]*:?", "")
    return F.concat(F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in SUPPORTERS.items() for x in p]), where), where), F.lit(": "), lookup(rule, RULES))
