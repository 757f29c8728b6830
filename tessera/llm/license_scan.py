"""License scans: ordered signature rules.

Texts are reduced to lower-cased words with one space between them, so that layout and
punctuation don't matter. Each rule is a regex over those words with a label, a
priority and keywords that every match must contain. One Aho-Corasick pass over the
words finds which keywords occur; only rules with all of theirs run. Overlapping detections are
resolved in order of priority, then length: one that lies within the interval of a
better one is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import tidy

#: Every byte that is no word byte (0-9, a-z and all of UTF-8's other bytes) becomes a space.
_SPACED = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

#: Fixed phrases that every scan reports, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Licenses: label, name as words (a regex), short identifiers as words.
_LICENSES = [
    ("mit", "mit", ["mit", "x11"]),
    ("mit-0", "mit no attribution", ["mit 0"]),
    ("apache-1.1", "apache(?: software)? license version 1 1", ["apache 1 1"]),
    ("apache-2.0", "apache(?: software)? license(?: version)? 2(?: 0)?", ["apache 2 0", "apache2"]),
    ("gpl-1.0", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 1", ["gpl 1 0", "gplv1"]),
    ("gpl-2.0", "gnu general public license(?: as published by the free software foundation)?(?: either)? (?:version|v) ?2", ["gpl 2 0", "gplv2", "gpl 2"]),
    ("gpl-3.0", "gnu general public license(?: as published by the free software foundation)?(?: either)? (?:version|v) ?3", ["gpl 3 0", "gplv3", "gpl 3"]),
    ("lgpl-2.0", "gnu library general public license(?: version 2)?", ["lgpl 2 0"]),
    ("lgpl-2.1", "gnu lesser general public license(?: version| v)? 2 1", ["lgpl 2 1", "lgplv2 1"]),
    ("lgpl-3.0", "gnu lesser general public license(?: version| v)? 3", ["lgpl 3 0", "lgplv3"]),
    ("agpl-3.0", "gnu affero general public license(?: version| v)? 3", ["agpl 3 0", "agplv3"]),
    ("gfdl-1.2", "gnu free documentation license version 1 2", ["gfdl 1 2"]),
    ("gfdl-1.3", "gnu free documentation license(?: version 1 3)?", ["gfdl 1 3", "gfdl"]),
    ("mpl-1.1", "mozilla public license(?: version| v)? 1 1", ["mpl 1 1"]),
    ("mpl-2.0", "mozilla public license(?: version| v)?(?: 2(?: 0)?)?", ["mpl 2 0"]),
    ("epl-1.0", "eclipse public license(?: version| v)? 1 0", ["epl 1 0"]),
    ("epl-2.0", "eclipse public license(?: version| v)?(?: 2(?: 0)?)?", ["epl 2 0"]),
    ("cddl-1.0", "common development and distribution license(?: version 1 0)?", ["cddl 1 0"]),
    ("cddl-1.1", "common development and distribution license version 1 1", ["cddl 1 1"]),
    ("cpl-1.0", "common public license(?: version 1 0)?", ["cpl 1 0"]),
    ("bsd-2-clause", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)", ["bsd 2 clause"]),
    ("bsd-3-clause", "(?:modified bsd|new bsd|revised bsd|bsd 3 clause|3 clause bsd)", ["bsd 3 clause"]),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)", ["bsd 4 clause"]),
    ("0bsd", "(?:zero clause bsd|bsd zero clause)", ["0bsd"]),
    ("isc", "isc", ["isc"]),
    ("zlib", "zlib", ["zlib"]),
    ("libpng", "libpng", ["libpng", "libpng 2 0"]),
    ("bsl-1.0", "boost software license(?: version 1 0)?", ["bsl 1 0"]),
    ("unlicense", "unlicense", ["unlicense"]),
    ("wtfpl", "do what the fuck you want to public license", ["wtfpl"]),
    ("artistic-1.0", "artistic license 1 0", ["artistic 1 0"]),
    ("artistic-2.0", "artistic license(?: 2 0)?", ["artistic 2 0"]),
    ("psf-2.0", "python software foundation license(?: version 2)?", ["psf 2 0", "python 2 0"]),
    ("php-3.01", "php license(?: version)?(?: 3 01)?", ["php 3 01"]),
    ("ruby", "ruby license", ["ruby"]),
    ("openssl", "openssl license", ["openssl"]),
    ("postgresql", "postgresql license", ["postgresql"]),
    ("ofl-1.1", "sil open font license(?: version 1 1)?", ["ofl 1 1"]),
    ("eupl-1.1", "european union public licence(?: version| v)? 1 1", ["eupl 1 1"]),
    ("eupl-1.2", "european union public licence(?: version| v)?(?: 1 2)?", ["eupl 1 2"]),
    ("cecill-2.1", "cecill(?: free software license agreement)?", ["cecill 2 1"]),
    ("ms-pl", "microsoft public license", ["ms pl"]),
    ("ms-rl", "microsoft reciprocal license", ["ms rl"]),
    ("osl-3.0", "open software license(?: version| v)?(?: 3 0)?", ["osl 3 0"]),
    ("afl-3.0", "academic free license(?: version| v)?(?: 3 0)?", ["afl 3 0"]),
    ("ncsa", "university of illinois ncsa open source license", ["ncsa"]),
    ("upl-1.0", "universal permissive license(?: version| v)?(?: 1 0)?", ["upl 1 0"]),
    ("vim", "vim license", ["vim"]),
    ("w3c", "w3c software(?: notice and)? license", ["w3c"]),
    ("odbl-1.0", "open database license", ["odbl 1 0"]),
    ("odc-by-1.0", "open data commons attribution license", ["odc by 1 0"]),
    ("pddl-1.0", "open data commons public domain dedication", ["pddl 1 0"]),
    ("cc0-1.0", "(?:creative commons zero|cc0)(?: 1 0)?", ["cc0 1 0"]),
    ("busl-1.1", "business source license(?: 1 1)?", ["busl 1 1"]),
    ("elastic-2.0", "elastic license(?: 2 0)?", ["elastic 2 0"]),
    ("sspl-1.0", "server side public license(?: version 1)?", ["sspl 1 0"]),
    ("openrail-m", "(?:bigscience )?open rail m", ["openrail m", "openrail"]),
]
#: Creative Commons: parts of a license, spelt in words.
_CC_PARTS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?deriv(?:ative)?s",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s",
}
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

#: Passages of license texts: label, regex over words, keyword.
_PASSAGES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "provided as is without warranty"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "except in compliance"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "agreed to in writing"),
    ("bsd-2-clause", "redistributions of source code must retain the above copyright notice", "redistributions of source code"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors", "nor the names of its contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "all advertising materials"),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee", "with or without fee"),
    ("gpl", "this program is free software you can redistribute it and or modify", "free software you can redistribute"),
    ("lgpl", "this library is free software you can redistribute it and or modify", "free software you can redistribute"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "this source code form"),
    ("zlib", "the origin of this software must not be misrepresented", "must not be misrepresented"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy", "person or organization obtaining"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", "public domain"),
    ("public-domain", "no rights reserved", "no rights reserved"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "(?:strictly )?confidential and proprietary", "confidential and proprietary"),
    ("proprietary", "(?:may not be|not to be) (?:reproduced|copied|redistributed) without(?: the)? (?:prior )?(?:written )?(?:permission|consent)", "without"),
    ("copyright", "copyright c? ?(?:19|20)\\d\\d", "copyright"),
    ("non-commercial", "(?:for )?non ?commercial (?:use|purposes) only", "commercial"),
    ("research-only", "for (?:academic|research) (?:use|purposes) only", "only"),
    ("license", "licensed under", "licensed under"),
    ("license", "released under", "released under"),
    ("license", "see (?:the )?licen[sc]e(?: file| txt| md)?", "see"),
]


@dataclass(frozen=True)
class Rule:
    """priority: smaller is better. weight: what a match says about the label, 0 to 1."""

    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    weight: float


def _keyword(pattern: str) -> str:
    """The longest run of plain words that every match of the pattern holds."""
    plain, depth = [""], 0
    for at, char in enumerate(pattern):
        depth += (char == "(") - (char == ")")
        optional = pattern[at + 1 : at + 2] in ("?", "*")
        if depth or char in ")?*" or optional or not (char.isalnum() or char == " "):
            plain.append("")
        else:
            plain[-1] += char
    return max((p.strip() for p in plain), key=len)


def _rule(label: str, pattern: str, priority: int, weight: float, *keywords: str) -> Rule:
    return Rule(label, pattern, tuple(sorted({k for k in keywords if k})) or (_keyword(pattern),), priority, weight)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: identifiers, notices, names, passages, hints."""
    out = []
    under = "(?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?"
    for label, name, short in _LICENSES:
        for ident in short:
            out.append(_rule(label, f"spdx license identifier {ident}", 0, 1.0, "spdx license identifier"))
            out.append(_rule(label, f"{under}{ident}", 1, 0.95, "under", ident))
            if " " in ident or len(ident) > 5:
                out.append(_rule(label, f"{ident} licen[sc]ed?", 2, 0.85, "licen", ident))
        key = _keyword(name)
        out.append(_rule(label, f"{under}{name}(?: licen[sc]e)?", 1, 0.95, "under", key))
        out.append(_rule(label, name if "licen" in name else f"{name} licen[sc]e", 2, 0.8, "licen", key))
    for parts, words in _CC_PARTS.items():
        ident = "cc " + parts.replace("-", " ")
        for version in _CC_VERSIONS:
            number = version.replace(".", " ")
            label = f"cc-{parts}-{version}"
            out.append(_rule(label, f"spdx license identifier {ident} {number}", 0, 1.0, "spdx license identifier"))
            out.append(_rule(label, f"{under}{ident} {number}", 1, 0.95, "under", ident))
            out.append(_rule(label, f"{ident} {number}", 2, 0.9, ident))
            out.append(_rule(label, f"creative commons {words} {number}", 1, 0.95, "creative commons"))
            out.append(_rule(label, f"creativecommons org licenses {parts.replace('-', ' ')} {number}", 0, 1.0, "creativecommons org"))
        out.append(_rule(f"cc-{parts}", ident, 3, 0.7, ident))
        out.append(_rule(f"cc-{parts}", f"creative commons {words}", 3, 0.7, "creative commons"))
    for label, pattern, key in _PASSAGES:
        out.append(_rule(label, pattern, 5 if label in ("license", "copyright") else 4, 0.3 if label in ("license", "copyright") else 0.75, key))
    for family in ("gpl", "lgpl", "agpl"):
        out.append(_rule(family, f"gnu {({'gpl': '', 'lgpl': 'lesser ', 'agpl': 'affero '})[family]}general public licen[sc]e", 3, 0.7, "general public licen"))
    for phrase, label in BASE.items():
        out.append(Rule(label, phrase, (phrase,), 3, 0.7))
    return tuple(out)


@dataclass(frozen=True)
class Detection:
    label: str
    first: int
    last: int
    priority: int
    weight: float
    base: bool


@lru_cache(maxsize=1)
def _compiled():
    found: dict[tuple[str, ...], list[tuple[re.Pattern, Rule]]] = {}
    for rule in rules():
        found.setdefault(rule.keywords, []).append((re.compile(rf"(?<![^ ])(?=({rule.pattern})(?![^ ]))".encode()), rule))
    prefilter = ahocorasick.Automaton()
    for keyword in {k for keywords in found for k in keywords}:
        prefilter.add_word(keyword, keyword)
    prefilter.make_automaton()
    return found, prefilter


def normalized(text: str | None) -> tuple[bytes, int]:
    """Words of a text (A-Z lower-cased) joined by single spaces, and their number."""
    words = text.encode("utf-8", "surrogatepass").lower().translate(_SPACED).split() if text else []
    return b" ".join(words), len(words)


def detect(words: bytes) -> list[Detection]:
    """All matches of all rules whose keyword occurs, words counted from 0."""
    found, prefilter = _compiled()
    present = {key for _, key in prefilter.iter(words.decode("latin-1"))}
    out = []
    starts = [0, *(m.end() for m in re.finditer(b" ", words))] if present else []
    for keywords in found if present else ():
        if not present.issuperset(keywords):
            continue
        for pattern, rule in found[keywords]:
            for match in pattern.finditer(words):
                first, last = bisect_right(starts, match.start()) - 1, bisect_right(starts, match.end(1) - 1) - 1
                out.append(Detection(rule.label, first, last, rule.priority, rule.weight, BASE.get(rule.pattern) == rule.label))
    return out


def resolve(found: list[Detection]) -> list[Detection]:
    """Detections that no better one contains; of equal ones the first by label stays.

    Better: smaller priority, then longer. What contains a detection is at least as long,
    so one pass in order of priority and length decides. The furthest end of what was kept
    from each first word on stands in a tree of prefix maxima, so a pass costs n log n.
    """
    found = sorted(set(found), key=lambda d: (d.priority, d.first - d.last, d.first, d.label))
    places = {first: at for at, first in enumerate(sorted({d.first for d in found}), 1)}
    furthest = [-1] * (len(places) + 1)
    kept: list[Detection] = []
    for d in found:
        at, end = places[d.first], -1
        while at:
            end = max(end, furthest[at])
            at &= at - 1
        if end >= d.last:
            continue
        kept.append(d)
        at = places[d.first]
        while at < len(furthest):
            furthest[at] = max(furthest[at], d.last)
            at += at & -at
    return sorted(kept, key=lambda d: (d.first, d.last))


def scan(text: str | None) -> tuple[int, list[Detection], list[Detection]]:
    """(words, base detections, detections after suppression). Base detections are
    reported whether suppressed or not."""
    words, n = normalized(text)
    found = detect(words) if n else []
    return n, sorted((d for d in set(found) if d.base), key=lambda d: d.first), resolve(found)


_DETECTION = "array<struct<label: string, first: bigint, last: bigint, priority: int, weight: double>>"
_ARROW = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("priority", pa.int32()), ("weight", pa.float64())]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, base, detections) for every row of docs, over whole texts.

    base holds every place of the fixed phrases, detections what is left after
    suppression, both in order of place. A null text counts as empty and has none.
    Repeated rows are scanned each; other columns are not read.
    """
    source = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("text__"))
    ddl = f"`{id_col}` {source.schema[0].dataType.simpleString()}, n_words bigint, base {_DETECTION}, detections {_DETECTION}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_row = lambda d: {"label": d.label, "first": d.first, "last": d.last, "priority": d.priority, "weight": d.weight}
        for batch in batches:
            scans = [scan(text.as_py()) for text in batch.column(1)]
            lists = [pa.array([[as_row(d) for d in s[k]] for s in scans], _ARROW) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s[0] for s in scans], pa.int64()), *lists], names=[id_col, "n_words", "base", "detections"])

    return source.mapInArrow(tidy(run), ddl)
