"""Splitting texts by a byte-level tokenizer's pattern."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: How the classes of such patterns read in the standard library's syntax.
_CLASSES = ((r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)"), (r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"))
#: Characters on which the two syntaxes may differ: separators that the standard library
#: counts as space, numbers that aren't digits, and everything from U+0250 on.
_DIFFER = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]").search


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """findall of a pattern. Texts on which the standard library's faster engine sees the
    same classes go to that; the test compares both on every character."""
    whole = regex.compile(pattern).findall
    plain = pattern
    for unicode_class, own in _CLASSES:
        plain = plain.replace(unicode_class, own)
    if "\\p" in plain:
        return whole
    quick = re.compile(plain).findall
    return lambda text: whole(text) if _DIFFER(text) else quick(text)
