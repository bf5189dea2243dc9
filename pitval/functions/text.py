"""Name and code expressions; every function takes and returns a Column."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitval.constants import GROUP_ALIASES, NAME_PUNCTUATION, NAME_SUFFIXES


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters to replace or delete so that no accent is left.

    Derived from Unicode canonical decomposition: a character that decomposes into one
    base character plus marks maps to its base, a bare mark maps to nothing.
    ``translate`` deletes the characters that have no counterpart, so marks come last.
    Hangul syllables decompose into letters, not into a base and marks, and are left
    whole: a differing syllable counts as one character in a name's score.
    """
    accented, bases, marks = [], [], []
    for code in range(0x00C0, 0x110000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        base = [c for c in parts if not unicodedata.combining(c)]
        if not base:
            marks.append(char)
        elif len(base) == 1 and base[0] != char:
            accented.append(char)
            bases.append(base[0])
    return "".join(accented + marks), "".join(bases)


def strip_accents(text: Column) -> Column:
    return F.translate(text, *_accent_table())


def normalize_name(name: Column) -> Column:
    """Lower-case name without accents, bracketed notes, punctuation or one trailing suffix."""
    space = r"(?U)\s"
    out = F.lower(strip_accents(F.coalesce(name, F.lit(""))))
    out = F.regexp_replace(out, rf"{space}*\([^)]*\)\s*", " ")
    out = F.translate(out, NAME_PUNCTUATION, "")
    out = F.trim(F.regexp_replace(out, rf"{space}+", " "))
    return F.trim(F.regexp_replace(out, rf"\s+({'|'.join(NAME_SUFFIXES)})$", ""))


def full_name(first: Column, last: Column) -> Column:
    """First and last name with missing parts read as blank, trimmed."""
    return F.trim(
        F.concat_ws(" ", F.coalesce(first, F.lit("")), F.coalesce(last, F.lit("")))
    )


def name_tokens(norm: Column) -> Column:
    """Distinct words of a normalized name, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(norm, " "), lambda w: w != "")))


def _array_map(table: dict[str, list[str]]) -> Column:
    return F.create_map(
        *chain.from_iterable(
            (F.lit(key), F.array(*[F.lit(v) for v in values])) for key, values in table.items()
        )
    )


def group_key(code: Column) -> Column:
    """The code as a feed asks for it: trimmed, upper case, blank read as null."""
    cleaned = F.upper(F.trim(code))
    return F.when(cleaned != "", cleaned)


def alias_set(code: Column) -> Column:
    """Codes accepted for a requested code; unknown -> itself, blank -> empty."""
    key = group_key(code)
    return F.coalesce(
        _array_map(GROUP_ALIASES)[key],
        F.when(key.isNotNull(), F.array(key)),
        F.array().cast("array<string>"),
    )


def requested_by(code: Column) -> Column:
    """The reverse of ``alias_set``: requested codes that accept this recorded code."""
    reverse: dict[str, list[str]] = {}
    for asked, accepted in GROUP_ALIASES.items():
        for value in accepted:
            reverse.setdefault(value, []).append(asked)
    for value in reverse:
        if value not in GROUP_ALIASES:
            reverse[value].append(value)
    return F.coalesce(_array_map(reverse)[code], F.array(code))


def eligible_set(primary: Column, others: Column) -> Column:
    """Primary code plus each non-empty piece of a comma list, distinct, pieces untrimmed."""
    pieces = F.concat(
        F.array(primary), F.coalesce(F.split(others, ","), F.array().cast("array<string>"))
    )
    return F.array_distinct(F.filter(pieces, lambda p: p.isNotNull() & (p != "")))

