"""Text extraction. Every function is one built-in expression, evaluated inside the JVM over the whole text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def first_pair(text: Column, pattern: str) -> tuple[Column, Column]:
    """Groups 1 and 2 of the first match."""
    return first_group(text, pattern, 1), first_group(text, pattern, 2)


def group_behind(text: Column, marker: str, pattern: str, group: int = 1) -> Column:
    """Group of the first match anywhere behind the first marker, however far; NULL without a marker.

    Whatever a later marker has behind it is behind the first one, too, so no other is tried. The pattern says where a match may
    begin, so that it takes a run of characters only as a whole.
    """
    behind = F.substring(text, F.instr(text, marker) + F.lit(len(marker)), F.length(text))
    return F.when(F.contains(text, F.lit(marker)), first_group(behind, pattern, group))


def gated_group(text: Column, needle: str, pattern: str, group: int = 1) -> Column:
    """`first_group`, searched only in texts that hold a literal which every match has."""
    return F.when(F.contains(text, F.lit(needle)), first_group(text, pattern, group))


def distinct_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """Number of different values of a group inside one text, NULL when nothing matches."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
    return F.when(F.size(found) > 0, F.size(found))


def keywords_in(text: Column, words: Sequence[str]) -> Column:
    """The words of a list that occur in the text, in list order."""
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def first_label(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first needle found in the text."""
    out = None
    for needle, label in rules:
        hit = F.contains(text, F.lit(needle))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def after_marker(text: Column, marker: str) -> Column:
    """What follows the first occurrence of the marker (the whole text when it is absent)."""
    return F.substring(text, F.instr(text, marker) + F.lit(len(marker)), F.length(text))


def matches_any(text: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression hit, NULL text counts as no hit."""
    return F.coalesce(F.upper(text).rlike(pattern), F.lit(False))


def code_group(code: Column, groups: dict[str, Sequence[str]], default: str = "OTHER") -> Column:
    """Group name of the list a code belongs to."""
    out = None
    for name, codes in groups.items():
        hit = code.isin(*codes)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str) -> DataFrame:
    """0/1 column per level; the level list is fixed by the caller, so no extra pass is needed."""
    return df.select(
        "*",
        *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in levels],
    )
