"""Expressions for a category spec, a string such as ``1#home_2#toys``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Delimiters of a category spec.
ENTRY_DELIMITER = "_"
FIELD_DELIMITER = "#"

# A whole spec that is well formed: nothing but delimiters, or entries with an id and a
# name, of which only the last may be followed by more delimiters. One anchored pattern
# whose groups never give back what they took, so that a text is read once.
_ENTRY = "[^_#]*+#++[^_#][^_]*+"
_WELL_FORMED = rf"\A(?:_++|{_ENTRY}(?:_{_ENTRY})*+_*+)\z"


def is_malformed(spec: Column) -> Column:
    """True for a null spec or one with an entry that lacks a name."""
    return spec.isNull() | ~spec.rlike(_WELL_FORMED)


def _entries(spec: Column) -> Column:
    """The entries of a spec that is well formed, where only trailing ones can be empty."""
    problem = F.concat(F.lit("malformed category spec: "), F.coalesce(spec, F.lit("null")))
    checked = F.when(is_malformed(spec), F.raise_error(problem).cast("string")).otherwise(spec)
    return F.array_remove(F.split(checked, ENTRY_DELIMITER), "")


def ranked_entries(spec: Column) -> Column:
    """``array<struct<id, rank, entry>>``, by id and falling position within an id.

    Trailing delimiters are ignored; any malformed entry raises, and so does a null
    spec.
    """
    return F.sort_array(
        F.transform(
            _entries(spec),
            lambda entry, position: F.struct(
                F.substring_index(entry, FIELD_DELIMITER, 1).alias("id"),
                (-position).alias("rank"),
                entry.alias("entry"),
            ),
        )
    )


def winning_entries(ranked: str) -> Column:
    """The first of every id in a column of ranked entries: the last one in its spec."""

    def starts_an_id(entry: Column, index: Column) -> Column:
        # positions in element_at start at 1, so this is the entry before
        before = F.try_element_at(F.col(ranked), F.greatest(index, F.lit(1)))
        return (index == 0) | (before["id"] != entry["id"])

    return F.filter(F.col(ranked), starts_an_id)


def entry_name(entry: Column) -> Column:
    """The field after the id; what follows it is ignored."""
    return F.split(entry, FIELD_DELIMITER)[1]
