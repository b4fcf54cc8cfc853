"""Expressions on lists of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partwise.functions.text import BLANK_CLASS, strip


def no_names() -> Column:
    return F.array().cast("array<string>")


def split_names(text: Column) -> Column:
    """Comma list to trimmed names: trailing empties vanish, inner ones stay.

    The blanks around a comma belong to the delimiter, which spares a lambda per name.
    """
    listed = F.rtrim(text, F.lit(","))
    names = F.split(strip(listed), f"{BLANK_CLASS},{BLANK_CLASS}")
    return F.when((listed == "") & (text != ""), no_names()).otherwise(names)


def repeated_names(ordered: Column) -> Column:
    """The names that occur more than once in a sorted list."""
    again = F.filter(ordered, lambda name, at: name == F.get(ordered, at + 1))
    has_repeats = F.size(F.array_distinct(ordered)) < F.size(ordered)
    return F.when(has_repeats, F.array_distinct(again)).otherwise(no_names())


def without(names: Column, *members: Column) -> Column:
    for member in members:
        names = F.array_remove(names, member)
    return names


def bracketed(names: Column) -> Column:
    """``[a, b]``, the printed form of a member list."""
    return F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]"))
