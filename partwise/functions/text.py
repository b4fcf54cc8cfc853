"""Text rules of the two line formats, as built-in column expressions.

The line formats follow the string rules of the JVM: a trim that removes every
character up to U+0020, a split that forgets trailing empty fields, and a strict
32-bit integer parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed by a trim, U+0000 to U+0020.
BLANKS = "".join(map(chr, range(0x21)))
BLANK_CLASS = r"[\x00-\x20]*"


def strip(text: Column) -> Column:
    """Trim spaces, and then only if a blank is still at an end trim all blanks.

    Either end is looked at by comparing it to ``!``, the character after the blanks:
    trimming a set of characters is far slower than that.
    """
    spaced = F.trim(text)
    more = (spaced < "!") | (F.substring(spaced, -1, 1) < "!")
    return F.when(more, F.btrim(spaced, F.lit(BLANKS))).otherwise(spaced)


def without_trailing(text: Column, delimiter: str) -> Column:
    return F.when(F.endswith(text, F.lit(delimiter)), F.rtrim(text, F.lit(delimiter))).otherwise(text)


def split_fields(text: Column, delimiter: str) -> Column:
    """Split on a one-character delimiter, without the trailing empty fields."""
    return F.split(without_trailing(text, delimiter), "\\" + delimiter)


def whole_number(text: Column) -> Column:
    """The 32-bit integer a text spells with an optional sign, else null.

    ``try_cast`` alone also takes blanks and decimals, so what is left once the
    digits are taken out must be nothing or a sign.
    """
    only_digits = F.translate(text, "0123456789", "").isin("", "+", "-")
    return F.when(only_digits, text.try_cast("int"))
