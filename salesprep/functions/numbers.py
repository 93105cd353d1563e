"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """Double from text with thousands commas; text that is no number becomes null.

    A cast alone would take the suffixes of Java's literals (``5d``, ``5f``) for numbers.
    """
    plain = F.replace(text.cast("string"), F.lit(","), F.lit(""))
    return F.when(~plain.rlike(r"[0-9.][dDfF]\s*$"), plain.try_cast("double"))
