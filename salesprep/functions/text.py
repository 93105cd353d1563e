"""Codes and text. Null rules are stated where they differ from Spark's default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\r\n"


def trim_spaces(text: Column) -> Column:
    return F.trim(text)


def trim_whitespace(text: Column) -> Column:
    """Strip space, tab, CR and LF; Spark's ``trim`` strips spaces only."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def distributor_part(store_code: Column) -> Column:
    """What stands before the first underscore; the whole code when there is none."""
    return F.get(F.split(store_code, "_", 2), F.lit(0))


def outlet_part(store_code: Column) -> Column:
    """All that follows the first underscore; empty when there is none."""
    return F.coalesce(F.get(F.split(store_code, "_", 2), F.lit(1)), F.lit(""))


def outlet_key(store_code: Column) -> Column:
    """The outlet as the POS map spells it."""
    return F.translate(outlet_part(store_code), ">", "_")


def compose_code(*parts: Column) -> Column:
    """Join parts with underscores; a missing part is spelt ``NA``."""
    return F.concat_ws("_", *[F.coalesce(part, F.lit("NA")) for part in parts])


def map_values(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    result = value
    for old, new in mapping.items():
        result = F.when(value == F.lit(old), F.lit(new)).otherwise(result)
    return result


def override_by_code(value: Column, code: Column, by_code: Mapping[str, str]) -> Column:
    """Set ``value`` for the listed codes, keep it for the others."""
    result = value
    for one_code, new in by_code.items():
        result = F.when(code == F.lit(one_code), F.lit(new)).otherwise(result)
    return result


def sentinel_fallback(value: Column, fallback: Column, sentinel: str) -> Column:
    """Take ``fallback`` where ``value`` is the sentinel. Null stays null."""
    return F.when(value == F.lit(sentinel), fallback).otherwise(value)


def sanitize(text: Column) -> Column:
    """Every character that is not a letter, digit or underscore becomes an underscore."""
    return F.regexp_replace(text, "[^A-Za-z0-9_]", "_")


def recode(code: Column, old: str, new: str) -> Column:
    return F.replace(code.cast("string"), F.lit(old), F.lit(new))


def strip_token(text: Column, token: str) -> Column:
    return F.replace(text, F.lit(token), F.lit(""))


def fill_category(category: Column, value: Column, filler: str) -> Column:
    """Name the category of rows that sold something but have none."""
    return F.when(category.isNull() & (value > 0), F.lit(filler)).otherwise(category)


def lacks_text(text: Column, part: str) -> Column:
    """True where ``text`` does not hold ``part``; true for null."""
    return ~F.coalesce(text.contains(part), F.lit(False))


def lacks_match(text: Column, regex: str) -> Column:
    """True where ``text`` does not match ``regex``; true for null."""
    return ~F.coalesce(text.rlike(regex), F.lit(False))


def one_of(text: Column, values: Sequence[str]) -> Column:
    """Membership that is never null: false for null."""
    return F.coalesce(text.isin(*values), F.lit(False))


def mentions(text: Column, word: str) -> Column:
    """Upper-cased text holds ``word``."""
    return F.upper(text).contains(word)
