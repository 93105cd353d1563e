"""Column names and order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.contracts import SALES
from salesprep.functions.numbers import parse_number


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def normalize_names(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Lower-case the column names and turn every other character into an underscore.

    Two columns that would end up with one name raise here, not at first use.
    """
    given = df.columns if names is None else names
    clean = [re.sub(r"\W", "_", name.lower()) for name in given]
    twice = sorted({name for name in clean if clean.count(name) > 1})
    if twice:
        raise ValueError(f"columns would share the names {twice}")
    return rename_positional(df, clean)


def take_leading(df: DataFrame, count: int) -> DataFrame:
    """The first ``count`` columns."""
    return df.select(*df.columns[:count])


def restore_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, in that order."""
    return df.select(*columns)


def as_sales(df: DataFrame) -> DataFrame:
    """A table of the 17 sales columns, named by position and brought to the contract's types."""
    named = rename_positional(df, SALES.names)
    textual = {field.name for field in named.schema if isinstance(field.dataType, T.StringType)}

    def typed(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType) or field.name not in textual:
            return value.cast(field.dataType)
        return parse_number(value).try_cast(field.dataType)

    return named.select(*[typed(field).alias(field.name) for field in SALES])
