"""Row filters. All are narrow; those on plain columns reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep import markets
from salesprep.functions import months, numbers, text


def month_window(df: DataFrame, start: Column, end: Column, month: str = "year_month") -> DataFrame:
    """Rows of the months between two ``yyyyMM`` bounds, both included."""
    return df.where(months.in_months(F.col(month), start, end))


def valid_outlets(df: DataFrame) -> DataFrame:
    """Distributor rows with usable store and outlet codes; null codes are dropped."""
    return df.where(
        (F.upper("db_channel") == markets.DISTRIBUTOR_CHANNEL)
        & ~F.col("restated_store_code").isin(*markets.INVALID_STORE_CODES)
        & ~F.col("outlet_unique_code").isin(*markets.INVALID_OUTLET_CODES)
    )


def active_pos(pos: DataFrame) -> DataFrame:
    """POS rows that have a representative, a partner and a code, and status 1."""
    return pos.where(
        F.col("sales_rep_code").isNotNull()
        & (F.col("sales_rep_code") != "")
        & F.col("partner_code").isNotNull()
        & F.col("pos_code").isNotNull()
        & (F.col("pos_status").try_cast("int") == 1)
    )


def typed_sales(df: DataFrame) -> DataFrame:
    """Value and volume as doubles, also when they arrive as text with commas."""
    return df.withColumns(
        {
            field.name: numbers.parse_number(F.col(field.name))
            for field in df.schema
            if field.name in ("value_sales", "vol_sales") and isinstance(field.dataType, T.StringType)
        }
    )


def is_positive() -> Column:
    """Value and volume, as doubles, are above zero; NaN is not."""

    def above_zero(name: str) -> Column:
        return (F.col(name) > 0) & ~F.isnan(F.col(name))

    return above_zero("value_sales") & above_zero("vol_sales")


def is_measured() -> Column:
    """The bucket does not say that the figures are estimates; a null bucket does not."""
    return text.lacks_text(F.col("bucket"), markets.ESTIMATED_BUCKET)


def positive_sales(df: DataFrame) -> DataFrame:
    """Rows with value and volume above zero, compared as numbers."""
    return typed_sales(df).where(is_positive())


def measured_sales(df: DataFrame) -> DataFrame:
    """Drop rows whose bucket says the figures are estimates; a null bucket stays."""
    return df.where(is_measured())


def without_adjustments(df: DataFrame, store: str = "store_code") -> DataFrame:
    """Drop adjustment stores; a null store stays."""
    return df.where(text.lacks_match(F.col(store), markets.ADJUSTMENT_STORES))


def is_counter() -> Column:
    """The description or the representative says that the outlet is a counter."""
    word = markets.COUNTER_WORD
    return text.mentions(F.col("pos_desc"), word) | text.mentions(F.col("sales_rep_name"), word)


def counter_outlets(active: DataFrame) -> DataFrame:
    """POS codes of counters, by description or by representative, once each."""
    return active.where(is_counter()).select("pos_code").distinct()
