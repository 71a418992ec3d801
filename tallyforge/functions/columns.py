"""Small expressions shared by many operators. All of them stay inside the JVM."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Decimal rounding away from zero at the half, given back as double.

    The value is first taken at 15 significant digits, as databases do when they turn a
    double into a decimal, so that noise in the last bits cannot flip a half. NaN and infinity stay.
    """
    magnitude = F.pow(F.lit(10.0), 14 - F.floor(F.log10(F.abs(value))))
    clean = F.when(value == 0, 0.0).otherwise(F.rint(value * magnitude) / magnitude)
    rounded = F.round(clean.cast("decimal(38,10)"), digits).cast("double")
    return F.when(is_finite(value), rounded).otherwise(value.cast("double"))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns."""
    col = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def is_finite(col: Column) -> Column:
    value = col.cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def finite_or_null(col: Column) -> Column:
    return F.when(is_finite(col), col)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null on an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def snake_name(name: str) -> str:
    """ASCII snake_case form of a column or table name."""
    folded = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "_", folded.lower()).strip("_")


def long_form(df: DataFrame, columns: list[str], extra: list[Column] | None = None,
              cast: str = "double") -> DataFrame:
    """One row per (row, column): name in `column`, content in `value`; a narrow step, no shuffle."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast(cast).alias("value")) for c in columns
    ])
    return df.select(*(extra or []), F.inline(cells))
