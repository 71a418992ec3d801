"""Typing, text cleaning, missing-value handling and de-duplication."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.columns import is_missing, numeric_columns, quoted, snake_name, string_columns
from tallyforge.operators.ranks import exact_quantiles

log = logging.getLogger(__name__)


def normalize_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def flatten_json(df: DataFrame, column: str, fields: T.StructType | str | None = None) -> DataFrame:
    """Replace a JSON text or struct column by `<column>_<field>` columns.

    Without a declared schema the top-level keys and their types are read from the data
    by one distributed aggregate over the column.
    """
    if isinstance(df.schema[column].dataType, T.StructType):
        parsed = df
    else:
        if fields is None:
            found = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(quoted(column))))).first()[0]
            fields = found.replace("OBJECT<", "STRUCT<")
        parsed = df.withColumn(column, F.from_json(F.col(quoted(column)), fields))
    kept = [c for c in df.columns if c != column]
    inner = parsed.schema[column].dataType.names
    return parsed.select(*[F.col(quoted(c)) for c in kept],
                         *[F.col(f"{quoted(column)}.{quoted(n)}").alias(f"{column}_{n}") for n in inner])


def normalize_types(df: DataFrame) -> DataFrame:
    """Decimals to double, every integer width to bigint; nullability needs no special type."""
    def typed(field: T.StructField) -> Column:
        col = F.col(quoted(field.name))
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(field.name)
        return col
    return df.select(*[typed(f) for f in df.schema])


#: Notations tried after the ISO ones, month first where both orders fit.
DATE_FORMATS = ("M/d/yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "d-M-yyyy[ H:mm[:ss]]")


def parsed_datetime(text: Column) -> Column:
    """Timestamp of a date or time in ISO or one of the usual notations, null for other texts."""
    return F.coalesce(text.try_cast("timestamp_ntz"), *[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS])


def dated(text: Column) -> Column:
    """Like `parsed_datetime`, for texts that are not known to be dates: codes without a separator are none."""
    return F.when(text.rlike("[-/]"), parsed_datetime(text))


def apply_types(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Explicit casts: a bad date becomes null, any other bad value is an error. Absent columns are skipped."""
    casts = {}
    for name, kind in mapping.items():
        if name not in df.columns:
            continue
        col = F.col(quoted(name))
        if kind in ("datetime", "datetime64", "datetime64[ns]", "timestamp", "timestamp_ntz"):
            casts[name] = parsed_datetime(col.cast("string"))
        else:
            casts[name] = col.cast(kind)
    return df.withColumns(casts)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space of any kind, tabs and line ends too, at both ends of every string column."""
    return df.withColumns({c: F.regexp_replace(F.col(quoted(c)), r"^\s+|\s+$", "") for c in string_columns(df)})


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(quoted(c)).rlike(r"^\s*$"), F.col(quoted(c)))
                           for c in string_columns(df)})


def hash_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """SHA-256 hex of the text form; null stays null."""
    for c in columns:
        if c not in df.columns:
            log.warning("column %s is not there to hash", c)
    return df.withColumns({c: F.sha2(F.col(quoted(c)).cast("string"), 256) for c in columns if c in df.columns})


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        log.warning("key columns %s are missing", missing)
    return (df.groupBy(*[k for k in keys if k in df.columns])
            .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


def drop_duplicates_by_key(df: DataFrame, keys: list[str] | str, sort: str | None = None,
                           keep: str | bool = "last", tiebreak: list[str] | None = None) -> DataFrame:
    """One row per key, the last or first by `sort`; `keep=False` drops every repeated key.

    A grouped min/max of one ordered struct: partial aggregation leaves one row per key and
    map task, so a key that holds much of the table does not land in one place.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order: list[Column] = []
    if sort is not None:
        if sort in df.columns:
            order += [is_missing(df, sort), F.col(quoted(sort))]
        else:
            log.warning("sort column %s is missing, rows stay unsorted", sort)
    order += [F.col(quoted(c)) for c in (tiebreak or [c for c in df.columns if c not in keys])]
    row = F.struct(*[F.col(quoted(c)) for c in df.columns])
    grouped = df.groupBy(*[F.col(quoted(k)).alias(f"__key{i}") for i, k in enumerate(keys)])
    if keep is False:
        one = grouped.agg(F.count(F.lit(1)).alias("__n"), F.any_value(row).alias("__row")).where("__n = 1")
    elif keep in ("last", "first"):
        pick = F.max_by if keep == "last" else F.min_by
        one = grouped.agg(pick(row, F.struct(*order)).alias("__row"))
    else:
        raise ValueError(f"keep must be 'last', 'first' or False, not {keep!r}")
    return one.select("__row.*")


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before, rows kept and rows dropped by a one-row-per-key rule."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_kept")).select(
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_kept",
        (F.coalesce("n_rows", F.lit(0)) - F.col("n_kept")).alias("n_dropped"))


def sparse_columns(df: DataFrame, max_null_share: float = 0.5) -> list[str]:
    row = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > max_null_share]


def drop_sparse_columns(df: DataFrame, max_null_share: float = 0.5) -> DataFrame:
    return df.drop(*sparse_columns(df, max_null_share))


def drop_zero_columns(df: DataFrame, max_zero_share: float = 0.8) -> DataFrame:
    """Drop numeric columns that are mostly zero; null is not zero."""
    nums = numeric_columns(df)
    row = df.agg(*[F.avg(F.coalesce(F.col(quoted(c)) == 0, F.lit(False)).cast("double")).alias(c)
                   for c in nums]).first()
    return df.drop(*[c for c in nums if row[c] is not None and row[c] > max_zero_share])


def null_cells(df: DataFrame, columns: list[str] | None = None) -> Column:
    total = F.lit(0)
    for c in columns or df.columns:
        total = total + is_missing(df, c).cast("int")
    return total


def drop_sparse_rows(df: DataFrame, max_null_share: float = 0.5, columns: list[str] | None = None) -> DataFrame:
    return df.where(null_cells(df, columns) / len(columns or df.columns) <= max_null_share)


def fill_medians(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    nums = columns or numeric_columns(df)
    medians = exact_quantiles(df, nums, [0.5])
    fills = {c: F.when(is_missing(df, c), F.lit(medians[c][0.5])).otherwise(F.col(quoted(c)).cast("double"))
             for c in nums if medians[c][0.5] is not None}
    return df.withColumns(fills)


def datetime_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of rows of each string column that parse as a date or time."""
    cols = columns or string_columns(df)
    cells = F.array(*[F.struct(F.lit(c).alias("column"),
                               dated(F.col(quoted(c))).isNotNull().cast("int").alias("ok"))
                      for c in cols])
    return (df.select(F.inline(cells)).groupBy("column")
            .agg(F.avg("ok").alias("parsed_share")))


def promote_datetimes(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Turn string columns into timestamps when more than `min_share` of all rows parse."""
    cols = string_columns(df)
    if not cols:
        return df
    found = [r["column"] for r in datetime_shares(df, cols).where(F.col("parsed_share") > min_share).collect()]
    return df.withColumns({c: dated(F.col(quoted(c))) for c in found})
