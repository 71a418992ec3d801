"""Declared tables: column types, order and nullability, and a report on what did not fit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import quoted, snake_name

# Declared type names and the Spark types they stand for; any other name is text.
TYPE_NAMES = {
    "string": "string", "int": "bigint", "integer": "bigint", "float": "double", "double": "double",
    "boolean": "boolean", "bool": "boolean", "date": "date", "datetime": "timestamp_ntz", "text": "string",
}


@dataclass(frozen=True)
class DeclaredColumn:
    name: str
    kind: str = "text"
    nullable: bool = True

    @property
    def spark_type(self) -> str:
        return TYPE_NAMES.get(self.kind.lower(), "string")


def declared(columns: dict[str, dict]) -> list[DeclaredColumn]:
    return [DeclaredColumn(n, c.get("type", "text"), bool(c.get("nullable", True))) for n, c in columns.items()]


def ddl(table: str, columns: list[DeclaredColumn]) -> str:
    body = ", ".join(f"{quoted(c.name)} {c.spark_type}{'' if c.nullable else ' NOT NULL'}" for c in columns)
    return f"CREATE TABLE IF NOT EXISTS {snake_name(table)} ({body}) USING parquet"


def conform(df: DataFrame, columns: list[DeclaredColumn]) -> DataFrame:
    """Project, order and cast to the declaration; cells that cannot be cast become null."""
    return df.select(*[
        (F.col(quoted(c.name)).try_cast(c.spark_type) if c.name in df.columns
         else F.lit(None).cast(c.spark_type)).alias(c.name) for c in columns])


def conform_report(df: DataFrame, columns: list[DeclaredColumn]) -> DataFrame:
    """Per declared column: is it there, how many cells fail the cast, how many break the not-null rule."""
    there = [c for c in columns if c.name in df.columns]
    aggs = []
    for i, c in enumerate(there):
        raw = F.col(quoted(c.name))
        typed = raw.try_cast(c.spark_type)
        aggs += [F.count_if(raw.isNotNull() & typed.isNull()).alias(f"bad{i}"),
                 F.count_if(typed.isNull()).alias(f"null{i}")]
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = []
    for c in columns:
        if c in there:
            i = there.index(c)
            bad, nulls = F.col(f"bad{i}"), F.col(f"null{i}")
        else:
            bad, nulls = F.lit(0).cast("long"), F.col("n")
        rows.append(F.struct(
            F.lit(c.name).alias("column"), F.lit(c.spark_type).alias("declared_type"),
            F.lit(c in there).alias("present"), bad.alias("bad_cells"),
            (F.lit(0).cast("long") if c.nullable else nulls).alias("null_violations")))
    return one.select(F.inline(F.array(*rows)))
