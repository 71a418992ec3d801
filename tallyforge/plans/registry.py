"""Name -> query and name -> SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def half_up_sql(value: str, digits: int = 2) -> str:
    """SQL for decimal rounding at the half of a double taken at 15 significant digits."""
    scale = f"power(10.0::double, 14 - floor(log10(abs({value}))))"
    clean = f"case when {value} = 0 then 0.0::double else round({value} * {scale}) / {scale} end"
    return f"cast(round(cast(cast({clean} as varchar) as decimal(38,10)), {digits}) as double)"
