"""Readers: parameterised SQL, whole tables, CSV splits, JDBC and a read with a second path."""

from __future__ import annotations

import logging
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyforge.functions.columns import quoted
from tallyforge.operators.clean import apply_types, flatten_json, normalize_types

log = logging.getLogger(__name__)

FORMATS = ("csv", "parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def fetch(spark: SparkSession, sql: str, params: dict[str, Any] | None = None, *,
          types: dict[str, str] | None = None, flatten: list[str] | None = None,
          key: list[str] | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with named parameters (`:name`) over tables or passed frames (`{name}`), then type the result."""
    df = spark.sql(sql, args=params or {}, **frames)
    for column in flatten or []:
        if column in df.columns:
            df = flatten_json(df, column)
    df = apply_types(normalize_types(df), types or {})
    missing = [k for k in key or [] if k not in df.columns]
    if missing:
        log.warning("key columns %s are not in the result", missing)
    return df


def scan_table(spark: SparkSession, config: dict[str, str]) -> DataFrame:
    """Whole table named by `schema_name`/`table_name`, or by `path` for parquet files."""
    if config.get("path"):
        return spark.read.parquet(config["path"])
    if not config.get("table_name"):
        raise ValueError("the source configuration names no table")
    schema = config.get("schema_name")
    return spark.read.table(f"{schema}.{config['table_name']}" if schema else config["table_name"])


def read_jdbc(spark: SparkSession, url: str, query_or_table: str, partition_column: str | None = None,
              lower: Any = None, upper: Any = None, partitions: int = 1, **options: str) -> DataFrame:
    """Remote table, split by ranges of a numeric or date column so that executors read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query_or_table).options(**options)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    return reader.load()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line, bound by column name: the file's order does not matter, columns not asked for are left out."""
    wanted = spark.createDataFrame([], schema).schema
    header = spark.read.csv(path, header=True).columns
    missing = [f.name for f in wanted if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column " + ", ".join(missing))
    types = {f.name: f.dataType for f in wanted}
    found = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    lines = spark.read.schema(found).csv(path, header=True, mode="FAILFAST", enforceSchema=False)
    return lines.select(*[quoted(f.name) for f in wanted])


def read_splits(spark: SparkSession, folder: str, schema: T.StructType | str,
                names: tuple[str, ...] = ("train", "val", "test")) -> dict[str, DataFrame]:
    """CSV data of every split; all missing ones are named in one error."""
    paths = {n: next((p for p in (f"{folder}/{n}.csv", f"{folder}/{n}") if path_exists(spark, p)), None)
             for n in names}
    missing = [f"{folder}/{n}.csv" for n, p in paths.items() if p is None]
    if missing:
        raise FileNotFoundError("missing input data: " + ", ".join(missing))
    return {n: read_csv(spark, p, schema) for n, p in paths.items()}


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet", fallback: str | None = None,
                 schema: T.StructType | str | None = None) -> DataFrame:
    """Read csv or parquet; a path that cannot be read is replaced by the fallback path."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, expected one of {FORMATS}")

    def load(where: str) -> DataFrame:
        if fmt == "csv":
            return read_csv(spark, where, schema) if schema else spark.read.csv(where, header=True, inferSchema=True)
        return (spark.read.schema(schema) if schema else spark.read).parquet(where)
    if fallback is None or path_exists(spark, path):
        return load(path)
    log.warning("%s cannot be read, using %s", path, fallback)
    return load(fallback)
