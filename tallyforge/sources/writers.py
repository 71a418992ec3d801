"""Writers: split export, bulk loads, appends and one-row reports."""

from __future__ import annotations

import logging
import time
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.columns import is_missing
from tallyforge.sources.readers import path_exists, read_csv

log = logging.getLogger(__name__)


def export_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """All splits in one write, one folder per split; the key stays an ordinary column."""
    writer = df.write.mode("overwrite").partitionBy("split")
    writer.csv(path, header=True) if fmt == "csv" else writer.parquet(path)


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int
    seconds: float
    status: str = "loaded"


def publish(spark: SparkSession, staging: str, target: str, mode: str = "append", prefix: str = "") -> None:
    """Moves finished part files into the table at `target`, which keeps what it has (`append`) or is replaced (`overwrite`).

    With a `prefix` the files are named after it, and files of that name from an earlier try are removed first.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    source, table = jvm.Path(staging), jvm.Path(target)
    fs = table.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode == "overwrite" and fs.exists(table):
        old = jvm.Path(f"{target.rstrip('/')}-replaced-{uuid.uuid4().hex[:12]}")
        fs.rename(table, old)
        fs.rename(source, table)
        fs.delete(old, True)
        return
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    fs.mkdirs(table)
    if prefix:
        for status in fs.listStatus(table):
            if status.getPath().getName().startswith(prefix):
                fs.delete(status.getPath(), False)
    for status in fs.listStatus(source):
        name = status.getPath().getName()
        if name.startswith("part-"):
            fs.rename(status.getPath(), jvm.Path(table, prefix + name))
    fs.delete(source, True)


def discard(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bulk_load(spark: SparkSession, source: str, target: str, schema: T.StructType | str, *,
              delimiter: str = ",", header: bool = True, fmt: str = "CSV", mode: str = "append") -> LoadResult:
    """Delimited file to parquet at `target`, all or nothing.

    Rows are written to a folder beside the target and moved there once all are good, so a malformed line leaves the target as
    it was. They are counted while they are written.
    """
    if fmt.upper() not in ("CSV", "TEXT"):
        raise ValueError(f"unsupported load format {fmt!r}")
    delimiter = "\t" if fmt.upper() == "TEXT" and delimiter == "," else delimiter
    started = time.monotonic()
    seen, staging = Observation(), f"{target.rstrip('/')}-loading-{uuid.uuid4().hex[:12]}"
    lines = spark.read.schema(schema).csv(source, sep=delimiter, header=header, mode="FAILFAST",
                                          enforceSchema=False)
    try:
        lines.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staging)
    except Exception:
        discard(spark, staging)
        raise
    publish(spark, staging, target, mode)
    result = LoadResult(target, seen.get["rows"], time.monotonic() - started)
    log.info("loaded %d rows into %s in %.2fs", result.rows, target, result.seconds)
    return result


def bulk_load_all(spark: SparkSession, datasets: dict[str, dict[str, Any]]) -> list[LoadResult]:
    """Load every configured dataset; a missing source is skipped and a failure does not stop the rest."""
    results = []
    for name, conf in datasets.items():
        if not conf.get("source_path") or not path_exists(spark, conf["source_path"]):
            log.warning("dataset %s: source is missing, skipped", name)
            results.append(LoadResult(conf.get("target", name), 0, 0.0, "skipped"))
            continue
        try:
            results.append(bulk_load(spark, conf["source_path"], conf["target"], conf["schema"],
                                     **conf.get("options", {})))
        except Exception as error:  # the report carries the failure
            log.error("dataset %s: %s", name, error)
            results.append(LoadResult(conf.get("target", name), 0, 0.0, "failed"))
    return results


def append_csv(spark: SparkSession, source: str, target: str, schema: T.StructType | str) -> None:
    read_csv(spark, source, schema).write.mode("append").parquet(target)


def append_rows(df: DataFrame, target: str, columns: list[str] | None = None) -> None:
    """Append the named columns, in that order."""
    df.select(*(columns or df.columns)).write.mode("append").parquet(target)


def ingest_report(df: DataFrame, key: list[str], split: str = "split") -> DataFrame:
    """One row: total and per-split row counts and the number of features (key and split are none)."""
    sizes = [F.count_if(F.col(split) == s).alias(f"{s}_rows") for s in ("train", "val", "test")]
    features = len([c for c in df.columns if c not in key and c != split])
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(features).cast("long").alias("feature_count"), *sizes)


def validation_report(gate: DataFrame) -> DataFrame:
    """One row from the table of a split gate: the overall status, all records and failures, and the failures of each split."""
    sizes = [F.coalesce(F.sum(F.when(F.col("split") == s, F.col("error_count"))), F.lit(0)).alias(f"{s}_errors") for s in ("train", "val", "test")]
    return gate.agg(F.coalesce(F.max("overall_status"), F.lit("FAILED")).alias("status"), F.sum("total_records").alias("total_records"),
                    F.sum("error_count").alias("error_count"), *sizes)


def transformation_report(raw: DataFrame, features: list[str], dropped: str | None, missing: list[str], split: str = "split") -> DataFrame:
    """One row: shape of each split after preparation, the names of its features, missing cells before it, and the identifier left out."""
    sizes = [F.count_if(F.col(split) == s).alias(f"{s}_rows") for s in ("train", "val", "test")]
    holes = [F.count_if(is_missing(raw, c)).alias(f"missing_{c}") for c in missing]
    return raw.agg(*sizes, *holes).select("*", F.lit(len(features)).cast("long").alias("feature_count"),
                                          F.lit(",".join(features)).alias("feature_names"), F.lit(dropped).cast("string").alias("dropped_identifier"))


def training_report(best: DataFrame, train: DataFrame, val: DataFrame, features: int) -> DataFrame:
    """One row per metric of a search: its best score, model and parameters, trial counts, and the sizes of the data."""
    rows = [df.agg(F.count(F.lit(1)).alias(f"{name}_rows")) for name, df in (("train", train), ("validation", val))]
    sizes = rows[0].join(rows[1], F.lit(True))  # one row each
    return best.join(sizes, F.lit(True)).withColumn("feature_count", F.lit(features).cast("long"))


def write_report(report: DataFrame, path: str) -> None:
    """Small report as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
