"""Streaming loads and streaming validation with scoring.

Each micro-batch is written beside the table and then moved into it under names made of the stream and the
batch, in place of those of an earlier try: a batch that is replayed after a failure cannot load its rows
twice, and streams with their own checkpoints never touch each other's files. A batch that writes to two tables
is recorded once both hold it; who reads by the records sees both halves of a batch or neither.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.columns import is_finite
from tallyforge.operators.contract import Contract
from tallyforge.sources.readers import path_exists
from tallyforge.sources.writers import publish


def read_files(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
               files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(folder)


def batch_name(checkpoint: str, batch_id: int) -> str:
    """What the files of a batch begin with, in every table it goes to."""
    return f"{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def put_batch(batch: DataFrame, target: str, checkpoint: str, batch_id: int) -> None:
    """Adds the rows of one micro-batch to the table at `target`, once however often it is tried."""
    name = batch_name(checkpoint, batch_id)
    staging = f"{target.rstrip('/')}-batch-{name}"
    batch.write.mode("overwrite").parquet(staging)
    publish(batch.sparkSession, staging, target, prefix=f"{name}-")


def records_of(valid: str) -> str:
    """The table of recorded batches beside the table of valid rows."""
    return f"{valid.rstrip('/')}-batches"


def record_batch(spark: SparkSession, records: str, checkpoint: str, batch_id: int) -> None:
    """Notes that all tables hold the batch: one row, moved in by one rename, the same row if it is tried again."""
    put_batch(spark.range(1).select(F.lit(batch_name(checkpoint, batch_id)).alias("batch")), records, checkpoint, batch_id)


def is_recorded(spark: SparkSession, records: str, checkpoint: str, batch_id: int) -> bool:
    if not path_exists(spark, records):
        return False
    return not spark.read.parquet(records).where(F.col("batch") == batch_name(checkpoint, batch_id)).isEmpty()


def read_recorded(spark: SparkSession, target: str, records: str) -> DataFrame:
    """The rows of `target` whose batch is recorded; files of a batch that died on its way are left out."""
    rows = spark.read.parquet(target)
    if not path_exists(spark, records):
        return rows.limit(0)
    batch = F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9a-f]{12}-[0-9]+)-", 1)
    done = spark.read.parquet(records).select(F.col("batch").alias("__batch")).distinct()
    return rows.withColumn("__batch", batch).join(done, "__batch", "left_semi").select(*rows.columns)


def stream_load(rows: DataFrame, target: str, columns: Sequence[str], checkpoint: str) -> None:
    """Append the named columns of everything available now to the target."""
    def write(batch: DataFrame, batch_id: int) -> None:
        put_batch(batch.select(*columns), target, checkpoint, batch_id)
    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def stream_validate(rows: DataFrame, contract: Contract, model: PipelineModel | None, valid: str, quarantine: str,
                    checkpoint: str) -> None:
    """Score the rows that keep the contract, set the others aside with their failures.

    A prediction that is not finite sends its row to quarantine as well. Each batch is recorded beside `valid`
    (`records_of`) when both tables hold it: read them by `read_recorded` to see whole batches only.
    """
    bad_row = F.exists("_failures", lambda f: f["severity"] == "error")

    def write(batch: DataFrame, batch_id: int) -> None:
        if is_recorded(batch.sparkSession, records_of(valid), checkpoint, batch_id):
            return  # replayed after its record: both tables hold it
        judged = contract.annotate(batch).persist()
        try:
            good = judged.where(~bad_row).drop("_failures")
            bad = judged.where(bad_row)
            if model is not None:
                scored = model.transform(good)
                keep = [*good.columns, "prediction"]
                bad = bad.unionByName(scored.where(~is_finite(F.col("prediction"))).select(*good.columns),
                                      allowMissingColumns=True)
                good = scored.where(is_finite(F.col("prediction"))).select(*keep)
            put_batch(good, valid, checkpoint, batch_id)
            put_batch(bad, quarantine, checkpoint, batch_id)
            record_batch(batch.sparkSession, records_of(valid), checkpoint, batch_id)
        finally:
            judged.unpersist()
    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
