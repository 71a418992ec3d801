from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallyforge.operators.contract import Check, Contract, Field
from tallyforge.plans.registry import query, table
from tallyforge.session import scratch_path
from tallyforge.streaming import jobs


@query("h1_stream_load", """
select user_id, count(*) as n_rows, round(sum(value), 2) as total, max(ts) as last_ts from events group by user_id""")
def stream_load(spark, sf):
    folder = scratch_path(spark, "stream")
    rows = jobs.read_files(spark, sf, table(spark, sf, "events").schema, "events.parquet")
    jobs.stream_load(rows, f"{folder}/features", ["user_id", "ts", "value", "event_id"], f"{folder}/progress")
    loaded = spark.read.parquet(f"{folder}/features")
    return loaded.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total"),
                                         F.max("ts").alias("last_ts"))


@query("h1_two_streams", """
select s_suppkey as id from supplier union all select c_custkey from customer""")
def two_streams(spark, sf):
    """Two streams with their own progress load into one table."""
    folder = scratch_path(spark, "stream")
    for name, key in (("supplier", "s_suppkey"), ("customer", "c_custkey")):
        rows = jobs.read_files(spark, sf, table(spark, sf, name).schema, f"{name}.parquet")
        jobs.stream_load(rows.withColumnRenamed(key, "id"), f"{folder}/all", ["id"], f"{folder}/progress-{name}")
    return spark.read.parquet(f"{folder}/all")


@query("h2_stream_validate", """
select 'scored' as target, count(*) as n_rows from events where value between 5 and 450 and event_type in ('click', 'purchase', 'signup', 'view')
union all select 'quarantine', count(*) from events where not (value between 5 and 450 and event_type in ('click', 'purchase', 'signup', 'view'))""")
def stream_validate(spark, sf):
    events, folder = table(spark, sf, "events"), scratch_path(spark, "stream")
    contract = Contract("events", (
        Field("value", "double", (Check("in_range", {"min_val": 5, "max_val": 450}),)), Field("user_id", "bigint"),
        Field("event_type", "string", (Check("isin", {"values": ["click", "purchase", "signup", "view"]}),))), ("event_id",))
    model = Pipeline(stages=[VectorAssembler(inputCols=["user_id"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="value")]).fit(events)
    jobs.stream_validate(jobs.read_files(spark, sf, events.schema, "events.parquet"), contract, model,
                         f"{folder}/scored", f"{folder}/quarantine", f"{folder}/progress")
    counted = [jobs.read_recorded(spark, f"{folder}/{t}", jobs.records_of(f"{folder}/scored")).agg(F.lit(t).alias("target"), F.count(F.lit(1)).alias("n_rows"))
               for t in ("scored", "quarantine")]
    return counted[0].unionByName(counted[1])
