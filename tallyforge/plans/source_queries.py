from pyspark.sql import functions as F

from tallyforge.operators.prep import TabularPreprocessor
from tallyforge.operators.split import exact_split
from tallyforge.plans import fixtures as fx
from tallyforge.plans.registry import query, table
from tallyforge.session import scratch_path
from tallyforge.sources import conform, readers, writers


@query("a1_param_sql", """
select event_id, user_id, ts, value, cast(json_extract(props, '$.k') as bigint) as props_k
from events where event_type = 'purchase' and value >= 100.0""")
def param_sql(spark, sf):
    return readers.fetch(
        spark, "select event_id, user_id, ts, value, props from {events} where event_type = :kind and value >= :low",
        {"kind": "purchase", "low": 100.0}, flatten=["props"], types={"ts": "datetime64[ns]"}, key=["event_id"],
        events=table(spark, sf, "events"))


@query("a2_scan", "select * from nation")
def scan(spark, sf):
    return readers.scan_table(spark, {"path": f"{sf}/nation.parquet"})


@query("a3_csv_roundtrip", """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       case when c_nationkey < 15 then 'train' when c_nationkey < 20 then 'val' else 'test' end as split from customer""")
def csv_roundtrip(spark, sf):
    people, folder = table(spark, sf, "customer"), scratch_path(spark, "csv")
    parts = {"train": F.col("c_nationkey") < 15, "val": F.col("c_nationkey").between(15, 19),
             "test": F.col("c_nationkey") > 19}
    for name, rows in parts.items():
        people.where(rows).write.csv(f"{folder}/{name}", header=True)
    back = readers.read_splits(spark, folder, people.schema)
    out = [df.withColumn("split", F.lit(name)) for name, df in back.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("a4_fallback_read", "select * from nation")
def fallback_read(spark, sf):
    return readers.read_dataset(spark, f"{sf}/nation_of_another_day.parquet", "parquet",
                                fallback=f"{sf}/nation.parquet")


@query("a5_split_export", f"""
select split, count(*) as n_rows, round(sum(o_totalprice), 2) as total from {fx.SPLIT_ORDERS} group by split""")
def split_export(spark, sf):
    path = scratch_path(spark, "splits")
    writers.export_splits(exact_split(table(spark, sf, "orders"), "o_orderkey"), path)
    return (spark.read.parquet(path).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("a6_bulk_load", """
select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, (select count(*) from part) as loaded_rows from part""")
def bulk_load(spark, sf):
    part, folder = table(spark, sf, "part"), scratch_path(spark, "bulk")
    part.write.csv(f"{folder}/in", header=True, sep="|")
    done = writers.bulk_load_all(spark, {
        "part": {"source_path": f"{folder}/in", "target": f"{folder}/out", "schema": part.schema,
                 "options": {"delimiter": "|"}},
        "absent": {"source_path": f"{folder}/nothing", "target": f"{folder}/none", "schema": part.schema}})
    return spark.read.parquet(f"{folder}/out").withColumn("loaded_rows", F.lit(done[0].rows).cast("long"))


@query("a6_failed_load", """
select s_suppkey, s_name, 'failed' as status from supplier""")
def failed_load(spark, sf):
    """A file with a bad line over a table that is there: the load fails, the table keeps its rows."""
    suppliers, folder = table(spark, sf, "supplier").select("s_suppkey", "s_name"), scratch_path(spark, "bulk")
    suppliers.write.csv(f"{folder}/in", header=True)
    writers.bulk_load(spark, f"{folder}/in", f"{folder}/out", suppliers.schema)
    suppliers.select(F.concat(F.lit("no. "), "s_suppkey").alias("s_suppkey"), "s_name").write.csv(f"{folder}/bad", header=True)
    (done,) = writers.bulk_load_all(spark, {
        "bad": {"source_path": f"{folder}/bad", "target": f"{folder}/out", "schema": suppliers.schema, "options": {"mode": "overwrite"}}})
    return spark.read.parquet(f"{folder}/out").withColumn("status", F.lit(done.status))


@query("a3_csv_by_name", "select n_nationkey, n_name, n_regionkey from nation")
def csv_by_name(spark, sf):
    """Columns in another order than declared, and one more, are bound by their names."""
    nations, folder = table(spark, sf, "nation"), scratch_path(spark, "csv")
    nations.select(F.lit("-").alias("note"), "n_regionkey", "n_name", "n_nationkey").write.csv(folder, header=True)
    return readers.read_csv(spark, folder, nations.schema)


@query("a7_append", """
select s_suppkey, s_name, s_nationkey, s_acctbal from supplier
union all select s_suppkey, s_name, s_nationkey, s_acctbal from supplier""")
def append(spark, sf):
    suppliers, folder = table(spark, sf, "supplier"), scratch_path(spark, "append")
    suppliers.write.csv(f"{folder}/in", header=True)
    writers.append_rows(suppliers, f"{folder}/out")
    writers.append_csv(spark, f"{folder}/in", f"{folder}/out", suppliers.schema)
    return spark.read.parquet(f"{folder}/out")


_DECLARED = {"event_id": {"type": "integer", "nullable": False}, "ts": {"type": "datetime", "nullable": False},
             "value": {"type": "float", "nullable": False}, "event_type": {"type": "categorical"},
             "channel": {"type": "string", "nullable": False}}


@query("a10_conform", f"""
select try_cast(event_id as bigint) as event_id, try_cast(ts as timestamp) as ts, try_cast(value as double) as value,
       event_type, cast(null as varchar) as channel from {fx.TEXT_EVENTS}""")
def conform_table(spark, sf):
    return conform.conform(fx.text_events(spark, sf), conform.declared(_DECLARED))


@query("a10_conform_report", f"""
with t as (select count(*) as n, count(*) filter (where ts is not null and try_cast(ts as timestamp) is null) as bad_ts,
    count(*) filter (where value is not null and try_cast(value as double) is null) as bad_value from {fx.TEXT_EVENTS})
select 'event_id' as "column", 'bigint' as declared_type, true as present, 0::bigint as bad_cells, 0::bigint as null_violations from t
union all select 'ts', 'timestamp_ntz', true, bad_ts, bad_ts from t
union all select 'value', 'double', true, bad_value, bad_value from t
union all select 'event_type', 'string', true, 0, 0 from t
union all select 'channel', 'string', false, 0, n from t""")
def conform_report(spark, sf):
    return conform.conform_report(fx.text_events(spark, sf), conform.declared(_DECLARED))


@query("a12_limit", "select * from orders order by o_orderdate, o_orderkey limit 10000")
def limited_sample(spark, sf):
    return table(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey").limit(10000)


@query("a13_ingest_report", f"""
select count(*) as total_rows, 5::bigint as feature_count, count(*) filter (where split = 'train') as train_rows,
       count(*) filter (where split = 'val') as val_rows, count(*) filter (where split = 'test') as test_rows
from {fx.SPLIT_ORDERS}""")
def ingest_report(spark, sf):
    report = writers.ingest_report(exact_split(table(spark, sf, "orders"), "o_orderkey"), ["o_orderkey"])
    path = scratch_path(spark, "report")
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("a13_validation_report", f"""
with f as (select split, count(*) as n, cast(sum(cast(o_orderstatus not in ('F', 'O') as int) + cast(not (o_totalprice between 1000 and 450000) as int)) as bigint) as e
           from {fx.SPLIT_ORDERS} group by split)
select case when max(e) > 0 then 'FAILED' else 'PASSED' end as status, sum(n)::bigint as total_records, sum(e)::bigint as error_count,
       coalesce(sum(e) filter (where split = 'train'), 0)::bigint as train_errors, coalesce(sum(e) filter (where split = 'val'), 0)::bigint as val_errors,
       coalesce(sum(e) filter (where split = 'test'), 0)::bigint as test_errors from f""")
def validation_report(spark, sf):
    from tallyforge.plans.contract_queries import _ORDER_CONTRACT

    report = writers.validation_report(_ORDER_CONTRACT.split_gate(exact_split(table(spark, sf, "orders"), "o_orderkey")))
    path = scratch_path(spark, "report")
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("a13_transformation_report", f"""
select count(*) filter (where split = 'train') as train_rows, count(*) filter (where split = 'val') as val_rows,
       count(*) filter (where split = 'test') as test_rows, count(*) filter (where o_orderpriority = '5-LOW') as missing_o_orderstatus,
       1 + (select count(distinct o_orderstatus) from orders) as feature_count,
       'numerical__o_custkey,' || (select string_agg('categorical__o_orderstatus_' || s, ',' order by s) from (select distinct o_orderstatus as s from orders)) as feature_names,
       'o_orderkey' as dropped_identifier from {fx.SPLIT_ORDERS}""")
def transformation_report(spark, sf):
    parts = exact_split(fx.order_gaps(spark, sf), "o_orderkey")
    config = {"categorical": {"encoder": {"type": "onehot", "handle_unknown": "ignore"}}}
    model = TabularPreprocessor(numerical=["o_custkey"], categorical=["o_orderstatus"], config=config).fit(parts.where(F.col("split") == "train"))
    report = writers.transformation_report(parts, model.feature_names(), "o_orderkey", ["o_orderstatus"])
    path = scratch_path(spark, "report")
    writers.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("a16_flatten", """
select 'event_' || event_type as metric_name, avg_k as "value.mean", n as "value.count" from (
  select event_type, round(avg(cast(json_extract(props, '$.k') as bigint)), 6) as avg_k, count(*) as n
  from events group by event_type)""")
def flatten_metrics(spark, sf):
    from tallyforge.operators.profile import flatten_metric_list
    k = F.get_json_object("props", "$.k").cast("long")
    nested = (table(spark, sf, "events").groupBy("event_type")
              .agg(F.round(F.avg(k), 6).alias("mean"), F.count(F.lit(1)).alias("count"))
              .select(F.array(F.struct(F.concat(F.lit("event_"), "event_type").alias("metric_name"),
                                       F.struct("mean", "count").alias("value"))).alias("metrics")))
    return flatten_metric_list(nested, "metrics")
