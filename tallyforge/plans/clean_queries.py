from pyspark.sql import functions as F

from tallyforge.functions.columns import is_missing
from tallyforge.operators import clean
from tallyforge.plans import fixtures as fx
from tallyforge.plans.registry import query, table


@query("b1_json_flatten", """
select event_id, user_id, value, cast(json_extract(props, '$.k') as bigint) as props_k from events""")
def json_flatten(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "props")
    return clean.flatten_json(events, "props")


@query("b2_normalise", """
select l_orderkey, l_partkey, cast(l_linenumber as bigint) as l_linenumber,
       cast(cast(l_quantity as decimal(12,2)) as double) as l_quantity, l_returnflag = 'R' as returned
from lineitem""")
def normalise(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("decimal(12,2)").alias("l_quantity"),
        (F.col("l_returnflag") == "R").alias("returned"))
    return clean.normalize_types(lines)


@query("b3_cast_coerce", f"""
select cast(event_id as bigint) as event_id, try_cast(ts as timestamp) as ts, cast(user_id as bigint) as user_id
from {fx.TEXT_EVENTS}""")
def cast_coerce(spark, sf):
    raw = fx.text_events(spark, sf).select("event_id", "ts", "user_id")
    return clean.apply_types(raw, {"event_id": "bigint", "ts": "datetime64[ns]", "user_id": "bigint",
                                   "absent": "double"})


@query("b4_column_names", """
select o_orderkey as order_key, o_totalprice as gia_tri_tong, o_orderstatus as status from orders""")
def column_names(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias(" Order-Key "),
                                               F.col("o_totalprice").alias("Giá trị (tổng)"),
                                               F.col("o_orderstatus").alias("STATUS"))
    return clean.normalize_column_names(orders)


@query("b5_trim", f"""
select doc_id, lang, n_chars, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as text from {fx.BLANK_DOCUMENTS}""")
def trim(spark, sf):
    return clean.normalize_column_names(clean.trim_strings(fx.blank_documents(spark, sf)))


@query("b6_empty_null", f"""
select doc_id, lang, n_chars, case when regexp_matches(text, '^\\s*$') then null else text end as text
from {fx.BLANK_DOCUMENTS}""")
def empty_null(spark, sf):
    return clean.blank_to_null(fx.blank_documents(spark, sf))


@query("b7_hash_pii", """
select sha256(cast(c_custkey as varchar)) as c_custkey, sha256(c_name) as c_name, c_mktsegment from customer""")
def hash_pii(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return clean.hash_columns(people, ["c_custkey", "c_name"])


@query("b8_drop", "select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "customer"), ["c_name", "not_there"])


@query("b9_key_dups", """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""")
def key_dups(spark, sf):
    return clean.key_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("b13_drop_null_cols", f"select event_id, ts, user_id, event_type, value from {fx.EVENT_GAPS}")
def drop_null_cols(spark, sf):
    return clean.drop_sparse_columns(fx.event_gaps(spark, sf), 0.5)


@query("b14_drop_zero_cols", """
select l_orderkey, l_partkey, l_quantity, l_discount, l_tax from lineitem""")
def drop_zero_cols(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax",
        F.when(F.col("l_discount") > 0.09, F.col("l_discount")).otherwise(0.0).alias("deep_discount"))
    return clean.drop_zero_columns(lines, 0.8)


@query("b15_drop_null_rows", f"""
select event_id, ts, user_id, event_type, value, strength from {fx.EVENT_GAPS}
where (cast(value is null as int) + cast(strength is null as int)) / 2.0 <= 0.5""")
def drop_null_rows(spark, sf):
    return clean.drop_sparse_rows(fx.event_gaps(spark, sf), 0.5, ["value", "strength"])


@query("b16_median_fill", f"""
select event_id, round(coalesce(value, (select quantile_cont(value, 0.5) from {fx.EVENT_GAPS})), 6) as value,
       round(coalesce(strength, (select quantile_cont(strength, 0.5) from {fx.EVENT_GAPS})), 6) as strength
from {fx.EVENT_GAPS}""")
def median_fill(spark, sf):
    filled = clean.fill_medians(fx.event_gaps(spark, sf), ["value", "strength"])
    return filled.select("event_id", F.round("value", 6).alias("value"), F.round("strength", 6).alias("strength"))


@query("b18_sniff_dt", """
select o_orderkey, o_orderdate, o_orderstatus from orders""")
def sniff_datetime(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"),
                                               "o_orderstatus")
    return clean.promote_datetimes(orders)


@query("d10_missing_cols", f"""
select c as "column", n_missing, round(100.0 * n_missing / n, 6) as percent_missing from (
  select count(*) as n, count(*) - count(value) as value, count(*) - count(strength) as strength from {fx.EVENT_GAPS})
  unpivot (n_missing for c in (value, strength)) where n_missing > 0""")
def missing_cols(spark, sf):
    from tallyforge.operators.profile import missing_by_column
    return missing_by_column(fx.event_gaps(spark, sf)).withColumn("percent_missing", F.round("percent_missing", 6))


@query("d11_zero_cols", """
select c as "column", n_zero, round(100.0 * n_zero / n, 6) as percent_zero from (
  select count(*) as n, count(*) filter (where l_quantity = 0) as l_quantity,
         count(*) filter (where l_extendedprice = 0) as l_extendedprice,
         count(*) filter (where l_discount = 0) as l_discount, count(*) filter (where l_tax = 0) as l_tax
  from lineitem) unpivot (n_zero for c in (l_quantity, l_extendedprice, l_discount, l_tax)) where n_zero > 0""")
def zero_cols(spark, sf):
    from tallyforge.operators.profile import zero_by_column
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return zero_by_column(lines).withColumn("percent_zero", F.round("percent_zero", 6))


@query("d12_missing_rows", f"""
select event_id, cast(value is null as int) + cast(strength is null as int) as n_missing,
       round(100.0 * (cast(value is null as int) + cast(strength is null as int)) / 6, 6) as percent_missing
from {fx.EVENT_GAPS}""")
def missing_rows(spark, sf):
    gaps = fx.event_gaps(spark, sf)
    n = clean.null_cells(gaps)
    return gaps.select("event_id", n.alias("n_missing"), F.round(n * 100.0 / len(gaps.columns), 6).alias("percent_missing"))
