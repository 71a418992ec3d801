from pyspark.sql import functions as F

from tallyforge.operators.contract import Check, Contract, Field, GroupMean, contract_named, policy_tier
from tallyforge.operators.split import exact_split
from tallyforge.plans import fixtures as fx
from tallyforge.plans.registry import query, table

_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINES = Contract(
    "lines",
    (Field("l_quantity", "double", (Check("in_range", {"min_val": 5, "max_val": 45}),)),
     Field("l_returnflag", "string", (Check("isin", {"values": ["A", "N"]}),
                                      Check("length_between", {"min_len": 1, "max_len": 1}))),
     Field("l_discount", "double", (Check("at_most", {"threshold": 0.09}, severity="warn", message="outlier"),)),
     Field("l_shipdate", "timestamp_ntz")),
    key=_KEY, row_checks=(Check("sum_at_most", {"components": ["l_discount", "l_tax"], "total": 0.15}),))

_LINE_RULES = [("l_quantity", "in_range", "not (l_quantity between 5 and 45)", "error"),
               ("l_returnflag", "isin", "l_returnflag not in ('A', 'N')", "error"),
               ("l_discount", "outlier", "l_discount > 0.09", "warn"),
               ("l_discount,l_tax", "sum_at_most", "0.0::double + l_discount + l_tax > 0.15::double", "error")]
_LINE_BAD = "(" + " or ".join(f"({t})" for _, _, t, s in _LINE_RULES if s == "error") + ")"


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                               "l_returnflag", "l_discount", "l_tax", "l_shipdate")


def _one_field(spark, sf, name, key, field, row_checks=()):
    contract = Contract("one", (field,) if field else (), key=key, row_checks=row_checks)
    return contract.failures(table(spark, sf, name)).select("column", "check_rule", *key)


@query("e1_range", """
select 'l_quantity' as "column", 'in_range' as check_rule, l_orderkey, l_linenumber from lineitem
where l_quantity < 5 or l_quantity > 45""")
def numeric_range(spark, sf):
    return _one_field(spark, sf, "lineitem", ("l_orderkey", "l_linenumber"),
                      Field("l_quantity", "double", (Check("in_range", {"min_val": 5, "max_val": 45}),)))


@query("e2_strlen", """
select 'text' as "column", 'length_between' as check_rule, doc_id from documents
where length(text) < 1 or length(text) > 255""")
def string_length(spark, sf):
    return _one_field(spark, sf, "documents", ("doc_id",), Field("text", "string", (Check("length_between"),)))


@query("e3_isin", """
select 'o_orderstatus' as "column", 'isin' as check_rule, o_orderkey from orders where o_orderstatus not in ('F', 'O')""")
def allowed_set(spark, sf):
    return _one_field(spark, sf, "orders", ("o_orderkey",),
                      Field("o_orderstatus", "string", (Check("isin", {"values": ["F", "O"]}),)))


@query("e4_not_null", f"""
select 'value' as "column", 'not_nullable' as check_rule, event_id from {fx.EVENT_GAPS} where value is null""")
def not_null(spark, sf):
    contract = Contract("gaps", (Field("value", "double"), Field("strength", "double", nullable=True)), ("event_id",))
    return contract.failures(fx.event_gaps(spark, sf)).select("column", "check_rule", "event_id")


_TEXT_CONTRACT = Contract(
    "text_events", (Field("event_id", "bigint"), Field("ts", "timestamp_ntz"), Field("value", "double"),
                    Field("user.*", "bigint", regex=True)), ("event_id",), add_missing=True)


@query("b11_coerce_errors", f"""
select c as "column", count(*) as n_errors from (
  select 'ts' as c from {fx.TEXT_EVENTS} where try_cast(ts as timestamp) is null
  union all select 'value' from {fx.TEXT_EVENTS} where try_cast(value as double) is null) group by c""")
def coerce_errors(spark, sf):
    return (_TEXT_CONTRACT.failures(fx.text_events(spark, sf)).where(F.col("check_rule").startswith("coerce_"))
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_errors")))


@query("e5_coerce", f"""
select 'ts' as "column", 'coerce_timestamp_ntz' as check_rule, ts as failure_value, cast(event_id as bigint) as event_id
from {fx.TEXT_EVENTS} where try_cast(ts as timestamp) is null
union all select 'value', 'coerce_double', value, cast(event_id as bigint)
from {fx.TEXT_EVENTS} where try_cast(value as double) is null""")
def coerce_cells(spark, sf):
    return _TEXT_CONTRACT.failures(fx.text_events(spark, sf)).select("column", "check_rule", "failure_value", "event_id")


@query("e7_sum_le_total", """
select 'sum_at_most' as check_rule, l_orderkey, l_linenumber from lineitem where 0.0::double + l_discount + l_tax > 0.15::double""")
def sum_le_total(spark, sf):
    check = Check("sum_at_most", {"components": ["l_discount", "l_tax"], "total": 0.15})
    return _one_field(spark, sf, "lineitem", ("l_orderkey", "l_linenumber"), None, (check,)).drop("column")


@query("e8_ordered_triple", """
select 'ordered_triple' as check_rule, l_orderkey, l_linenumber from lineitem
where not (l_tax <= l_discount and l_discount <= l_quantity)""")
def ordered_columns(spark, sf):
    check = Check("ordered_triple", {"low": "l_tax", "target": "l_discount", "high": "l_quantity"})
    return _one_field(spark, sf, "lineitem", ("l_orderkey", "l_linenumber"), None, (check,)).drop("column")


_MEANS = (("F", "O"), ("O", "F"), ("absent", "P"), ("P", "absent"))


@query("e9_group_mean", " union all ".join(f"""
select 'o_totalprice' as "column", '{lo}<{hi}' as check_rule from orders
having not (coalesce(avg(o_totalprice) filter (where o_orderstatus = '{lo}'), 0)
            < coalesce(avg(o_totalprice) filter (where o_orderstatus = '{hi}'), 'infinity'::double))""" for lo, hi in _MEANS))
def group_mean(spark, sf):
    contract = Contract("means", (), ("o_orderkey",), group_checks=tuple(
        GroupMean("o_orderstatus", "o_totalprice", lo, hi, f"{lo}<{hi}") for lo, hi in _MEANS))
    return contract.failures(table(spark, sf, "orders")).select("column", "check_rule")


@query("e10_regex", """
select 'c_name' as "column", 'matches' as check_rule, c_custkey from customer
where not regexp_matches(c_name, '^(?:Customer#0+[1-4][0-9]*$)')""")
def regex(spark, sf):
    return _one_field(spark, sf, "customer", ("c_custkey",),
                      Field("c_name", "string", (Check("matches", {"pattern": "Customer#0+[1-4][0-9]*$"}),)))


@query("e11_outlier_warn", """
select count(*) as n_rows, count(*) filter (where l_extendedprice > 100000) as n_warnings, count(*) as n_kept from lineitem""")
def outlier_warning(spark, sf):
    contract = Contract("warned", (Field("l_extendedprice", "double", (
        Check("at_most", {"threshold": 100000.0}, severity="warn"),)),), _KEY)
    lines = contract.annotate(table(spark, sf, "lineitem"))
    return lines.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size("_failures") > 0).alias("n_warnings"),
                     F.count_if(~F.exists("_failures", lambda f: f["severity"] == "error")).alias("n_kept"))


@query("e12_failure_cases", " union all ".join(
    f"select '{c}' as \"column\", '{r}' as check_rule, '{s}' as severity, {', '.join(_KEY)} from lineitem where {t}"
    for c, r, t, s in _LINE_RULES))
def failure_cases(spark, sf):
    return LINES.failures(_lines(spark, sf)).select("column", "check_rule", "severity", *_KEY)


@query("e6_structure", """
select 'l_comment' as "column", 'column_required' as check_rule
union all select 'l_tax', 'column_not_in_contract'
union all select 'l_quantity,l_orderkey', 'column_order'
union all select 'l_quantity', 'in_range' from lineitem where not (l_quantity between 5 and 45)""")
def structure(spark, sf):
    contract = Contract("shape", (Field("l_quantity", "double", (Check("in_range", {"min_val": 5, "max_val": 45}),)),
                                  Field("l_orderkey", "bigint"), Field("l_comment", "string"),
                                  Field("l_note", "string", nullable=True)),
                        ("l_orderkey",), strict=True, ordered=True, add_missing=True)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    return contract.failures(lines).select("column", "check_rule")


@query("e13_first_failure", f"""
select 'l_quantity' as "column", 'in_range' as check_rule, {', '.join(_KEY)} from lineitem
where not (l_quantity between 5 and 45) order by {', '.join(_KEY)} limit 1""")
def first_failure(spark, sf):
    return LINES.first_failure(_lines(spark, sf)).select("column", "check_rule", *_KEY)


@query("e14_drop_invalid", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_discount, l_tax, l_shipdate
from lineitem where not {_LINE_BAD}""")
def drop_invalid(spark, sf):
    return LINES.drop_invalid(_lines(spark, sf))


_ERROR_CELLS = " + ".join(f"cast(({t}) as int)" for _, _, t, s in _LINE_RULES if s == "error")


@query("e15_error_rate", f"""
select count(*) as total_records, cast(sum({_ERROR_CELLS}) as bigint) as failure_count,
       0::bigint as unknown_index_error_count, count(*) filter (where {_LINE_BAD}) as invalid_record_count,
       round(count(*) filter (where {_LINE_BAD}) / count(*)::double, 6) as error_rate from lineitem""")
def error_rate(spark, sf):
    return LINES.summary(_lines(spark, sf)).withColumn("error_rate", F.round("error_rate", 6))


_ORDER_CONTRACT = Contract(
    "orders", (Field("o_orderstatus", "string", (Check("isin", {"values": ["F", "O"]}),)),
               Field("o_totalprice", "double", (Check("in_range", {"min_val": 1000.0, "max_val": 450000.0}),))),
    ("o_orderkey",))


@query("e16_split_gate", f"""
with f as (select split, count(*) as total_records, cast(sum(cast(o_orderstatus not in ('F', 'O') as int)
    + cast(not (o_totalprice between 1000 and 450000) as int)) as bigint) as error_count from {fx.SPLIT_ORDERS} group by split)
select split, total_records, error_count, case when error_count > 0 then 'FAILED' else 'PASSED' end as status,
       case when (select max(error_count) from f) > 0 then 'FAILED' else 'PASSED' end as overall_status from f""")
def split_gate(spark, sf):
    return _ORDER_CONTRACT.split_gate(exact_split(table(spark, sf, "orders"), "o_orderkey"))


@query("c5_failure_head", f"""
select split, "column", check_rule, o_orderkey, position from (
  select *, row_number() over (partition by split order by rule_id, o_orderkey) as position from (
    select split, 0 as rule_id, 'o_orderstatus' as "column", 'isin' as check_rule, o_orderkey
    from {fx.SPLIT_ORDERS} where o_orderstatus not in ('F', 'O')
    union all select split, 1, 'o_totalprice', 'in_range', o_orderkey
    from {fx.SPLIT_ORDERS} where not (o_totalprice between 1000 and 450000))) where position <= 100""")
def failure_head(spark, sf):
    head = _ORDER_CONTRACT.failure_head(exact_split(table(spark, sf, "orders"), "o_orderkey"), "split")
    return head.select("split", "column", "check_rule", "o_orderkey", F.col("position").cast("long").alias("position"))


@query("e17_tier", " union all ".join(f"""
select '{n}' as rule_set, case when r < 0.01 then 'drop' when r <= 0.05 then 'quarantine' else 'stop' end as tier
from (select count(*) filter (where not ({t})) / count(*)::double as r from lineitem)""" for n, t in (
    ("price_104000", "l_extendedprice <= 104000"), ("quantity_49", "l_quantity <= 49"), ("discount_5", "l_discount <= 0.05"))))
def policy(spark, sf):
    lines, out = table(spark, sf, "lineitem"), None
    for name, column, limit in (("price_104000", "l_extendedprice", 104000.0), ("quantity_49", "l_quantity", 49.0),
                                ("discount_5", "l_discount", 0.05)):
        contract = Contract(name, (Field(column, "double", (Check("at_most", {"threshold": limit}),)),), _KEY)
        one = contract.summary(lines).select(F.lit(name).alias("rule_set"), policy_tier(F.col("error_rate")).alias("tier"))
        out = one if out is None else out.unionByName(one)
    return out


@query("e21_inference_contract", """
select cast(l_quantity as double) as l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag from lineitem
where l_quantity between 2 and 48 and l_extendedprice between 1000 and 100000 and l_returnflag in ('A', 'N', 'R')""")
def inference_contract(spark, sf):
    number = lambda n, lo, hi: Field(n, "double", (Check("in_range", {"min_val": lo, "max_val": hi}),))
    contract = Contract("scoring", (number("l_quantity", 2, 48), number("l_extendedprice", 1000, 100000),
                                    number("l_discount", 0, 1), number("l_tax", 0, 1),
                                    Field("l_returnflag", "string", (Check("isin", {"values": ["A", "N", "R"]}),))),
                        ("l_returnflag",), strict=True)
    raw = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("l_quantity"), "l_extendedprice",
                                              "l_discount", "l_tax", "l_returnflag")
    return contract.drop_invalid(raw)


@query("e15_quarantine", f"""
select 'valid' as target, count(*) as n_rows from lineitem where l_quantity <= 49
union all select 'quarantine', count(*) from lineitem""")
def quarantine(spark, sf):
    from tallyforge.operators.contract import ContractError
    from tallyforge.session import scratch_path
    lines, folder = _lines(spark, sf), scratch_path(spark, "route")
    soft = Contract("soft", (Field("l_quantity", "double", (Check("at_most", {"threshold": 49.0}),)),), _KEY)
    soft.route(lines, 0.05, f"{folder}/valid", f"{folder}/none")
    try:
        LINES.route(lines, 0.05, f"{folder}/none", f"{folder}/quarantine")
    except ContractError:
        pass
    counted = [spark.read.parquet(f"{folder}/{t}").agg(F.lit(t).alias("target"), F.count(F.lit(1)).alias("n_rows"))
               for t in ("valid", "quarantine")]
    return counted[0].unionByName(counted[1])


_WORKOUT = """(select event_id as "User_ID", case when user_id % 7 = 0 then 'none' when user_id % 2 = 0 then 'male' else 'female' end as "Gender",
  user_id as "Age", value as "Height", value / 2 as "Weight", value as "Duration", value / 2 as "Heart_Rate", 36.5::double as "Body_Temp" from events)"""


@query("e20_workout_by_name", f"""
with t as (select * from {_WORKOUT}), f as (
  select 'User_ID' as "column", 'in_range' as check_rule, count(*) as n from t where "User_ID" < 1
  union all select 'Gender', 'isin', count(*) from t where "Gender" not in ('male', 'female', 'other')
  union all select 'Age', 'in_range', count(*) from t where "Age" not between 0 and 200
  union all select 'Height', 'in_range', count(*) from t where "Height" not between 40 and 255
  union all select 'Weight', 'in_range', count(*) from t where "Weight" not between 2 and 300
  union all select 'Duration', 'in_range', count(*) from t where "Duration" not between 0 and 300
  union all select 'Heart_Rate', 'in_range', count(*) from t where "Heart_Rate" not between 40 and 220)
select * from f where n > 0""")
def workout_by_name(spark, sf):
    """The registered workout contract, looked up by its name, over event rows in the shape of measurements."""
    events = table(spark, sf, "events")
    gender = F.when(F.col("user_id") % 7 == 0, "none").when(F.col("user_id") % 2 == 0, "male").otherwise("female")
    rows = events.select(F.col("event_id").alias("User_ID"), gender.alias("Gender"), F.col("user_id").alias("Age"), F.col("value").alias("Height"),
                         (F.col("value") / 2).alias("Weight"), F.col("value").alias("Duration"), (F.col("value") / 2).alias("Heart_Rate"),
                         F.lit(36.5).alias("Body_Temp"))
    return contract_named("workout_input").failures(rows).groupBy("column", "check_rule").agg(F.count(F.lit(1)).alias("n"))
