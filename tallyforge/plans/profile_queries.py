from pyspark.sql import functions as F

from tallyforge.operators import profile
from tallyforge.plans import fixtures as fx
from tallyforge.plans.registry import query, table


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_ALL_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_ALL_TEXTS = ["l_returnflag", "l_linestatus"]


@query("d2_table_profile", """
with k as (select *, count(*) as n from lineitem group by all)
select cast(sum(n) as bigint) as total_rows, 11::bigint as total_columns, cast(sum(n) - count(*) as bigint) as duplicate_rows_count,
       round((sum(n) - count(*)) / sum(n), 6) as duplicate_rows_ratio, 0.0::double as missing_cells_ratio from k""")
def table_profile(spark, sf):
    return _rounded(profile.table_profile(table(spark, sf, "lineitem")))


@query("d2_table_profile_gaps", f"""
select count(*) as total_rows, 6::bigint as total_columns, 0::bigint as duplicate_rows_count, 0.0::double as duplicate_rows_ratio,
       round((2 * count(*) - count(value) - count(strength)) / (6.0::double * count(*)), 6) as missing_cells_ratio
from {fx.EVENT_GAPS}""")
def table_profile_gaps(spark, sf):
    return _rounded(profile.table_profile(fx.event_gaps(spark, sf)))


def _numeric_sql(name, source):
    return f"""select '{name}' as "column", round(1 - count({name})::double / count(*), 6) as missing_null_ratio,
      round(count(*) filter (where {name} = 0)::double / count(*), 6) as zero_ratio,
      round(min({name})::double, 6) as min, round(max({name})::double, 6) as max, round(avg({name}), 6) as mean,
      round(quantile_cont({name}::double, 0.5), 6) as median_50, round(stddev_samp({name}), 6) as std_dev,
      round(quantile_cont({name}::double, 0.75) - quantile_cont({name}::double, 0.25), 6) as iqr_25_75,
      round(skewness({name}), 6) as skewness, round(kurtosis({name}), 6) as kurtosis from {source}"""


_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@query("d3_numeric_profile", " union all ".join(_numeric_sql(c, "lineitem") for c in _LINE_NUMBERS))
def numeric_profile(spark, sf):
    return _rounded(profile.numeric_profile(table(spark, sf, "lineitem"), _LINE_NUMBERS))


@query("d3_numeric_profile_gaps", " union all ".join(_numeric_sql(c, fx.EVENT_GAPS) for c in ("value", "strength")))
def numeric_profile_gaps(spark, sf):
    return _rounded(profile.numeric_profile(fx.event_gaps(spark, sf), ["value", "strength"]))


def _category_sql(name, source):
    return f"""select '{name}' as "column", round(1 - count({name})::double / count(*), 6) as missing_null_ratio,
      count(distinct {name}) as distinct_unique_count,
      (select {name} from {source} where {name} is not null group by {name} order by count(*) desc, {name} limit 1) as mode,
      (select count(*) from {source} where {name} is not null group by {name} order by count(*) desc limit 1) as frequency
      from {source}"""


@query("d4_categorical_profile", " union all ".join(
    _category_sql(c, fx.ORDER_GAPS) for c in ("o_orderstatus", "o_orderpriority")))
def categorical_profile(spark, sf):
    return _rounded(profile.categorical_profile(fx.order_gaps(spark, sf), ["o_orderstatus", "o_orderpriority"]))


@query("d5_datetime_profile", """
select 'o_orderdate' as "column", 0.0::double as missing_null_ratio, count(distinct o_orderdate) as distinct_unique_count,
  (select o_orderdate from orders group by 1 order by count(*) desc, 1 limit 1) as mode,
  min(o_orderdate) as min_date, max(o_orderdate) as max_date from orders""")
def datetime_profile(spark, sf):
    return profile.datetime_profile(table(spark, sf, "orders"), ["o_orderdate"])


_PAIR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_PAIR) for b in _PAIR[i + 1:]]


@query("d6_pearson", " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 4) as correlation from lineitem" for a, b in _PAIRS))
def pearson(spark, sf):
    return profile.pearson_matrix(table(spark, sf, "lineitem"), _PAIR)


def _rank_sql(a, b, source):
    rank = "rank() over (order by {0}) + (count(*) over (partition by {0}) - 1) / 2.0::double"
    return f"""select '{a}' as column_a, '{b}' as column_b, round(corr(ra, rb), 4) as correlation from (
      select {rank.format(a)} as ra, {rank.format(b)} as rb from {source} where {a} is not null and {b} is not null)"""


@query("d7_spearman", " union all ".join(_rank_sql(a, b, "lineitem") for a, b in _PAIRS))
def spearman(spark, sf):
    return profile.spearman_matrix(table(spark, sf, "lineitem"), _PAIR)


@query("d7_spearman_gaps", " union all ".join(
    _rank_sql(a, b, fx.EVENT_GAPS) for a, b in (("user_id", "value"), ("user_id", "strength"), ("value", "strength"))))
def spearman_gaps(spark, sf):
    return profile.spearman_matrix(fx.event_gaps(spark, sf), ["user_id", "value", "strength"])


def _kendall_sql(a, b):
    return f"""select '{a}' as column_a, '{b}' as column_b, round((p - q) / sqrt((t - tx) * (t - ty)), 6) as correlation from (
      with c as (select {a} as x, {b} as y, count(*)::double as n from lineitem group by all)
      select (select sum(l.n * r.n) from c l, c r where l.x < r.x and l.y < r.y) as p,
             (select sum(l.n * r.n) from c l, c r where l.x < r.x and l.y > r.y) as q,
             (select sum(n) * (sum(n) - 1) / 2 from c) as t,
             (select sum(n * (n - 1) / 2) from (select sum(n) as n from c group by x)) as tx,
             (select sum(n * (n - 1) / 2) from (select sum(n) as n from c group by y)) as ty)"""


_STEPS = ["l_quantity", "l_discount", "l_tax"]


@query("d8_kendall", " union all ".join(_kendall_sql(a, b) for i, a in enumerate(_STEPS) for b in _STEPS[i + 1:]))
def kendall(spark, sf):
    return profile.kendall_matrix(table(spark, sf, "lineitem"), _STEPS)


def _cramer_sql(a, b):
    return f"""select '{a}' as column_a, '{b}' as column_b, round(sqrt(chi / n / (least(r, k) - 1)), 6) as correlation from (
      with o as (select {a} as x, {b} as y, count(*)::double as n from lineitem group by all),
           e as (select x, y, sum(n) over (partition by x) * sum(n) over (partition by y) / sum(n) over () as e, n from o)
      select (select sum((n - e) * (n - e) / e) from e) as chi, (select sum(n) from o) as n,
             (select count(distinct x) from o) as r, (select count(distinct y) from o) as k)"""


@query("d9_cramer_v", " union all ".join(_cramer_sql(a, b) for a, b in (
    ("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber"), ("l_linestatus", "l_linenumber"))))
def cramer_v(spark, sf):
    return profile.cramer_v_matrix(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("d13_almost_constant", " union all ".join(f"""
select '{c}' as "column", round(max(n) / sum(n), 6) as top_share, max(n) / sum(n) >= 0.95 as almost_constant
  from (select count(*)::double as n from lineitem group by {c})""" for c in [*_ALL_NUMBERS, *_ALL_TEXTS, "l_shipdate"]) + """
union all select 'bulk', round(max(n) / sum(n), 6), max(n) / sum(n) >= 0.95
  from (select count(*)::double as n from lineitem group by case when l_quantity = 50 then 'full' else 'part' end)""")
def almost_constant(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("bulk", F.when(F.col("l_quantity") == 50, "full").otherwise("part"))
    return _rounded(profile.almost_constant(lines, lines.columns))



@query("e22_infer_contract", " union all ".join(
    [f"""select '{c}' as "column", 'double' as dtype, false as nullable, min({c})::double as min_value, max({c})::double as max_value,
         cast(null as varchar) as allowed_values from lineitem""" for c in _ALL_NUMBERS]
    + [f"""select '{c}', 'string', false, null, null,
         (select '["' || string_agg(f, '","' order by f) || '"]' from (select distinct {c} as f from lineitem))""" for c in _ALL_TEXTS]
    + ["select 'l_shipdate', 'string', false, null, null, null"]))
def infer_contract(spark, sf):
    return profile.infer_contract(table(spark, sf, "lineitem"))
