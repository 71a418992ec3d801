from pyspark.sql import functions as F

from tallyforge.operators import drift, quality, recsys, text
from tallyforge.operators.quality import MetricTest
from tallyforge.plans import fixtures as fx
from tallyforge.plans.drift_queries import _rounded
from tallyforge.plans.registry import query, table
from tallyforge.session import scratch_path

# --- data quality ---------------------------------------------------------------------------------


@query("f14_dataset_missing", f"""
select cast(sum(m) as bigint) as missing_count, round(sum(m) / (6.0::double * count(*)), 6) as missing_share
from (select cast(value is null as int) + cast(strength is null as int) + cast(event_type = 'view' as int) as m from {fx.EVENT_GAPS})""")
def dataset_missing(spark, sf):
    return _rounded(quality.dataset_missing(fx.event_gaps(spark, sf), ["view"]))


@query("f15_column_missing", f"""
select c as "column", v as value, round(v / n::double, 6) as share from (
  select count(*) as n, count(*) filter (where value is null) as value, count(*) filter (where event_type = 'view') as event_type
  from {fx.EVENT_GAPS}) unpivot (v for c in (value, event_type))""")
def column_missing(spark, sf):
    return _rounded(quality.column_missing(fx.event_gaps(spark, sf), ["value", "event_type"], ["view"]))


def _two_counts(a, b, test, source):
    return f"""with t as (select count(*) as n, count(*) filter (where {test}) as a from {source})
select '{a}' as metric, a as value, round(a / n::double, 6) as share from t
union all select '{b}', n - a, round((n - a) / n::double, 6) from t"""


@query("f16_regex_count", _two_counts("match", "mismatch", "regexp_matches(c_name, '^(?:Customer#0+[1-4])')", "customer"))
def regex_count(spark, sf):
    return _rounded(quality.count_where(table(spark, sf, "customer"), quality.regex_tests("c_name", "Customer#0+[1-4]")))


@query("f17_range_count", _two_counts("in_range", "out_of_range", "l_quantity between 5 and 45", "lineitem"))
def range_count(spark, sf):
    return _rounded(quality.count_where(table(spark, sf, "lineitem"), quality.range_tests("l_quantity", 5, 45)))


@query("f18_list_count", _two_counts("in_list", "out_of_list", "o_orderstatus in ('F', 'O')", "orders"))
def list_count(spark, sf):
    return _rounded(quality.count_where(table(spark, sf, "orders"), quality.list_tests("o_orderstatus", ["F", "O"])))


@query("f20_metric_by_group", """
select l_returnflag, m as metric, v as value, round(v / n::double, 6) as share from (
  select l_returnflag, count(*) as n, count(*) filter (where l_quantity between 5 and 45) as in_range,
         count(*) filter (where not (l_quantity between 5 and 45)) as out_of_range from lineitem group by l_returnflag)
  unpivot (v for m in (in_range, out_of_range))""")
def metric_by_group(spark, sf):
    return _rounded(quality.count_where(table(spark, sf, "lineitem"), quality.range_tests("l_quantity", 5, 45), ["l_returnflag"]))


# --- models ----------------------------------------------------------------------------------------

_ERR = "(l_quantity * 2000 - l_extendedprice)"


def _predicted(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("target"), (F.col("l_quantity") * 2000).alias("prediction"))


@query("f21_regression", f"""
select round(avg({_ERR}), 4) as me, round(avg(abs({_ERR})), 4) as mae, round(avg(abs({_ERR}) / abs(l_extendedprice)) * 100, 6) as mape,
       round(sqrt(avg({_ERR} * {_ERR})), 4) as rmse, round(1 - avg({_ERR} * {_ERR}) / var_pop(l_extendedprice), 6) as r2_score,
       round(max(abs({_ERR})), 4) as max_error from lineitem""")
def regression(spark, sf):
    one = quality.regression_quality(_predicted(spark, sf), "target", "prediction")
    return one.select(*[F.round(c, 6 if c in ("mape", "r2_score") else 4).alias(c) for c in one.columns])


@query("f22_dummy_reg", """
with m as (select quantile_cont(l_extendedprice, 0.5) as q from lineitem)
select round(avg(abs(l_extendedprice - q)), 4) as dummy_mae, round(avg(abs(l_extendedprice - q) / abs(l_extendedprice)) * 100, 4) as dummy_mape,
       round(stddev_pop(l_extendedprice), 4) as dummy_rmse from lineitem, m""")
def dummy_regression(spark, sf):
    return _rounded(quality.dummy_regression(table(spark, sf, "lineitem"), "l_extendedprice"), 4)


@query("g18_eval_metrics", f"""
select round(avg({_ERR} * {_ERR}), 2) as mean_squared_error, round(sqrt(avg({_ERR} * {_ERR})), 4) as root_mean_squared_error,
       round(sqrt(avg(power(ln(1 + greatest(l_quantity * 2000, 0)) - ln(1 + greatest(l_extendedprice, 0)), 2))), 6) as root_mean_squared_log_error,
       round(1 - avg({_ERR} * {_ERR}) / var_pop(l_extendedprice), 6) as r2_score from lineitem""")
def eval_metrics(spark, sf):
    one = quality.evaluation_metrics(_predicted(spark, sf), "target", "prediction")
    digits = {"mean_squared_error": 2, "root_mean_squared_error": 4}
    return one.select(*[F.round(c, digits.get(c, 6)).alias(c) for c in one.columns])


_SCORED = "(select toxic, least(1.0::double, n_chars / 20000::double) as s from labels join documents using (doc_id))"


def _scored(spark, sf):
    return (table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
            .select("toxic", F.least(F.lit(1.0), F.col("n_chars") / 20000.0).alias("score")))


@query("f23_classification", f"""
with c as (select count(*) filter (where toxic = 1 and s >= 0.5)::double as tp, count(*) filter (where toxic = 0 and s >= 0.5)::double as fp,
       count(*) filter (where toxic = 1 and s < 0.5)::double as fn, count(*) filter (where toxic = 0 and s < 0.5)::double as tn,
       avg(case when toxic = 1 then -ln(least(greatest(s, 1e-15), 1 - 1e-15)) else -ln(1 - least(greatest(s, 1e-15), 1 - 1e-15)) end) as ll from {_SCORED}),
     r as (select toxic, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0::double as r from {_SCORED}),
     a as (select (sum(r) filter (where toxic = 1) - p * (p + 1) / 2) / (p * n) as auc from r,
       (select count(*) filter (where toxic = 1)::double as p, count(*) filter (where toxic = 0)::double as n from {_SCORED}) group by p, n)
select round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1,
       round(ll, 6) as log_loss, round(auc, 6) as roc_auc from c, a""")
def classification(spark, sf):
    return _rounded(quality.classification_quality(_scored(spark, sf), "toxic", "score"))


@query("f24_dummy_class", """
with c as (select count(*) filter (where toxic = 1)::double as p, count(*) filter (where toxic = 0)::double as n from labels)
select round(greatest(p, n) / (p + n), 6) as accuracy, round(case when p > n then p / (p + n) else 0 end, 6)::double as precision,
       case when p > n then 1.0 else 0.0 end::double as recall, round(case when p > n then 2 * p / (2 * p + n) else 0 end, 6)::double as f1,
       0.5::double as roc_auc from c""")
def dummy_classification(spark, sf):
    return _rounded(quality.dummy_classification(table(spark, sf, "labels"), "toxic"))


_SAID = """(select event_type as actual, case when value < 100 then 'click' when value < 200 then 'purchase' when value < 300 then 'view'
    when value < 400 then 'signup' else 'other' end as said from events)"""
_CLASSES = f"""(select class, sum(n)::bigint as n_rows, sum(said)::double as said, sum(hit)::double as hit from (
    select actual as class, 1 as n, 0 as said, (actual = said)::int as hit from {_SAID}
    union all select said, 0, 1, 0 from {_SAID}) group by class)"""
_PER_CLASS = f"""(select class, n_rows, coalesce(hit / nullif(said, 0), 0) as precision, coalesce(hit / nullif(n_rows, 0), 0) as recall,
    coalesce(2 * hit / nullif(n_rows + said, 0), 0) as f1 from {_CLASSES})"""
_TYPES = ("click", "purchase", "view", "signup", "other")


def _said(spark, sf):
    v = F.col("value")
    said = F.when(v < 100, "click").when(v < 200, "purchase").when(v < 300, "view").when(v < 400, "signup").otherwise("other")
    chances = F.create_map(*[x for t in _TYPES for x in (F.lit(t), F.when(said == t, 0.6).otherwise(0.1))])
    return table(spark, sf, "events").select(F.col("event_type").alias("actual"), said.alias("said"), chances.alias("chances"))


@query("f23_per_class", f"""
select class, n_rows, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from {_PER_CLASS}""")
def per_class(spark, sf):
    return quality.class_quality(_said(spark, sf), "actual", "said", 6)


@query("f23_multiclass", f"""
select round(a.accuracy, 6) as accuracy, round(a.log_loss, 6) as log_loss, round(m.p, 6) as macro_precision, round(m.r, 6) as macro_recall,
       round(m.f, 6) as macro_f1 from (
  select avg((actual = said)::int::double) as accuracy,
         avg(-ln(case when actual not in {_TYPES} then 1e-15 when actual = said then 0.6::double else 0.1::double end)) as log_loss from {_SAID}) a,
  (select avg(precision) as p, avg(recall) as r, avg(f1) as f from {_PER_CLASS}) m""")
def multiclass(spark, sf):
    return _rounded(quality.multiclass_quality(_said(spark, sf), "actual", "said", "chances"))


@query("f24_dummy_multiclass", """
with c as (select event_type as class, count(*) as n from events group by 1),
     t as (select class, n, (select sum(n) from c)::double as total, (select count(*) from c) as k from c order by n desc, class limit 1)
select class, round(n / total, 6) as accuracy, round(n / total / k, 6) as macro_precision, round(1.0::double / k, 6) as macro_recall,
       round(2.0::double * n / (total + n) / k, 6) as macro_f1 from t""")
def dummy_multiclass(spark, sf):
    return _rounded(quality.dummy_multiclass(table(spark, sf, "events"), "event_type"))


@query("f29_suite_multiclass", f"""
with m as (select avg((actual = said)::int::double) as accuracy from {_SAID}),
     f as (select avg(f1) as f from {_PER_CLASS}),
     c as (select event_type as class, count(*) as n from events group by 1),
     t as (select n, (select sum(n) from c)::double as total, (select count(*) from c) as k from c order by n desc, class limit 1),
     rules as (select 'accuracy' as metric, accuracy as value, n / total as bound from m, t
       union all select 'macro_f1', f, 2.0::double * n / (total + n) / k from f, t)
select metric, '' as "column", round(value, 6) as value, '>' as op, round(bound, 6) as bound, case when value > bound then 'SUCCESS' else 'FAIL' end as status from rules
union all select 'log_loss', '', round(value, 6), '<', round(bound, 6), case when value < bound then 'SUCCESS' else 'FAIL' end from (
  select (select avg(-ln(case when actual not in {_TYPES} then 1e-15 when actual = said then 0.6::double else 0.1::double end)) from {_SAID}) as value,
         (select -sum(n / total * ln(n / total)) from c, (select sum(n)::double as total from c)) as bound)""")
def suite_multiclass(spark, sf):
    rows = _said(spark, sf)
    found = quality.long_metrics(quality.multiclass_quality(rows, "actual", "said", "chances")).unionByName(
        quality.long_metrics(quality.dummy_multiclass(rows, "actual", log_loss=True), "dummy_"))
    return quality.run_suite(found, "multiclass").withColumns({c: F.round(c, 6) for c in ("value", "bound")})


@query("f29_suite_binary", f"""
with c as (select count(*) filter (where toxic = 1 and s >= 0.5)::double as tp, count(*) filter (where toxic = 0 and s >= 0.5)::double as fp,
       count(*) filter (where toxic = 1 and s < 0.5)::double as fn, count(*) filter (where toxic = 0 and s < 0.5)::double as tn from {_SCORED}),
     r as (select toxic, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0::double as r from {_SCORED}),
     a as (select (sum(r) filter (where toxic = 1) - p * (p + 1) / 2) / (p * n) as auc from r,
       (select count(*) filter (where toxic = 1)::double as p, count(*) filter (where toxic = 0)::double as n from {_SCORED}) group by p, n),
     d as (select count(*) filter (where toxic = 1)::double as p, count(*) filter (where toxic = 0)::double as n from {_SCORED}),
     rules as (
       select 'accuracy' as metric, (tp + tn) / (tp + fp + fn + tn) as value, greatest(p, n) / (p + n) as bound from c, d
       union all select 'precision', coalesce(tp / nullif(tp + fp, 0), 0), case when p > n then p / (p + n) else 0 end from c, d
       union all select 'recall', coalesce(tp / nullif(tp + fn, 0), 0), 0 from c
       union all select 'f1', coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), case when p > n then 2 * p / (2 * p + n) else 0 end from c, d
       union all select 'roc_auc', auc, 0.5 from a)
select metric, '' as "column", round(value, 6) as value, '>' as op, round(bound, 6)::double as bound, case when value > bound then 'SUCCESS' else 'FAIL' end as status from rules""")
def suite_binary(spark, sf):
    rows = _scored(spark, sf)
    found = quality.long_metrics(quality.classification_quality(rows, "toxic", "score")).unionByName(
        quality.long_metrics(quality.dummy_classification(rows, "toxic"), "dummy_"))
    return quality.run_suite(found, "binary").withColumns({c: F.round(c, 6) for c in ("value", "bound")})


@query("f29_suite_stability", """
with r as (select * from events where ts < timestamp '2024-01-16'), c as (select * from events where ts >= timestamp '2024-01-16'),
     n as (select (select count(*) from c)::double / (select count(*) from r) as ratio),
     b as (select min(value) as lo, max(value) as hi, min(user_id) as ulo, max(user_id) as uhi from r),
     rules as (
       select 'row_count_ratio' as metric, '' as "column", ratio as value, '>=' as op, 0.9::double as bound from n
       union all select 'row_count_ratio', '', ratio, '<=', 1.1 from n
       union all select 'changed_types', '', 0, '==', 0
       union all select 'out_of_range', 'value', (select count(*) from c where value not between lo and hi)::double, '==', 0 from b
       union all select 'out_of_range', 'user_id', (select count(*) from c where user_id not between ulo and uhi)::double, '==', 0 from b
       union all select 'out_of_list', 'event_type', (select count(*) from c where event_type not in (select event_type from r))::double, '==', 0)
select metric, "column", round(value, 6) as value, op, bound, case when (op = '>=' and value >= bound) or (op = '<=' and value <= bound)
       or (op = '==' and value = bound) then 'SUCCESS' else 'FAIL' end as status from rules""")
def suite_stability(spark, sf):
    events = table(spark, sf, "events").select("ts", "value", "user_id", "event_type")
    old = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    found = quality.stability_metrics(events.where(old), events.where(~old), ["event_type"])
    return quality.run_suite(found, "stability").withColumn("value", F.round("value", 6))


_STATUS = "case when (op = '<' and value < bound) or (op = '>' and value > bound) or (op = '>=' and value >= bound) or (op = '==' and value = bound) then 'SUCCESS' else 'FAIL' end"


def _judged_sql(rules):
    return f"""select metric, '' as "column", round(value, 6) as value, op, round(bound, 6) as bound, {_STATUS} as status from ({rules})"""


def _judged(found, name):
    return quality.run_suite(found, name).withColumns({c: F.round(c, 6) for c in ("value", "bound")})


@query("f29_suite_regression", f"""
with m as (select avg(abs({_ERR})) as mae, sqrt(avg({_ERR} * {_ERR})) as rmse, 1 - avg({_ERR} * {_ERR}) / var_pop(l_extendedprice) as r2,
                  stddev_pop(l_extendedprice) as dummy from lineitem),
     d as (select avg(abs(l_extendedprice - (select quantile_cont(l_extendedprice, 0.5) from lineitem))) as dummy from lineitem)
{_judged_sql("select 'rmse' as metric, rmse as value, '<' as op, dummy as bound from m union all select 'mae', mae, '<', d.dummy from m, d "
             "union all select 'r2_score', r2, '>', 0 from m")}""")
def suite_regression(spark, sf):
    rows = _predicted(spark, sf)
    return _judged(quality.long_metrics(quality.regression_quality(rows, "target", "prediction")).unionByName(
        quality.long_metrics(quality.dummy_regression(rows, "target"))), "regression")


@query("f29_suite_quality", f"""
with k as (select l_quantity, l_returnflag, l_tax, count(*) as n from lineitem group by all)
{_judged_sql("select 'dataset_missing_share' as metric, 0.0::double as value, '<' as op, 0.1::double as bound "
             "union all select 'duplicate_rows', (select sum(n) - count(*) from k)::double, '==', 0 "
             "union all select 'constant_columns', (select (count(distinct l_quantity) < 2)::int + (count(distinct l_returnflag) < 2)::int + "
             "(count(distinct l_tax) < 2)::int from k)::double, '==', 0")}""")
def suite_quality(spark, sf):
    return _judged(quality.table_metrics(table(spark, sf, "lineitem").select("l_quantity", "l_returnflag", "l_tax")), "quality")


# --- recommendations ---------------------------------------------------------------------------------

K = 10
_CUT = "1998-04-25"
_RECS = f"""
inter as (select o_custkey as "user", l_partkey as item from orders join lineitem on o_orderkey = l_orderkey where o_orderdate < timestamp '{_CUT}'),
relevant as (select distinct o_custkey as "user", l_partkey as item from orders join lineitem on o_orderkey = l_orderkey where o_orderdate >= timestamp '{_CUT}'),
pop as (select item, p_brand, count(*) as score from inter join part on item = p_partkey group by all),
best as (select * from pop qualify row_number() over (partition by p_brand order by score desc, item) <= {K}),
brands as (select distinct "user", p_brand from inter join part on item = p_partkey),
recs as (select "user", item, score, row_number() over (partition by "user" order by score desc, item) as rank
         from brands join best using (p_brand) qualify rank <= {K})"""


def _recsys(spark, sf):
    """Interactions of the early orders, relevant items of the later ones, and popular parts of a customer's brands."""
    cut = F.lit(_CUT).cast("timestamp_ntz")
    bought = (table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user"), "o_orderdate")
              .join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item")), "o_orderkey"))
    interactions = bought.where(F.col("o_orderdate") < cut).select("user", "item")
    relevant = bought.where(F.col("o_orderdate") >= cut).select("user", "item").distinct()
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("item"), "p_brand", "p_type", "p_size", "p_retailprice")
    branded = interactions.join(part.select("item", "p_brand"), "item")
    pop = branded.groupBy("item", "p_brand").agg(F.count(F.lit(1)).alias("score"))
    best = recsys.top_k(pop.withColumnRenamed("p_brand", "user"), K).select(F.col("user").alias("p_brand"), "item", "score")
    brands = branded.select("user", "p_brand").distinct()
    recs = recsys.top_k(brands.join(best, "p_brand").drop("p_brand"), K)
    return interactions, relevant, part, recs


@query("f25_ranking_at_k", f"""
with {_RECS},
hits as (select r."user", r.rank, row_number() over (partition by r."user" order by r.rank) as nth
         from recs r join relevant v on r."user" = v."user" and r.item = v.item),
h as (select "user", count(*) as hits, sum(nth / rank::double) as prec, sum(1 / log2(rank + 1.0::double)) as dcg, min(rank) as first from hits group by 1),
ideal as (select n, sum(1 / log2(i + 1.0::double)) as idcg from range(1, {K + 1}) a(n), range(1, {K + 1}) b(i) where i <= n group by n),
u as (select x.*, coalesce(hits, 0)::double as hits, prec, dcg, first, idcg, least(n_relevant, {K}) as best
      from (select "user", count(*) as n_relevant from relevant group by 1) x left join h using ("user") join ideal on n = least(n_relevant, {K}))
select round(avg(hits / {K}), 6) as precision_at_k, round(avg(hits / n_relevant), 6) as recall_at_k,
       round(avg(case when hits > 0 then 2 * (hits / {K}) * (hits / n_relevant) / (hits / {K} + hits / n_relevant) else 0 end), 6) as f_at_k,
       round(avg(coalesce(prec / best, 0)), 6) as map_at_k, round(avg(coalesce(dcg / idcg, 0)), 6) as ndcg_at_k,
       round(avg(coalesce(1 / first::double, 0)), 6) as mrr_at_k, round(avg((hits > 0)::int), 6) as hit_rate_at_k from u""")
def ranking(spark, sf):
    _, relevant, _, recs = _recsys(spark, sf)
    return _rounded(recsys.ranking_quality(recs, relevant, K))


@query("f26_personalization", f"""
with {_RECS}, i as (select item, count(*)::double as n from recs group by 1), u as (select count(distinct "user")::double as u from recs)
select round(1 - sum(n * (n - 1)) / (max(u) * (max(u) - 1) * {K}), 6) as personalization from i, u""")
def personalization(spark, sf):
    return _rounded(recsys.personalization(_recsys(spark, sf)[3], K))


@query("f26_novelty", f"""
with {_RECS}, s as (select distinct "user", item from inter), n as (select count(distinct "user")::double as n from s),
i as (select item, -log2(count(*) / max(n)) as surprise from s, n group by item)
select round(avg(m), 6) as novelty from (select "user", avg(surprise) as m from recs join i using (item) group by 1)""")
def novelty(spark, sf):
    interactions, _, _, recs = _recsys(spark, sf)
    return _rounded(recsys.novelty(recs, interactions, K))


_UNIT = """v as (select p_partkey as item, p_size / sqrt(p_size * p_size + p_retailprice * p_retailprice / 10000) as a,
           p_retailprice / 100 / sqrt(p_size * p_size + p_retailprice * p_retailprice / 10000) as b from part)"""


def _item_features(part):
    return part.select("item", F.col("p_size").cast("double").alias("size"), (F.col("p_retailprice") / 100).alias("price"))


@query("f26_diversity", f"""
with {_RECS}, {_UNIT}, r as (select "user", item, a, b from recs join v using (item))
select round(avg(d), 6) as diversity from (select x."user", avg(1 - (x.a * y.a + x.b * y.b)) as d
  from r x join r y on x."user" = y."user" and x.item < y.item group by 1)""")
def diversity(spark, sf):
    _, _, part, recs = _recsys(spark, sf)
    return _rounded(recsys.diversity(recs, _item_features(part), ["size", "price"], K))


@query("f26_serendipity", f"""
with {_RECS}, {_UNIT}, h as (select distinct "user", item from inter), hv as (select "user", a, b from h join v using (item)),
s as (select r."user", r.item, 1 - avg(v.a * hv.a + v.b * hv.b) as far from recs r join v using (item) join hv on hv."user" = r."user" group by 1, 2)
select round(avg(m), 6) as serendipity from (select s."user", avg(case when q.item is null then 0 else far end) as m
  from s left join relevant q on q."user" = s."user" and q.item = s.item group by 1)""")
def serendipity(spark, sf):
    interactions, relevant, part, recs = _recsys(spark, sf)
    return _rounded(recsys.serendipity(recs, relevant, interactions, _item_features(part), ["size", "price"], K))


@query("f26_score_entropy", f"""
with {_RECS}, p as (select "user", score / sum(score) over (partition by "user")::double as p from recs)
select round(avg(e), 6) as score_entropy from (select "user", sum(-p * ln(p)) as e from p group by 1)""")
def score_entropy(spark, sf):
    return _rounded(recsys.score_entropy(_recsys(spark, sf)[3], K))


@query("f27_popularity_bias", f"""
with {_RECS}, c as (select item, count(distinct "user") as popularity from inter group by 1),
x as (select item, coalesce(n, 0)::double as n from c left join (select item, count(*) as n from recs group by 1) using (item)),
o as (select n, row_number() over (order by n, item) as i from x)
select (select round(avg(p), 6) from (select "user", avg(popularity) as p from recs join c using (item) group by 1)) as average_popularity,
       round(count(*) filter (where n > 0) / count(*)::double, 6) as coverage,
       round(2 * sum(i * n) / (count(*) * sum(n)) - (count(*) + 1) / count(*)::double, 6) as gini from o""")
def popularity_bias(spark, sf):
    interactions, _, _, recs = _recsys(spark, sf)
    return _rounded(recsys.popularity_bias(recs, interactions, K))


def _bias_sql(attribute, join):
    return f"""with {_RECS}, b as (select 'train' as side, {attribute}, count(*) as n from inter {join} group by 2
      union all select 'recommended', {attribute}, count(*) from recs {join} group by 2)
select side, {attribute}, n, round(n / sum(n) over (partition by side)::double, 6) as share from b"""


@query("f27_item_bias", _bias_sql("p_type", "join part on item = p_partkey"))
def item_bias(spark, sf):
    interactions, _, part, recs = _recsys(spark, sf)
    return _rounded(recsys.attribute_bias(recs, interactions, part, "item", "p_type", K))


@query("f27_user_bias", _bias_sql("c_mktsegment", 'join customer on "user" = c_custkey'))
def user_bias(spark, sf):
    interactions, _, _, recs = _recsys(spark, sf)
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("user"), "c_mktsegment")
    return _rounded(recsys.attribute_bias(recs, interactions, people, "user", "c_mktsegment", K))


@query("f28_rec_cases", f"""
with {_RECS} select "user", string_agg(cast(item as varchar), ',' order by rank) as items from recs group by 1""")
def rec_cases(spark, sf):
    return recsys.recommendation_cases(_recsys(spark, sf)[3], K)


@query("f28_display_features", f"""
with {_RECS}, n as (select "user", count(distinct item) as n_interactions from inter group by 1)
select "user", string_agg(cast(item as varchar), ',' order by rank) as items, string_agg(p_brand, ',' order by rank) as p_brand,
       string_agg(cast(p_size as varchar), ',' order by rank) as p_size, coalesce(any_value(n_interactions), 0) as n_interactions
from recs join part on item = p_partkey left join n using ("user") where "user" % 3 = 0 group by 1""")
def display_features(spark, sf):
    interactions, _, part, recs = _recsys(spark, sf)
    users = recs.where(F.col("user") % 3 == 0)
    return recsys.recommendation_cases(users, K, None, interactions, part, ["p_brand", "p_size"])


@query("f29_suite_recsys", f"""
with {_RECS},
hits as (select r."user", r.rank from recs r join relevant v on r."user" = v."user" and r.item = v.item),
h as (select "user", count(*)::double as hits, sum(1 / log2(rank + 1.0::double)) as dcg from hits group by 1),
ideal as (select n, sum(1 / log2(i + 1.0::double)) as idcg from range(1, {K + 1}) a(n), range(1, {K + 1}) b(i) where i <= n group by n),
u as (select coalesce(hits, 0) as hits, n_relevant, coalesce(dcg / idcg, 0) as ndcg
      from (select "user", count(*) as n_relevant from relevant group by 1) x left join h using ("user") join ideal on n = least(n_relevant, {K})),
m as (select avg(hits / {K}) as p, avg(hits / n_relevant) as r, avg(ndcg) as g, avg((hits > 0)::int) as h from u)
{_judged_sql("select 'precision_at_k' as metric, p as value, '>' as op, 0.0::double as bound from m union all select 'recall_at_k', r, '>', 0 from m "
             "union all select 'ndcg_at_k', g, '>', 0 from m union all select 'hit_rate_at_k', h, '>', 0 from m")}""")
def suite_recsys(spark, sf):
    _, relevant, _, recs = _recsys(spark, sf)
    return _judged(quality.long_metrics(recsys.ranking_quality(recs, relevant, K)), "recsys")


# --- test suites and history -----------------------------------------------------------------------------

def _metrics(spark, sf):
    """A long metric table over the early and late orders."""
    ref, cur = drift_sides(spark, sf)
    scores = drift.value_drift(ref, cur, drift.ColumnRoles(numerical=("o_totalprice",), categorical=("o_orderstatus",)))
    summary = drift.dataset_drift(scores)
    missing = quality.dataset_missing(cur)
    long = lambda df, m, c: df.select(F.lit(m).alias("metric"), F.lit("").alias("column"), F.col(c).cast("double").alias("value"))
    return (scores.select(F.lit("drift_score").alias("metric"), "column", F.col("score").alias("value"))
            .unionByName(long(summary, "dataset_drift_share", "drift_share"))
            .unionByName(long(summary, "number_of_drifted_columns", "number_of_drifted_columns"))
            .unionByName(long(missing, "dataset_missing_share", "missing_share"))
            .unionByName(quality.stability_metrics(ref.select("o_totalprice", "o_orderstatus"),
                                                   cur.select("o_totalprice", "o_orderstatus"), ["o_orderstatus"])))


def drift_sides(spark, sf):
    orders, cut = table(spark, sf, "orders"), F.lit(_CUT).cast("timestamp_ntz")
    return orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)


_SUITE = [MetricTest("dataset_drift_share", "<", 0.5), MetricTest("drift_score", "<", 0.1, "o_totalprice"),
          MetricTest("drift_score", "<", 0.1, "o_orderstatus"), MetricTest("dataset_missing_share", "==", 0.0),
          MetricTest("row_count_ratio", ">=", 0.9), MetricTest("row_count_ratio", "<=", 1.1, severity="warn"),
          MetricTest("changed_types", "==", 0.0), MetricTest("out_of_range", "<=", 0.0, "o_totalprice", "warn"),
          MetricTest("out_of_list", "==", 0.0, "o_orderstatus"), MetricTest("accuracy", ">=", 0.5)]

_O = ("orders", "o_orderdate", _CUT)


def _suite_sql():
    from tallyforge.plans.drift_queries import _js_sql, _wasserstein_sql
    early, late = f"o_orderdate < timestamp '{_CUT}'", f"o_orderdate >= timestamp '{_CUT}'"
    values = {("drift_score", "o_totalprice"): _wasserstein_sql(*_O, "o_totalprice"),
              ("drift_score", "o_orderstatus"): _js_sql(*_O, "o_orderstatus"),
              ("dataset_drift_share", ""): f"((({_wasserstein_sql(*_O, 'o_totalprice')} >= 0.1)::int + ({_js_sql(*_O, 'o_orderstatus')} >= 0.1)::int) / 2.0::double)",
              ("dataset_missing_share", ""): "0.0::double",
              ("row_count_ratio", ""): f"(select count(*) filter (where {late}) / (count(*) filter (where {early}))::double from orders)",
              ("changed_types", ""): "0.0::double",
              ("out_of_range", "o_totalprice"): f"(select count(*)::double from orders where {late} and o_totalprice not between (select min(o_totalprice) from orders where {early}) and (select max(o_totalprice) from orders where {early}))",
              ("out_of_list", "o_orderstatus"): f"(select count(*)::double from orders where {late} and o_orderstatus not in (select o_orderstatus from orders where {early}))",
              ("accuracy", ""): "null::double"}
    rows = " union all ".join(
        f"select '{t.metric}' as metric, '{t.column}' as \"column\", {values[(t.metric, t.column)]} as value, '{t.op}' as op, "
        f"{t.bound}::double as bound, '{t.severity}' as severity" for t in _SUITE)
    return f"""(select metric, "column", round(value, 6) as value, op, bound, case when coalesce(case op when '<' then value < bound
      when '<=' then value <= bound when '>' then value > bound when '>=' then value >= bound else value = bound end, false)
      then 'SUCCESS' when severity = 'warn' then 'WARNING' else 'FAIL' end as status from ({rows}))"""


@query("f29_test_suite", f"select * from {_suite_sql()}")
def test_suite(spark, sf):
    return quality.run_tests(_metrics(spark, sf), _SUITE).withColumn("value", F.round("value", 6))


@query("f29_test_summary", f"""
select count(*) as total_tests, count(*) filter (where status = 'SUCCESS') as success_tests, count(*) filter (where status = 'FAIL') as failed_tests,
       count(*) filter (where status = 'WARNING') as warning_tests, count(*) filter (where status <> 'SUCCESS') = 0 as all_passed from {_suite_sql()}""")
def test_suite_summary(spark, sf):
    return quality.summarize_tests(quality.run_tests(_metrics(spark, sf), _SUITE))


_SHARE_RULE = "select 'dataset_drift_share' as metric, (select value from s where metric = 'dataset_drift_share') as value, '<' as op, 0.5::double as bound"


@query("f29_suite_drift", f"""with s as (select * from {_suite_sql()}) {_judged_sql(_SHARE_RULE)}""")
def suite_drift(spark, sf):
    return _judged(_metrics(spark, sf), "drift")


@query("f29_suite_no_target", f"""
with s as (select * from {_suite_sql()})
{_judged_sql(_SHARE_RULE + " union all select 'dataset_missing_share', 0.0, '<', 0.1 union all select 'row_count_ratio', "
             "(select max(value) from s where metric = 'row_count_ratio'), '>=', 0.9")}""")
def suite_no_target(spark, sf):
    return _judged(_metrics(spark, sf), "no_target")


@query("f30_metric_row", f"""
with t as (select * from {_suite_sql()})
select timestamp '2024-02-01' as run_ts, max(value) filter (where metric = 'dataset_drift_share') as dataset_drift_share,
       2 * max(value) filter (where metric = 'dataset_drift_share') as number_of_drifted_columns,
       max(value) filter (where metric = 'dataset_missing_share') as dataset_missing_share, null::double as regression_rmse from t""")
def metric_row(spark, sf):
    return quality.metric_row(_metrics(spark, sf), "2024-02-01", [
        "dataset_drift_share", "number_of_drifted_columns", "dataset_missing_share", "regression_rmse"])


@query("f31_latest", """
select 'row_count' as metric, event_type as "column", timestamp '2024-02-02' as run_ts, count(*)::double as value from events group by event_type
union all select 'row_count', 'all', timestamp '2024-02-01', count(*)::double from events""")
def latest_metrics(spark, sf):
    events, path = table(spark, sf, "events"), scratch_path(spark, "history")
    per_type = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("row_count").alias("metric"), F.col("event_type").alias("column"), "value")
    whole = events.agg(F.count(F.lit(1)).alias("value")).select(F.lit("row_count").alias("metric"), F.lit("all").alias("column"), "value")
    quality.append_history(per_type.withColumn("value", F.col("value") + 1).unionByName(whole), "2024-02-01", path)
    quality.append_history(per_type, "2024-02-02", path)
    return quality.latest_metrics(spark.read.parquet(path))


@query("f31_score_lines", """
with runs as (select date_trunc('day', ts) as run_ts, event_type as "column", avg(value) as value from events
              where event_type <> 'signup' or ts < timestamp '2024-01-10' group by 1, 2)
select "column", run_ts, round(value, 6) as value, round(value - lag(value) over (partition by "column" order by run_ts), 6) as change
from runs where "column" in ('view', 'click', 'signup')""")
def score_lines(spark, sf):
    """A history with one run a day, one type of which is no longer measured after some runs, as lines per column."""
    events, path = table(spark, sf, "events"), scratch_path(spark, "history")
    kept = events.where((F.col("event_type") != "signup") | (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")))
    daily = kept.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("run_ts"), F.col("event_type").alias("column")).agg(F.avg("value").alias("value"))
    daily.select("run_ts", F.lit("mean_value").alias("metric"), "column", "value").write.parquet(path)
    return _rounded(quality.metric_lines(spark.read.parquet(path), "mean_value", ["view", "click", "signup"]))


# --- text --------------------------------------------------------------------------------------------------

@query("f32_text_profile", r"""
select doc_id, length(text)::int as text_length, len(regexp_extract_all(text, '\S+'))::int as word_count,
       round(length(regexp_replace(text, '[\p{L} ]', '', 'g')) / length(text)::double * 100, 6) as non_letter_percent,
       regexp_matches(text, 'https?://|www\.') as has_link, regexp_matches(text, '^(?:[A-Z][a-z]+ )') as matches,
       text = 'The end.' as is_exact, json_valid(text) as is_json from documents""")
def text_profile(spark, sf):
    return _rounded(text.text_profile(table(spark, sf, "documents"), "text", ["doc_id"], "[A-Z][a-z]+ ", "The end."))


@query("f32_oov", r"""
with v as (select distinct unnest(regexp_extract_all(lower(text), '\S+')) as word from benchmark),
w as (select doc_id, unnest(regexp_extract_all(lower(text), '\S+')) as word from documents)
select doc_id, round(100 * count(*) filter (where v.word is null) / count(*)::double, 6) as oov_percent
from w left join v using (word) group by doc_id""")
def oov(spark, sf):
    vocabulary = table(spark, sf, "benchmark").select(F.explode(text.words(F.lower("text"))).alias("word"))
    return _rounded(text.out_of_vocabulary(table(spark, sf, "documents"), "text", "doc_id", vocabulary))


@query("f33_cosine", """
select a.vec_id, round(list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])
       * list_dot_product(b.embedding::double[], b.embedding::double[])), 6) as cosine from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def cosine(spark, sf):
    vectors = table(spark, sf, "embeddings")
    other = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return _rounded(vectors.join(other, "vec_id").select("vec_id", text.cosine_similarity(F.col("embedding"), F.col("other")).alias("cosine")))


@query("f34_text_drift", r"""
with t as (select lang in ('en', 'de') as ref, length(text)::double as text_length,
                  len(regexp_extract_all(text, '\S+'))::double as word_count from documents),
u as (select ref, 'text_length' as c, text_length as v from t union all select ref, 'word_count', word_count from t),
s as (select c, v, sum(r) over (partition by c order by v) / sum(r) over (partition by c) - sum(k) over (partition by c order by v) / sum(k) over (partition by c) as d,
             lead(v) over (partition by c order by v) - v as gap
      from (select c, v, (count(*) filter (where ref))::double as r, (count(*) filter (where not ref))::double as k from u group by 1, 2))
select s.c as "column", 'wasserstein' as method, round(sum(abs(d) * gap) / max(sd), 6) as score
from s join (select c, stddev_pop(v) filter (where ref) as sd from u group by 1) n on n.c = s.c group by s.c""")
def text_drift(spark, sf):
    docs = table(spark, sf, "documents")
    is_ref = F.col("lang").isin("en", "de")
    sides = [text.text_profile(docs.where(cond), "text", ["doc_id"]).select("text_length", "word_count") for cond in (is_ref, ~is_ref)]
    scores = drift.value_drift(*sides, drift.ColumnRoles(numerical=("text_length", "word_count")))
    return _rounded(scores.select("column", "method", "score"))


@query("f34_text_content", """
with d as (select lang, doc_id % 2 = 0 as even from documents)
select 'halves' as pair, count(*) filter (where even) as n_reference, count(*) filter (where not even) as n_current, false as told_apart from d
union all
select 'languages', count(*) filter (where lang in ('en', 'de')), count(*) filter (where lang not in ('en', 'de')), true from d""")
def text_content(spark, sf):
    """Two relations every table must show: halves by key cannot be told apart by their terms, languages can (area over 0.9)."""
    docs = table(spark, sf, "documents")
    options = drift.DriftOptions.from_config({"text": {"method": "domain", "threshold": 0.9}})
    out = None
    for pair, is_ref in (("halves", F.col("doc_id") % 2 == 0), ("languages", F.col("lang").isin("en", "de"))):
        scores = drift.value_drift(docs.where(is_ref), docs.where(~is_ref), drift.ColumnRoles(text=("text",), id="doc_id"), options)
        sizes = docs.agg(F.lit(pair).alias("pair"), F.count_if(is_ref).alias("n_reference"), F.count_if(~is_ref).alias("n_current"))
        one = sizes.join(scores.select(F.lit(pair).alias("pair"), F.col("drifted").alias("told_apart")), "pair")
        out = one if out is None else out.unionByName(one)
    return out
