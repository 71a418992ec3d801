from pyspark.sql import functions as F

from tallyforge.operators import drift
from tallyforge.operators.drift import ColumnRoles, DriftOptions
from tallyforge.operators.split import exact_split
from tallyforge.plans import fixtures as fx
from tallyforge.plans.registry import query, table

_DAY = "1998-04-25"


def _sides(spark, sf, name, when, date):
    df, cut = table(spark, sf, name), F.lit(date).cast("timestamp_ntz")
    return df.where(F.col(when) < cut), df.where(F.col(when) >= cut)


def _orders(spark, sf):
    return _sides(spark, sf, "orders", "o_orderdate", _DAY)


def _events(spark, sf):
    return _sides(spark, sf, "events", "ts", "2024-01-16")


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _ecdf_sql(source, when, date, column):
    """Steps of both cumulative shares over the distinct values."""
    return f"""(select v, lead(v) over (order by v) - v as gap,
      abs(sum(r) over (order by v) / sum(r) over () - sum(c) over (order by v) / sum(c) over ()) as d,
      sum(r) over () as rn, sum(c) over () as cn
      from (select {column}::double as v, (count(*) filter (where {when} < timestamp '{date}'))::double as r,
                   (count(*) filter (where {when} >= timestamp '{date}'))::double as c from {source} group by 1))"""


def _wasserstein_sql(source, when, date, column):
    return (f"(select sum(d * gap) / greatest(0.001, (select stddev_pop({column}) from {source} where {when} < timestamp '{date}')) "
            f"from {_ecdf_sql(source, when, date, column)})")


def _ks_sql(source, when, date, column):
    return f"(select max(d) from {_ecdf_sql(source, when, date, column)})"


def _shares_sql(source, when, date, column):
    return f"""(select v, r / sum(r) over () as p, c / sum(c) over () as q, r, c, sum(r) over () as rn, sum(c) over () as cn
      from (select {column} as v, (count(*) filter (where {when} < timestamp '{date}'))::double as r,
                   (count(*) filter (where {when} >= timestamp '{date}'))::double as c from {source} group by 1))"""


def _js_sql(source, when, date, column):
    return f"""(select sqrt(greatest(0.0::double, sum((case when p > 0 then p * ln(2 * p / (p + q)) else 0.0 end
      + case when q > 0 then q * ln(2 * q / (p + q)) else 0.0 end) / 2))) from {_shares_sql(source, when, date, column)})"""


def _psi_sql(source, when, date, column):
    return f"""(select sum((q2 - p2) * ln(q2 / p2)) from (select case when p > 0 then p else 0.0001::double end as p2,
      case when q > 0 then q else 0.0001::double end as q2 from {_shares_sql(source, when, date, column)}))"""


def _bins_sql(source, when, date, column):
    edges = " + ".join(f"(case when {column} > (select quantile_cont({column}::double, {i / 10}) from {source} "
                       f"where {when} < timestamp '{date}') then 1 else 0 end)" for i in range(1, 10))
    return f"(select *, {edges} as bin from {source})"


_O = ("orders", "o_orderdate", _DAY)
_E = ("events", "ts", "2024-01-16")
_KS_SCALE = "sqrt((select count(*) filter (where {1} < timestamp '{2}')::double * count(*) filter (where {1} >= timestamp '{2}') / count(*) from {0}))"
_KS_P = ("(select least(1.0, greatest(0.0, 2 * sum((case when j % 2 = 1 then 1 else -1 end) * exp(-2.0::double * j * j * l * l)))) "
         "from (select {d} * {s} as l), range(1, 101) t(j))")

_FLAGS = """case when method in ('ks', 'chisquare', 'z', 't_test') then score < threshold else score >= threshold end as drifted"""
_F2 = f"""(select *, {_FLAGS} from (
  select 'o_totalprice' as "column", 'num' as kind, 'wasserstein' as method, {_wasserstein_sql(*_O, 'o_totalprice')} as score, 0.1::double as threshold
  union all select 'o_custkey', 'num', 'ks', {_KS_P.format(d=_ks_sql(*_O, 'o_custkey'), s=_KS_SCALE.format(*_O))}, 0.05
  union all select 'o_orderkey', 'num', 'psi', {_psi_sql(_bins_sql(*_O, 'o_orderkey'), *_O[1:], 'bin')}, 0.25
  union all select 'o_orderstatus', 'cat', 'jensenshannon', {_js_sql(*_O, 'o_orderstatus')}, 0.1
  union all select 'o_orderpriority', 'cat', 'psi', {_psi_sql(*_O, 'o_orderpriority')}, 0.0001))"""

_ROLES = ColumnRoles(numerical=("o_custkey", "o_orderkey"), categorical=("o_orderstatus", "o_orderpriority"),
                     target="o_totalprice", prediction="o_prediction", task="regression")
_OPTIONS = DriftOptions(per_column_method={"o_custkey": "ks", "o_orderkey": "psi", "o_orderpriority": "psi"},
                        per_column_threshold={"o_orderkey": 0.25, "o_orderpriority": 0.0001})


@query("f2_value_drift", f"""
select "column", kind, method, round(score, 6) as score, threshold, drifted from {_F2}""")
def value_drift(spark, sf):
    scores = drift.value_drift(*_orders(spark, sf), _ROLES, _OPTIONS)
    return scores.withColumn("score", F.round("score", 6))


@query("f12_selected_columns", f"""
select "column", kind, method, round(score, 6) as score, threshold, drifted from {_F2} where "column" in ('o_orderkey', 'o_orderstatus')""")
def selected_columns(spark, sf):
    options = DriftOptions(per_column_method=_OPTIONS.per_column_method, per_column_threshold=_OPTIONS.per_column_threshold,
                           selected=("o_orderkey", "o_orderstatus"))
    return drift.value_drift(*_orders(spark, sf), _ROLES, options).withColumn("score", F.round("score", 6))


@query("f10_dataset_drift", f"""
select count(*) as number_of_columns, count(*) filter (where drifted) as number_of_drifted_columns,
       round(count(*) filter (where drifted) / count(*)::double, 6) as drift_share, 0.5::double as threshold,
       count(*) filter (where drifted) / count(*)::double >= 0.5 as dataset_drift from {_F2}""")
def dataset_drift(spark, sf):
    return _rounded(drift.dataset_drift(drift.value_drift(*_orders(spark, sf), _ROLES, _OPTIONS)))


@query("f3_wasserstein", f"""
select 'value' as "column", round({_wasserstein_sql(*_E, 'value')}, 6) as wasserstein
union all select 'user_id', round({_wasserstein_sql(*_E, 'user_id')}, 6)""")
def wasserstein(spark, sf):
    return _rounded(drift.ecdf_distances(*_events(spark, sf), ["value", "user_id"])).select("column", "wasserstein")


@query("f3_wasserstein_self", """
select 'value' as "column", 0.0::double as wasserstein, 0.0::double as ks, count(*) as n_reference, count(*) as n_current from events""")
def wasserstein_self(spark, sf):
    events = table(spark, sf, "events")
    return drift.ecdf_distances(events, events, ["value"])


@query("f4_js", f"""
select 'event_type' as "column", round({_js_sql(*_E, 'event_type')}, 6) as jensenshannon""")
def jensen_shannon(spark, sf):
    return _rounded(drift.category_distances(*_events(spark, sf), ["event_type"]).select("column", "jensenshannon"))


@query("f5_ks", f"""
select 'value' as "column", round({_ks_sql(*_E, 'value')}, 6) as ks,
       round({_KS_P.format(d=_ks_sql(*_E, 'value'), s=_KS_SCALE.format(*_E))}, 6) as p_value
union all select 'user_id', round({_ks_sql(*_E, 'user_id')}, 6),
       round({_KS_P.format(d=_ks_sql(*_E, 'user_id'), s=_KS_SCALE.format(*_E))}, 6)""")
def kolmogorov_smirnov(spark, sf):
    n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    scores = drift.ecdf_distances(*_events(spark, sf), ["value", "user_id"], normalize=False)
    return _rounded(scores.select("column", "ks", drift.p_value(F.lit("ks"), F.col("ks"), F.sqrt(n * m / (n + m))).alias("p_value")))


@query("f6_psi", f"""
select 'event_type' as "column", round({_psi_sql(*_E, 'event_type')}, 6) as psi,
       case when {_psi_sql(*_E, 'event_type')} >= 0.25 then 'critical' when {_psi_sql(*_E, 'event_type')} >= 0.1 then 'warning' else 'ok' end as level
union all select 'value', round({_psi_sql(_bins_sql(*_E, 'value'), *_E[1:], 'bin')}, 6),
       case when {_psi_sql(_bins_sql(*_E, 'value'), *_E[1:], 'bin')} >= 0.25 then 'critical'
            when {_psi_sql(_bins_sql(*_E, 'value'), *_E[1:], 'bin')} >= 0.1 then 'warning' else 'ok' end""")
def psi(spark, sf):
    ref, cur = _events(spark, sf)
    edges = drift.quantile_bins(ref, ["value"])
    both = drift.category_distances(drift.binned(ref, edges), drift.binned(cur, edges), ["value"]).unionByName(
        drift.category_distances(ref, cur, ["event_type"]))
    return _rounded(both.select("column", "psi", drift.psi_level(F.col("psi")).alias("level")))


@query("f7_chi2", " union all ".join(f"""
select '{c}' as "column", round(sum((c - p * cn) * (c - p * cn) / (p * cn)), 6) as chisquare, count(*) - 1 as dof
from {_shares_sql(*_O, c)}""" for c in ("o_orderstatus", "o_orderpriority")))
def chi_square(spark, sf):
    return _rounded(drift.category_distances(*_orders(spark, sf), ["o_orderstatus", "o_orderpriority"])
                    .select("column", "chisquare", "dof"))


def _labels(spark, sf):
    labels = table(spark, sf, "labels")
    return labels.where(F.col("quality") == 1), labels.where(F.col("quality") == 0)


@query("f8_z", """
select 'toxic' as "column", round((a / n - b / m) / sqrt((a + b) / (n + m) * (1 - (a + b) / (n + m)) * (1 / n + 1 / m)), 6) as z from (
  select sum(toxic) filter (where quality = 1)::double as a, sum(toxic) filter (where quality = 0)::double as b,
         count(*) filter (where quality = 1)::double as n, count(*) filter (where quality = 0)::double as m from labels)""")
def two_proportion_z(spark, sf):
    return _rounded(drift.category_distances(*_labels(spark, sf), ["toxic"]).select("column", "z"))


@query("f9_ttest", " union all ".join(f"""
select '{c}' as "column", round((ra - ca) / sqrt(rv / rn + cv / cn), 6) as t,
       round(power(rv / rn + cv / cn, 2) / (power(rv / rn, 2) / (rn - 1) + power(cv / cn, 2) / (cn - 1)), 4) as dof from (
  select avg({c}) filter (where ts < timestamp '2024-01-16') as ra, avg({c}) filter (where ts >= timestamp '2024-01-16') as ca,
         var_samp({c}) filter (where ts < timestamp '2024-01-16') as rv, var_samp({c}) filter (where ts >= timestamp '2024-01-16') as cv,
         count(*) filter (where ts < timestamp '2024-01-16') as rn, count(*) filter (where ts >= timestamp '2024-01-16') as cn from events)"""
                              for c in ("value", "user_id")))
def t_test(spark, sf):
    return drift.welch_t(*_events(spark, sf), ["value", "user_id"]).select(
        "column", F.round("t", 6).alias("t"), F.round("dof", 4).alias("dof"))


@query("f11_gate", f"""
select true as validation_passed, share < 0.5 as drift_passed, round(share, 6) as drift_share, share < 0.5 as passed
from (select count(*) filter (where drifted) / count(*)::double as share from {_F2})""")
def gate(spark, sf):
    from tallyforge.operators.contract import Check, Contract, Field
    contract = Contract("orders", (Field("o_totalprice", "double", (Check("in_range", {"min_val": 0, "max_val": 1e7}),)),), ("o_orderkey",))
    validation = contract.split_gate(exact_split(table(spark, sf, "orders"), "o_orderkey"))
    summary = drift.dataset_drift(drift.value_drift(*_orders(spark, sf), _ROLES, _OPTIONS))
    return _rounded(drift.gate(validation, summary))


def _vectors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return vectors.where(F.col("label") < 5), vectors.where(F.col("label") >= 5)


_DIMS = "(select label < 5 as ref, i, embedding[i]::double as x from embeddings, range(1, 65) t(i))"


@query("f13_emb_distance", f"""
select round(sqrt(sum((r - c) * (r - c))), 6) as euclidean, round(1 - sum(r * c) / sqrt(sum(r * r) * sum(c * c)), 6) as cosine
from (select i, avg(x) filter (where ref) as r, avg(x) filter (where not ref) as c from {_DIMS} group by i)""")
def embedding_distance(spark, sf):
    return _rounded(drift.embedding_distance(*_vectors(spark, sf), "embedding"))


@query("f13_emb_ratio", f"""
with s as (select i, x, sum(cast(ref as int)) over w / sum(cast(ref as int)) over (partition by i)::double
                        - sum(cast(not ref as int)) over w / sum(cast(not ref as int)) over (partition by i)::double as d
           from {_DIMS} window w as (partition by i order by x)),
     g as (select i, abs(d) as d, lead(x) over (partition by i order by x) - x as gap from (select distinct i, x, d from s)),
     n as (select i, stddev_pop(x) filter (where ref) as sd from {_DIMS} group by i),
     w as (select i, sum(d * gap) / greatest(0.001, max(sd)) as w from g join n using (i) group by i)
select count(*) as dimensions, count(*) filter (where w >= 0.1) as drifted,
       round(count(*) filter (where w >= 0.1) / count(*)::double, 6) as drift_ratio,
       count(*) filter (where w >= 0.1) / count(*)::double > 0.2 as embedding_drift from w""")
def embedding_ratio(spark, sf):
    return _rounded(drift.embedding_drift_ratio(*_vectors(spark, sf), "embedding"))


@query("f13_emb_model")
def embedding_model(spark, sf):
    return drift.embedding_drift_model(*_vectors(spark, sf), "embedding", "vec_id")


@query("f13_emb_mmd")
def embedding_mmd(spark, sf):
    return drift.embedding_mmd(*_vectors(spark, sf), "embedding")
