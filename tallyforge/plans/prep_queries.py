from pyspark.sql import functions as F

from tallyforge.operators import prep
from tallyforge.operators.knn import knn_impute
from tallyforge.operators.prep import TabularPreprocessor
from tallyforge.operators.split import exact_split
from tallyforge.plans import fixtures as fx
from tallyforge.plans.drift_queries import _rounded
from tallyforge.plans.registry import query, table
from tallyforge.session import scratch_path


@query("g1_split", f"select o_orderkey, split from {fx.SPLIT_ORDERS}")
def split(spark, sf):
    return exact_split(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "split")


def _impute_sql(stat):
    return f"""select event_id, round(coalesce(value, (select {stat.format('value')} from {fx.EVENT_GAPS})), 6) as value,
      round(coalesce(strength, (select {stat.format('strength')} from {fx.EVENT_GAPS})), 6) as strength from {fx.EVENT_GAPS}"""


def _impute(spark, sf, strategy):
    gaps = fx.event_gaps(spark, sf).select("event_id", "value", "strength")
    return _rounded(prep.fill(gaps, prep.fit_imputer(gaps, ["value", "strength"], strategy)))


@query("g2_impute_median", _impute_sql("quantile_cont({0}, 0.5)"))
def impute_median(spark, sf):
    return _impute(spark, sf, "median")


@query("g2_impute_mean", _impute_sql("avg({0})"))
def impute_mean(spark, sf):
    return _impute(spark, sf, "mean")


@query("g2_impute_most_frequent", f"""
with g as (select * from {fx.EVENT_GAPS})
select event_id, coalesce(value, (select value from g where value is not null group by value order by count(*) desc, value limit 1)) as value,
       coalesce(strength, (select strength from g where strength is not null group by strength order by count(*) desc, strength limit 1)) as strength from g""")
def impute_most_frequent(spark, sf):
    return _impute(spark, sf, "most_frequent")


@query("g3_knn_impute", f"""
with g as (select event_id, value, hour(ts)::double as h, user_id::double as u from {fx.EVENT_GAPS}),
n as (select q.event_id, d.value, row_number() over (partition by q.event_id
        order by (q.h - d.h) * (q.h - d.h) + (q.u - d.u) * (q.u - d.u), cast(d.event_id as varchar)) as r
      from g q, g d where q.value is null and d.value is not null),
f as (select event_id, avg(value) as value from n where r <= 5 group by event_id)
select event_id, round(coalesce(g.value, f.value), 6) as value from g left join f using (event_id)""")
def impute_knn(spark, sf):
    gaps = fx.event_gaps(spark, sf).select("event_id", "value", F.hour("ts").alias("h"), "user_id")
    return knn_impute(gaps, gaps, ["value", "h", "user_id"], "event_id").select("event_id", F.round("value", 6).alias("value"))


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                                               F.lit(7.0).alias("flat"))


_COLS = ["l_quantity", "l_extendedprice", "flat"]


def _scaled(spark, sf, kind, **options):
    lines = _lines(spark, sf)
    return _rounded(prep.scale(lines, prep.fit_scaler(lines, _COLS, kind, options)))



@query("g4_robust_scale", """
with s as (select quantile_cont(l_quantity, 0.5) as qm, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) as qr,
  quantile_cont(l_extendedprice, 0.5) as em, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) as er from lineitem)
select l_orderkey, l_linenumber, l_partkey, round((l_quantity - qm) / qr, 6) as l_quantity, round((l_extendedprice - em) / er, 6) as l_extendedprice,
       0.0::double as flat from lineitem, s""")
def robust_scale(spark, sf):
    return _scaled(spark, sf, "robust")


@query("g5_standard_scale", """
with s as (select avg(l_quantity) as qm, stddev_pop(l_quantity) as qr, avg(l_extendedprice) as em, stddev_pop(l_extendedprice) as er from lineitem)
select l_orderkey, l_linenumber, l_partkey, round((l_quantity - qm) / qr, 6) as l_quantity, round((l_extendedprice - em) / er, 6) as l_extendedprice,
       0.0::double as flat from lineitem, s""")
def standard_scale(spark, sf):
    return _scaled(spark, sf, "standard")


@query("g6_minmax_scale", """
with s as (select min(l_quantity) as qm, max(l_quantity) - min(l_quantity) as qr, min(l_extendedprice) as em,
                  max(l_extendedprice) - min(l_extendedprice) as er from lineitem)
select l_orderkey, l_linenumber, l_partkey, round(-1 + 2 * (l_quantity - qm) / qr, 6) as l_quantity,
       round(-1 + 2 * (l_extendedprice - em) / er, 6) as l_extendedprice, -1.0::double as flat from lineitem, s""")
def minmax_scale(spark, sf):
    return _scaled(spark, sf, "minmax", feature_range=(-1.0, 1.0))


@query("g8_impute_cat", f"""
with g as (select * from {fx.ORDER_GAPS})
select o_orderkey, coalesce(o_orderstatus, (select o_orderstatus from g where o_orderstatus is not null group by 1 order by count(*) desc, 1 limit 1)) as o_orderstatus,
       coalesce(o_orderstatus, 'none') as filled from g""")
def impute_category(spark, sf):
    gaps = fx.order_gaps(spark, sf).select("o_orderkey", "o_orderstatus", F.col("o_orderstatus").alias("filled"))
    fills = prep.fit_imputer(gaps, ["o_orderstatus"], "most_frequent") | prep.fit_imputer(gaps, ["filled"], "constant", "none")
    return prep.fill(gaps, fills)


@query("g9_onehot", """
select o_orderkey, (o_orderstatus = 'F')::int::double as "o_orderstatus_F", (o_orderstatus = 'O')::int::double as "o_orderstatus_O" from orders""")
def onehot(spark, sf):
    orders = table(spark, sf, "orders")
    cats = prep.fit_categories(orders.where(F.col("o_orderstatus") != "P"), ["o_orderstatus"])[0]["o_orderstatus"]
    return orders.select("o_orderkey", *prep.onehot_columns("o_orderstatus", cats, "ignore"))


@query("g10_ordinal", """
select o_orderkey, case o_orderstatus when 'F' then 0 when 'O' then 1 else -1 end::double as o_orderstatus from orders""")
def ordinal(spark, sf):
    orders = table(spark, sf, "orders")
    cats = prep.fit_categories(orders.where(F.col("o_orderstatus") != "P"), ["o_orderstatus"])[0]["o_orderstatus"]
    return orders.select("o_orderkey", prep.ordinal_column("o_orderstatus", cats, "use_encoded_value", -1))


@query("g10_ordinal_wide", """
select c_custkey, coalesce(place, -1)::double as c_name from customer left join (
  select c_name as name, row_number() over (order by c_name) - 1 as place from (select distinct c_name from customer where c_custkey % 9 <> 0)) on c_name = name""")
def ordinal_wide(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", "c_name")
    names = prep.category_table(people.where(F.col("c_custkey") % 9 != 0), "c_name")
    return prep.ordinal_by_table(people, "c_name", names, "use_encoded_value", -1)


@query("g9_onehot_wide", """
with t as (select p_name as name, row_number() over (order by p_name) - 1 as place, count(*) over () as size
  from (select distinct p_name from part where p_partkey % 9 <> 0))
select p_partkey, (select max(size) from t)::int as size, coalesce(place, -1)::int as place from part left join t on p_name = name""")
def onehot_wide(spark, sf):
    """The sparse vector as its length and the place of its one (-1: none)."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    names = prep.category_table(parts.where(F.col("p_partkey") % 9 != 0), "p_name")
    coded = prep.onehot_by_table(parts, "p_name", names, "hot", "ignore")
    inner = F.from_json(F.to_json(F.struct("hot")), "hot struct<size int, indices array<int>>")
    return coded.select("p_partkey", inner["hot"]["size"].alias("size"), F.coalesce(F.get(inner["hot"]["indices"], F.lit(0)), F.lit(-1)).alias("place"))


_PREP = {"numerical": {"imputer": {"type": "simple", "strategy": "median"}, "scaler": {"type": "robust"}},
         "categorical": {"imputer": {"strategy": "most_frequent"}, "encoder": {"type": "onehot", "handle_unknown": "ignore"}}}


@query("g11_assemble", f"""
with g as (select o_orderkey, o_totalprice, o_custkey, o_orderstatus from {fx.ORDER_GAPS}),
s as (select quantile_cont(o_custkey, 0.5) as m, quantile_cont(o_custkey, 0.75) - quantile_cont(o_custkey, 0.25) as r from g),
d as (select o_orderstatus as mode from g where o_orderstatus is not null group by 1 order by count(*) desc, 1 limit 1),
f as (select o_orderkey, round((o_custkey - m) / r, 6) as c, coalesce(o_orderstatus, mode) as st, o_totalprice from g, s, d)
select o_orderkey, c as "numerical__o_custkey", (st = 'F')::int::double as "categorical__o_orderstatus_F",
       (st = 'O')::int::double as "categorical__o_orderstatus_O", (st = 'P')::int::double as "categorical__o_orderstatus_P", o_totalprice from f""")
def assemble(spark, sf):
    gaps = fx.order_gaps(spark, sf)
    model = TabularPreprocessor(numerical=["o_custkey"], categorical=["o_orderstatus"], config=_PREP).fit(gaps)
    return _rounded(model.flat(gaps, ["o_orderkey"], "o_totalprice"))


@query("g12_fit_train_only", f"""
with t as (select * from {fx.SPLIT_ORDERS}),
s as (select quantile_cont(o_totalprice, 0.5) as m, quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) as sr from t where split = 'train')
select split, o_orderkey, round((o_totalprice - m) / sr, 6) as "numerical__o_totalprice", o_custkey::double as o_custkey from t, s""")
def fit_train_only(spark, sf):
    parts = exact_split(table(spark, sf, "orders"), "o_orderkey")
    model = TabularPreprocessor(numerical=["o_totalprice"], config=_PREP).fit(parts.where(F.col("split") == "train"))
    return _rounded(model.flat(parts, ["split", "o_orderkey"], "o_custkey"))


@query("b10_xy_gate", f"""
select split, count(*) as n_rows, count(*) filter (where o_orderpriority = '5-LOW') as missing_cells, 0::bigint as missing_target
from {fx.SPLIT_ORDERS} group by split""")
def xy_gate(spark, sf):
    parts = exact_split(fx.order_gaps(spark, sf), "o_orderkey")
    report = prep.require_columns(parts, ["o_custkey", "o_orderstatus"], "o_totalprice")
    prep.check_features(report)
    return report


@query("a11_finite_gate", """
select count(*) as n_rows, 3::bigint as n_columns, count(*) filter (where l_discount = 0) as bad_cells from lineitem""")
def finite_gate(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_quantity", F.try_divide(F.lit(1.0), F.col("l_discount")).alias("inverse"), "l_extendedprice")
    path = scratch_path(spark, "matrix")
    prep.write_matrix(lines, ["l_quantity", "inverse"], "l_extendedprice", path)
    return prep.finite_report(spark.read.parquet(path), ["l_quantity", "inverse", "l_extendedprice"])


@query("g21_knn_roundtrip", """
select event_id, 2 + (select count(distinct event_type) from events where event_type <> 'view') as n_features, 0.0::double as gap,
       (event_type = 'view')::int as n_unknown from events""")
def knn_roundtrip(spark, sf):
    """Nearest-neighbour, robust and one-hot preparation, fitted without one category, saved, reloaded and compared."""
    gaps = fx.event_gaps(spark, sf).select("event_id", "value", F.hour("ts").cast("double").alias("h"))
    gaps = gaps.join(table(spark, sf, "events").select("event_id", "event_type"), "event_id")
    config = {"numerical": {"imputer": {"type": "knn", "n_neighbors": 5, "donor_key": "event_id"}, "scaler": {"type": "robust"}},
              "categorical": {"imputer": {"strategy": "most_frequent"}, "encoder": {"type": "onehot", "handle_unknown": "ignore"}}}
    fitted = prep.TabularPreprocessor(numerical=["value", "h"], categorical=["event_type"], config=config).fit(
        gaps.where(F.col("event_type") != "view"))
    path = scratch_path(spark, "prep")
    fitted.save(path)
    back = prep.TabularPreprocessorModel.load(path)
    names = back.feature_names()
    first, second = fitted.flat(gaps, ["event_id"]), back.flat(gaps, ["event_id"])
    both = first.join(second.toDF("event_id", *[f"b{i}" for i in range(len(names))]), "event_id")
    gap = F.greatest(*[F.abs(F.col(f"`{c}`") - F.col(f"b{i}")) for i, c in enumerate(names)])
    known = F.lit(0)
    for c in names[2:]:
        known = known + F.col(f"`{c}`").cast("int")
    return both.select("event_id", F.lit(len(names)).cast("long").alias("n_features"), gap.alias("gap"), (1 - known).alias("n_unknown"))


@query("g11_wide_roundtrip", """
with names as (select c_name, row_number() over (order by c_name) - 1 as place from (select distinct c_name from customer where c_custkey % 9 <> 0))
select c_custkey, (select count(*) from names) + 1 + (select count(distinct c_mktsegment) from customer where c_custkey % 9 <> 0) as n_features,
       1 + place as hot, round(c_acctbal, 6) as balance from customer left join names using (c_name)""")
def wide_roundtrip(spark, sf):
    """Preparation over a column with a category for almost every row, kept as a joined table: fitted, saved, reloaded and applied."""
    people = table(spark, sf, "customer")
    config = {"numerical": {"scaler": {"type": "none"}},
              "categorical": {"encoder": {"type": "onehot", "handle_unknown": "ignore", "max_columns": 50}}}
    fitted = TabularPreprocessor(numerical=["c_acctbal"], categorical=["c_name", "c_mktsegment"], config=config).fit(
        people.where(F.col("c_custkey") % 9 != 0))
    path = scratch_path(spark, "wide")
    fitted.save(path)
    vector = F.unwrap_udt("features")
    size = sum(fitted.fitted()["wide"].values())
    made = prep.TabularPreprocessorModel.load(path).transform(people).select("c_custkey", vector.alias("v"))
    indices = F.filter("v.indices", lambda i: (i >= 1) & (i <= size))
    return made.select("c_custkey", F.col("v.size").cast("long").alias("n_features"), F.get(indices, 0).cast("long").alias("hot"),
                       F.round(F.when(F.get("v.indices", 0) == 0, F.get("v.values", 0)).otherwise(0.0), 6).alias("balance"))
