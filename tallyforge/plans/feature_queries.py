from pyspark.sql import functions as F

from tallyforge.operators import clean, features
from tallyforge.plans.registry import half_up_sql, query, table


SESSIONS = features.SessionNames("moving_avg_7d_calories", "prev_session_calories", "calorie_diff_from_prev", "calorie_burn_rank")
SUMMARY = features.SummaryNames("total_workouts", "heavy_workout_days", "light_workout_days", "avg_weight")


def _sessions(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return features.session_features(events, "user_id", "ts", "value", "event_id", names=SESSIONS)


@query("d1_user_summary", f"""
select o_custkey as user_id, count(*) as total_workouts,
       count(*) filter (where o_totalprice > 250000) as heavy_workout_days,
       count(*) filter (where o_totalprice <= 250000) as light_workout_days,
       {half_up_sql('avg(o_totalprice)')} as avg_weight
from orders group by o_custkey having count(*) > 10""")
def user_summary(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "user_id")
    return features.entity_summary(orders, "user_id", "o_totalprice", "o_totalprice", heavy_over=250000, names=SUMMARY)


@query("w1_moving_avg", f"""
select event_id, user_id, {half_up_sql('m')} as moving_avg_7d_calories from (
  select event_id, user_id, avg(value) over (partition by user_id order by ts, event_id
       rows between 6 preceding and current row) as m from events)""")
def moving_average(spark, sf):
    return _sessions(spark, sf).select("event_id", "user_id", "moving_avg_7d_calories")


@query("w2_lag", """
select event_id, user_id, lag(value, 1) over (partition by user_id order by ts, event_id) as prev_session_calories
from events""")
def previous_session(spark, sf):
    return _sessions(spark, sf).select("event_id", "user_id", "prev_session_calories")


@query("w3_row_number", """
select event_id, user_id, row_number() over (partition by user_id order by value desc, event_id) as calorie_burn_rank
from events""")
def burn_rank(spark, sf):
    return _sessions(spark, sf).select("event_id", "user_id", "calorie_burn_rank")


@query("w4_diff", """
select event_id, user_id, round(value - lag(value, 1) over (partition by user_id order by ts, event_id), 6)
       as calorie_diff_from_prev from events""")
def session_change(spark, sf):
    return _sessions(spark, sf).select("event_id", "user_id",
                                       F.round("calorie_diff_from_prev", 6).alias("calorie_diff_from_prev"))


@query("w5_top_features", f"""
with w as (
  select user_id, ts as log_date, value as calories_burned, event_id,
    avg(value) over (partition by user_id order by ts, event_id rows between 6 preceding and current row) as m,
    lag(value, 1) over (partition by user_id order by ts, event_id) as prev_session_calories,
    row_number() over (partition by user_id order by value desc, event_id) as calorie_burn_rank
  from events)
select user_id, log_date, calories_burned, {half_up_sql('m')} as moving_avg_7d_calories, prev_session_calories, calorie_burn_rank,
       round(calories_burned - prev_session_calories, 6) as calorie_diff_from_prev
from w where calorie_burn_rank <= 3""")
def top_features(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    top = features.top_sessions(events, "user_id", "ts", "value", "event_id", names=SESSIONS)
    return top.select("user_id", F.col("ts").alias("log_date"), F.col("value").alias("calories_burned"),
                      "moving_avg_7d_calories", "prev_session_calories", "calorie_burn_rank",
                      F.round("calorie_diff_from_prev", 6).alias("calorie_diff_from_prev"))


_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value"


def _dedup(spark, sf, keep):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return clean.drop_duplicates_by_key(events, ["user_id", "event_type"], sort="ts", keep=keep, tiebreak=["event_id"])


@query("c1_dedup_last", f"""
select {_EVENT_COLUMNS} from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""")
def dedup_last(spark, sf):
    return _dedup(spark, sf, "last")


@query("c1_dedup_first", f"""
select {_EVENT_COLUMNS} from events
qualify row_number() over (partition by user_id, event_type order by ts, event_id) = 1""")
def dedup_first(spark, sf):
    return _dedup(spark, sf, "first")


@query("c1_dedup_none", """
select o_orderkey, o_custkey, o_orderdate from orders
qualify count(*) over (partition by o_custkey, year(o_orderdate), month(o_orderdate)) = 1""")
def dedup_none(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                               F.trunc("o_orderdate", "month").alias("month"))
    return clean.drop_duplicates_by_key(orders, ["o_custkey", "month"], keep=False).drop("month")


@query("c2_dropped_duplicates", """
select count(*) as n_rows, count(distinct user_id) as n_kept, count(*) - count(distinct user_id) as n_dropped
from events""")
def dropped_duplicates(spark, sf):
    return clean.duplicate_report(table(spark, sf, "events"), ["user_id"])
