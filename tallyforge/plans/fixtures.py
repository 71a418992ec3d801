"""Derived inputs: the test tables hold no nulls, blanks or bad text, so queries derive them from the data.

Every frame has a SQL text that says the same for the twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.plans.registry import table

EVENT_GAPS = """(select event_id, ts, user_id, event_type,
    case when event_type = 'error' then null else value end as value,
    case when event_type = 'click' then value end as strength from events)"""


def event_gaps(spark, sf):
    """Events with a fifth of the values missing, and a second measure that is mostly missing."""
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("strength"))


ORDER_GAPS = """(select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
    case when o_orderpriority = '5-LOW' then null else o_orderstatus end as o_orderstatus from orders)"""


def order_gaps(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("o_orderstatus"))


def blank_documents(spark, sf):
    """Documents with padded text, and blank text for one language."""
    text = F.when(F.col("lang") == "es", F.lit(" \t ")).otherwise(
        F.concat(F.lit(" \t"), F.col("text"), F.lit(" \n")))
    return table(spark, sf, "documents").select("doc_id", text.alias("text"), "lang", "n_chars")


BLANK_DOCUMENTS = """(select doc_id, lang, n_chars,
    case when lang = 'es' then ' ' || chr(9) || ' ' else ' ' || chr(9) || text || ' ' || chr(10) end as text
    from documents)"""


def text_events(spark, sf):
    """Events as a raw text extract, with bad numbers and bad dates."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "signup", F.lit("soon")).otherwise(F.col("ts").cast("string")).alias("ts"),
        F.when(F.col("event_type") == "error", F.lit("x")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("user_id").cast("string").alias("user_id"), "event_type")


TEXT_EVENTS = """(select cast(event_id as varchar) as event_id,
    case when event_type = 'signup' then 'soon' else cast(ts as varchar) end as ts,
    case when event_type = 'error' then 'x' else cast(value as varchar) end as value,
    cast(user_id as varchar) as user_id, event_type from events)"""

SPLIT_ORDERS = """(select *, case when r < n7 then 'train' when r < n7 + (n - n7) // 2 then 'val' else 'test' end as split
    from (select *, row_number() over (order by md5(concat_ws('|', cast(o_orderkey as varchar), '42'))) - 1 as r,
                 count(*) over () as n, cast(floor(count(*) over () * 7 / 10) as bigint) as n7 from orders))"""
