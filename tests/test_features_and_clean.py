import datetime as dt
import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import round_half_up, snake_name
from tallyforge.operators import clean, features


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plain_features(df, entity, when, value, tiebreak, rows=7):
    """The same columns by one window over each whole entity."""
    by_time = Window.partitionBy(entity).orderBy(when, tiebreak)
    by_value = Window.partitionBy(entity).orderBy(F.col(value).desc_nulls_first(), tiebreak)
    previous = F.lag(value, 1).over(by_time)
    return df.select("*", round_half_up(F.avg(value).over(by_time.rowsBetween(-(rows - 1), 0)), 2).alias("moving_avg"),
                     previous.alias("previous"), (F.col(value) - previous).alias("change"),
                     F.row_number().over(by_value).cast("long").alias("value_rank"))


def texts(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("chunk_rows", [5, 20, 100_000])
def test_chunks_give_the_features_of_whole_entities(spark, sf, chunk_rows):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "ts", "value")
    # one user holds a third of the rows, with repeated times and values
    events = events.withColumn("user_id", F.when(F.col("value") < 170, 7).otherwise(F.col("user_id")))
    events = events.withColumn("ts", F.date_trunc("hour", "ts")).withColumn("value", F.round("value", -1))
    args = (events, "user_id", "ts", "value", "event_id")
    plain, split = plain_features(*args), features.session_features(*args, chunk_rows=chunk_rows)
    assert plain.columns == split.columns
    assert texts(plain) == texts(split)
    assert texts(plain.where("value_rank <= 3")) == texts(features.top_sessions(*args, chunk_rows=chunk_rows))


@pytest.mark.parametrize("kind,values", [
    ("double", [9.0, 1.0, None, float("nan"), float("inf"), 5.0, float("-inf"), None, 5.0, -0.0, 13.0, 2.0]),
    ("bigint", [2**53, 2**53 + 1, 2**53 + 2, None, 2**62, 2**62 + 1, 3, 3, 3, 3, 3, 3]),
    ("double", [1.5] * 12)])
def test_odd_sessions_keep_their_rows_and_ranks(spark, kind, values):
    users = [1, None, 1, 1, None, 1, 1, 1, None, 1, 1, 1]
    rows_ = [(i, u, None if i % 4 == 0 else i // 2, v) for i, (u, v) in enumerate(zip(users, values))]
    df = spark.createDataFrame(rows_, f"id long, u int, t int, v {kind}").repartition(3)
    plain = plain_features(df, "u", "t", "v", "id", 3)
    for chunk_rows in (3, 4, 100):
        assert texts(features.session_features(df, "u", "t", "v", "id", 3, chunk_rows)) == texts(plain)


def test_top_sessions_rank_nulls_first_like_the_view(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, None, 2), (1, 3, 9.0, 3), (1, 4, 1.0, 4)], "u int, t int, v double, id int")
    top = features.top_sessions(df, "u", "t", "v", "id")
    assert [r["id"] for r in top.orderBy("value_rank").collect()] == [2, 3, 1]


def test_half_is_rounded_up_despite_binary_noise(spark):
    values = [(1.005, 1.01), (2.675, 2.68), (169809.565, 169809.57), (-1.005, -1.01), (0.0, 0.0), ((0.1 + 0.2) / 2 * 10, 1.5)]
    df = spark.createDataFrame(values, "x double, want double").select(round_half_up(F.col("x")).alias("x"), "want")
    for r in df.collect():
        assert r["x"] == r["want"]


@pytest.mark.parametrize("keep", ["last", "first", False])
def test_dedup_equals_pandas(spark, keep):
    data = [(i, i % 7, None if i % 5 == 0 else (i * 37) % 11, i) for i in range(60)]
    df = spark.createDataFrame(data, "id int, k int, s int, t int")
    got = clean.drop_duplicates_by_key(df, "k", "s", keep, ["t"])
    pdf = df.toPandas().sort_values(["s", "t"], na_position="last", kind="stable").drop_duplicates("k", keep=keep)
    assert sorted(r["id"] for r in got.collect()) == sorted(pdf["id"])


def test_dedup_with_an_unknown_sort_column_still_works(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    assert rows(clean.drop_duplicates_by_key(df, ["k"], "nope", "last")) == [(1, 2)]
    with pytest.raises(ValueError):
        clean.drop_duplicates_by_key(df, ["k"], keep="middle")


def test_names_text_and_hashes(spark):
    assert snake_name(" Nhịp Tim (bpm) ") == "nhip_tim_bpm"
    df = spark.createDataFrame([(" a\t", 1), ("\n", 2), (None, 3)], "s string, n int")
    assert rows(clean.trim_strings(df).where("n < 3")) == [("", 2), ("a", 1)]
    assert [r["s"] for r in clean.blank_to_null(df).orderBy("n").collect()] == [" a\t", None, None]
    hashed = clean.hash_columns(df, ["s", "absent"]).orderBy("n").collect()
    assert hashed[0]["s"] == hashlib.sha256(b" a\t").hexdigest() and hashed[2]["s"] is None


def test_types(spark):
    df = spark.createDataFrame([("2024-01-02", "7"), ("bad", "8")], "d string, n string")
    got = clean.apply_types(df, {"d": "datetime64[ns]", "n": "bigint", "gone": "double"}).collect()
    assert got[0]["d"] == dt.datetime(2024, 1, 2) and got[1]["d"] is None and got[1]["n"] == 8
    with pytest.raises(Exception):
        clean.apply_types(df, {"d": "bigint"}).collect()


def test_json_keys_are_found(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": 2}'), (3, None)], "id int, j string")
    got = clean.flatten_json(df, "j").orderBy("id").collect()
    assert got[0]["j_a"] == 1 and got[1]["j_a"] == 2 and got[2]["j_a"] is None and got[0]["j_b"]["c"] == "x"


def test_date_columns_are_promoted_by_share(spark):
    df = spark.createDataFrame([("2024-01-01", "x"), ("2024-01-02", "y"), ("no", "z")], "d string, s string")
    assert dict(clean.promote_datetimes(df).dtypes) == {"d": "timestamp_ntz", "s": "string"}


def test_codes_are_no_dates(spark):
    df = spark.createDataFrame([("1234", "01/02/2024", "2024-03-01", "3-4", "2024"), ("5678", "13/02/2024 10:05", None, "5-6", "2025")],
                               "code string, day string, iso string, score string, year string")
    got = clean.promote_datetimes(df, 0.4)
    assert dict(got.dtypes) == {"code": "string", "day": "timestamp_ntz", "iso": "timestamp_ntz", "score": "string", "year": "string"}
    assert [str(r["day"]) for r in got.collect()] == ["2024-01-02 00:00:00", "2024-02-13 10:05:00"]
    typed = clean.apply_types(df.select("day"), {"day": "datetime"})
    assert [str(r["day"]) for r in typed.collect()] == ["2024-01-02 00:00:00", "2024-02-13 10:05:00"]
