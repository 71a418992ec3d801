"""Per-entity aggregate and session features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import round_half_up
from tallyforge.operators.ranks import numbered

CHUNK_ROWS = 100_000


@dataclass(frozen=True)
class SessionNames:
    """Names of the columns that `session_features` adds."""

    moving: str = "moving_avg"
    previous: str = "previous"
    change: str = "change"
    rank: str = "value_rank"


@dataclass(frozen=True)
class SummaryNames:
    """Names of the columns that `entity_summary` makes."""

    sessions: str = "sessions"
    heavy: str = "heavy_sessions"
    light: str = "light_sessions"
    weight: str = "avg_weight"


def entity_summary(df: DataFrame, entity: str, load: str, weight: str, heavy_over: float = 500,
                   min_sessions: int = 10, names: SummaryNames = SummaryNames()) -> DataFrame:
    """Sessions, heavy and light sessions and mean weight of entities with more than `min_sessions`."""
    return (df.groupBy(entity)
            .agg(F.count(F.lit(1)).alias(names.sessions),
                 F.count_if(F.col(load) > heavy_over).alias(names.heavy),
                 F.count_if(F.col(load) <= heavy_over).alias(names.light),
                 round_half_up(F.avg(weight), 2).alias(names.weight))
            .where(F.col(names.sessions) > min_sessions))


def _timed(df: DataFrame, entity: str, when: str, value: str, tiebreak: str, rows: int, chunk_rows: int,
           names: SessionNames) -> DataFrame:
    """Moving average, previous value and change of each session.

    Rows are numbered in the order of entity and time and cut into chunks of equal size; a chunk's last rows are copied to
    the next one, which may go on with their entity. So no entity, however many sessions it has, fills a task.
    """
    chunk_rows = max(chunk_rows, rows)  # the rows carried over come from one chunk only
    in_time = numbered(df, [F.col(entity).asc(), F.col(when).asc(), F.col(tiebreak).asc()], "__seq")
    chunk = F.floor(F.col("__seq") / chunk_rows)
    carried = F.col("__seq") % chunk_rows >= chunk_rows - (rows - 1)
    spread = in_time.withColumn("__chunk", F.explode(F.when(carried, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))))
    by_time = Window.partitionBy(entity, "__chunk").orderBy("__seq")
    previous = F.lag(value, 1).over(by_time)
    return spread.select(
        "*", round_half_up(F.avg(value).over(by_time.rowsBetween(-(rows - 1), 0)), 2).alias(names.moving),
        previous.alias(names.previous), (F.col(value) - previous).alias(names.change),
    ).where(chunk == F.col("__chunk")).drop("__seq", "__chunk")


def session_features(df: DataFrame, entity: str, when: str, value: str, tiebreak: str, rows: int = 7,
                     chunk_rows: int = CHUNK_ROWS, names: SessionNames = SessionNames()) -> DataFrame:
    """Moving average over `rows` sessions, previous value, change, and rank by value of each session.

    Ranks fall with the value, nulls first, ties by `tiebreak`. Null entities form one group, null times come first; values
    keep their type, so large integers, NaN and infinity rank as Spark orders them.
    """
    timed = _timed(df, entity, when, value, tiebreak, rows, chunk_rows, names)
    placed = numbered(timed, [F.col(entity).asc(), F.col(value).desc_nulls_first(), F.col(tiebreak).asc()], "__place")
    placed = placed.withColumn("__chunk", F.floor(F.col("__place") / chunk_rows))
    # An entity's ranks count from its first place, which is known once per chunk it spans.
    spans = placed.groupBy(F.col(entity).alias("__entity"), F.col("__chunk").alias("__of")).agg(F.min("__place").alias("__first"))
    starts = spans.select("__entity", "__of", F.min("__first").over(Window.partitionBy("__entity")).alias("__start"))
    joined = placed.join(starts, F.col(entity).eqNullSafe(F.col("__entity")) & (F.col("__chunk") == F.col("__of")))
    return joined.withColumn(names.rank, F.col("__place") - F.col("__start") + 1).drop(
        "__place", "__chunk", "__entity", "__of", "__start")


def top_sessions(df: DataFrame, entity: str, when: str, value: str, tiebreak: str, top: int = 3, rows: int = 7,
                 chunk_rows: int = CHUNK_ROWS, names: SessionNames = SessionNames()) -> DataFrame:
    """The session features of each entity's `top` sessions by value; every task passes on at most `top` rows per entity."""
    timed = _timed(df, entity, when, value, tiebreak, rows, chunk_rows, names)
    by_value = Window.partitionBy(entity).orderBy(F.col(value).desc_nulls_first(), tiebreak)
    return timed.withColumn(names.rank, F.row_number().over(by_value)).where(F.col(names.rank) <= top).withColumn(
        names.rank, F.col(names.rank).cast("long"))
