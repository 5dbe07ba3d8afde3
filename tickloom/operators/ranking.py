"""Newest rows per symbol and overall top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Up to this many rows per key the optimizer limits a window before the shuffle by itself.
LIMITED_BEFORE_SHUFFLE = 1000
#: seconds of the stretches that a larger limit is narrowed down by
STRETCHES = (86_400, 600, 1)
BEFORE_ALL_TIME = -(2**62)


def newest(df: DataFrame, n: int, time: str, ties: Sequence[Column] = (), key: str = "symbol") -> DataFrame:
    """The latest ``n`` rows of every key.

    A small limit also runs before the shuffle, so a key sends at most ``n`` rows per task. For a
    large one, counts per key and stretch of time say from where on all rows belong to it; only rows of the
    stretch it ends in are ranked, after that has been cut down to a second in the same way. So neither the
    older rows nor the newer ones of a hot key are gathered in a task. The rows are read several times then:
    give a stored table.
    """
    if n <= LIMITED_BEFORE_SHUFFLE:
        return _first(df, n, [key], time, ties)
    columns = df.columns
    # a struct is never NULL, so rows with a NULL key find their own counts in the join
    rows = df.withColumns({"_key": F.struct(key), "_left": F.lit(n).cast("long")})
    parts = []
    for seconds in STRETCHES:
        at = F.floor(F.unix_micros(time) / (seconds * 1_000_000))
        rows = rows.withColumn("_stretch", F.coalesce(at, F.lit(BEFORE_ALL_TIME)))
        newer = Window.partitionBy("_key").orderBy(F.desc("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
        counts = rows.groupBy("_key", "_stretch").agg(F.count("*").alias("_n"), F.max("_left").alias("_limit"))
        counts = counts.withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        # where a key has fewer rows than wanted, all are newer
        ends = counts.where((F.col("_newer") < F.col("_limit")) & (F.col("_newer") + F.col("_n") >= F.col("_limit")))
        ends = ends.select("_key", F.col("_stretch").alias("_end"), (F.col("_limit") - F.col("_newer")).alias("_rest"))
        marked = rows.join(ends, "_key", "left")
        parts.append(marked.where(F.col("_end").isNull() | (F.col("_stretch") > F.col("_end"))).select(*columns))
        rows = marked.where(F.col("_stretch") == F.col("_end")).withColumn("_left", F.col("_rest")).drop("_end", "_rest")
    by_time = Window.partitionBy("_key").orderBy(F.desc(time), *ties)
    last = rows.withColumn("_nth", F.row_number().over(by_time)).where(F.col("_nth") <= F.col("_left")).select(*columns)
    for part in parts:
        last = last.unionByName(part)
    return last


def _first(df: DataFrame, n: int, keys: list[str], time: str, ties: Sequence[Column]) -> DataFrame:
    by_time = Window.partitionBy(*keys).orderBy(F.desc(time), *ties)
    return df.withColumn("_nth", F.row_number().over(by_time)).where(F.col("_nth") <= n).drop("_nth")


def newest_with_ties(df: DataFrame, time: str = "window_start", key: str = "symbol") -> DataFrame:
    """All rows that carry the latest time of their key."""
    by_time = Window.partitionBy(key).orderBy(F.desc(time))
    return df.withColumn("_nth", F.rank().over(by_time)).where(F.col("_nth") == 1).drop("_nth")


def newest_by_join(df: DataFrame, time: str = "window_start", key: str = "symbol") -> DataFrame:
    """``newest_with_ties`` as a join with the latest time per key, for frames where that small
    side is already stored; the planner chooses the join from its size."""
    return df.join(latest_times(df, time, key), [key, time])


def latest_times(df: DataFrame, time: str = "window_start", key: str = "symbol") -> DataFrame:
    return df.groupBy(key).agg(F.max(time).alias(time))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of a total order: a top-n per task and a merge, no full sort."""
    return df.orderBy(*order).limit(n)
