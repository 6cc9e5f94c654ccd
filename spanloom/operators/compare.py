"""Two tables by counts per time window and dimensions, with gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compare_counts(a: DataFrame, b: DataFrame, ts: str, dims: list[str], width: str = "1 hour") -> DataFrame:
    """One row per window and dimensions in either table: window_start, dims, count_a, count_b, diff, gap_seconds.

    gap_seconds is the time since the last window of the same dimensions that either has, less the width; null for
    the first. Rows without a time are left out; null dimensions are equal to each other.
    """
    def counts(t: DataFrame, name: str) -> DataFrame:
        return t.where(F.col(ts).isNotNull()).groupBy(F.window(ts, width).start.alias("window_start"), *dims).agg(F.count("*").alias(name))

    left, right = counts(a, "count_a").alias("l"), counts(b, "count_b").alias("r")
    keys = ["window_start", *dims]
    same = F.lit(True)
    for k in keys:
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    both = left.join(right, same, "full_outer").select(*(F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys), F.coalesce("count_a", F.lit(0)).alias("count_a"), F.coalesce("count_b", F.lit(0)).alias("count_b"))
    last = F.lag("window_start").over(Window.partitionBy(*dims).orderBy("window_start"))
    seconds = F.unix_seconds(F.lit("1970-01-01 00:00:00").cast("timestamp") + F.expr(f"INTERVAL {width}"))
    return both.select("*", (F.col("count_b") - F.col("count_a")).alias("diff"), (F.unix_seconds("window_start") - F.unix_seconds(last) - seconds).alias("gap_seconds"))
