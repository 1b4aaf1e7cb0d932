"""Metric series and timing summaries.

Series are ``(metric, label, ts, value)`` samples.  Rates use
``operators.series.counter_increase``: increase over the trailing range
divided by the range, resets tolerated, extrapolated to the range edges on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.columns import epoch_micros
from vitrine.operators.series import DEFAULT_BUCKET_ROWS, counter_increase, series_bounds


SERIES = ["metric", "label"]


def sample_bounds(samples: DataFrame, bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """What cuts the long series of a samples table into buckets; stored beside it."""
    return series_bounds(samples.withColumn("__t", epoch_micros("ts")), SERIES, "__t", bucket_rows)


def _increase(samples: DataFrame, range_seconds: int, bounds: DataFrame | None, extrapolate: bool) -> DataFrame:
    return counter_increase(samples, SERIES, "ts", "value", range_seconds, bounds=bounds, extrapolate=extrapolate)


def series(samples: DataFrame, metric: str) -> DataFrame:
    """The samples of one metric."""
    return samples.where(F.col("metric") == metric)


def counter_rate(samples: DataFrame, metric: str, range_seconds: int, bounds: DataFrame | None = None, extrapolate: bool = False) -> DataFrame:
    """H3: per-second rate of a counter over the trailing range."""
    inc = _increase(series(samples, metric), range_seconds, bounds, extrapolate)
    return inc.select("metric", "label", "ts", (F.col("increase") / F.lit(float(range_seconds))).alias("rate"),
                      "samples")


def ratio_of_rates(samples: DataFrame, numerator: str, denominator: str, range_seconds: int,
                   scale: float = 1e6, bounds: DataFrame | None = None, extrapolate: bool = False) -> DataFrame:
    """H5 (+C9): ``rate(num) / rate(den) / scale`` for samples of both series
    at the same (label, ts).

    Both increases come from one pass over the two metrics; matching is a
    conditional aggregate on (label, ts) rather than a join.  Only points
    present in both series are kept; a zero denominator gives null.
    """
    both = samples.where(F.col("metric").isin(numerator, denominator))
    inc = _increase(both, range_seconds, bounds, extrapolate)
    m = inc.groupBy("label", "ts").agg(
        F.max(F.when(F.col("metric") == numerator, F.col("increase"))).alias("__num"),
        F.max(F.when(F.col("metric") == denominator, F.col("increase"))).alias("__den"))
    r = float(range_seconds)
    return (m.where(F.col("__num").isNotNull() & F.col("__den").isNotNull())
             .select("label", "ts",
                     (F.try_divide(F.col("__num") / r, F.col("__den") / r) / F.lit(scale)).alias("latency_s")))


def gauge_scaled(samples: DataFrame, metric: str, divisor: float = 1e9, name: str = "memory_gb") -> DataFrame:
    """H6: a gauge divided by a constant (bytes to GB, S15)."""
    return series(samples, metric).select("label", "ts", (F.col("value") / F.lit(divisor)).alias(name))


def last_window(samples: DataFrame, minutes: int = 5, end=None) -> DataFrame:
    """Samples in ``[end - minutes, end]``; ``end`` defaults to the
    newest sample (a scalar subquery), so results are repeatable."""
    end_col = F.lit(end).cast("timestamp_ntz") if end is not None else samples.agg(F.max("ts")).scalar()
    start = end_col - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return samples.where((F.col("ts") >= start) & (F.col("ts") <= end_col)).select("metric", "label", "ts", "value")


def timing_summary(timings: DataFrame) -> DataFrame:
    """Min / mean / max seconds per query."""
    return (timings.groupBy("query")
                   .agg(F.min("seconds").alias("min_s"), F.round(F.avg("seconds"), 6).alias("mean_s"),
                        F.max("seconds").alias("max_s"), F.count(F.lit(1)).alias("iterations"))
                   .orderBy("query"))
