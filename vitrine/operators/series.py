"""Ordered-series operators that stay balanced when one series is huge.

A plain ``Window.partitionBy(series).orderBy(ts)`` sends a whole series to
one task; with one series holding a third of all rows that task would hold a
third of the data.  These operators partition by ``(series, bucket)`` where
the bucket is a monotone range of the order key, and carry what crosses a
bucket boundary through a small per-bucket table:

* ``running_sum``      - prefix sum = in-bucket running sum + sum of earlier
                         buckets (the per-bucket totals table has one row per
                         bucket, not per sample);
* ``counter_increase`` - monitoring-style counter increase over a trailing
                         range, with counter resets, in linear time.

Time buckets hold about equally many rows (``series_bounds``): their bounds
are quantiles of each series, so a burst of samples is cut as finely as it is
dense.  A series has at most ``GRID`` buckets.  Bounds depend on the samples
alone, so a stored table of samples keeps them beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.columns import epoch_micros

_MICROS = 1_000_000

# Target number of rows per (series, bucket) slice, and the most buckets that
# a series is cut into (a series of more than GRID times the target gets
# proportionally larger buckets).
DEFAULT_BUCKET_ROWS = 1 << 20
GRID = 1024


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[str], values: dict[str, Column],
                bucket: Column) -> DataFrame:
    """Cumulative sums per ``partition`` in ``order``: ``{out: value}``.

    ``bucket`` must be non-decreasing along ``order`` (e.g. ``floor(id / B)``);
    a partition's rows are processed bucket by bucket in parallel.
    """
    names = list(values)
    d = df.withColumn("__b", bucket)
    for i, n in enumerate(names):
        d = d.withColumn(f"__v{i}", values[n])
    w_in = (Window.partitionBy(*partition, "__b").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d
    for i, _ in enumerate(names):
        local = local.withColumn(f"__l{i}", F.sum(f"__v{i}").over(w_in))
    totals = d.groupBy(*partition, "__b").agg(*[F.sum(f"__v{i}").alias(f"__t{i}") for i in range(len(names))])
    w_b = Window.partitionBy(*partition).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*partition, "__b", *[F.coalesce(F.sum(f"__t{i}").over(w_b), F.lit(0)).alias(f"__o{i}")
                                                 for i in range(len(names))])
    out = local.join(offsets, [*partition, "__b"])
    for i, n in enumerate(names):
        out = out.withColumn(n, F.col(f"__l{i}") + F.col(f"__o{i}"))
    return out.drop("__b", *[f"__{k}{i}" for k in "vlo" for i in range(len(names))])


def series_bounds(points: DataFrame, series: Sequence[str], at: str, target_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``(series, bounds)``: of each series of more than ``target_rows`` rows,
    the positions that cut it into slices of about that many.

    ``series`` comes back as one struct column.  Rows are counted first, so
    quantiles (combined map-side) are only taken of the series that need them;
    the result has at most one row per ``target_rows`` rows.
    """
    keyed = points.select(F.struct(*series).alias("series"), F.col(at).alias("__at"))
    long = keyed.groupBy("series").agg(F.count("__at").alias("__rows")).where(F.col("__rows") > target_rows)
    grid = F.array(*[F.lit(k / GRID) for k in range(1, GRID)])
    per = keyed.join(long, "series", "left_semi").groupBy("series").agg(F.count("__at").alias("__rows"), F.percentile_approx("__at", grid, 10 * GRID).alias("__q"))
    parts = F.least(F.lit(GRID), F.ceil(F.col("__rows") / F.lit(target_rows))).cast("int")
    picked = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at("__q", (i * GRID / parts).cast("int")))
    return per.select("series", F.array_sort(F.array_distinct(picked)).alias("bounds"))


_STRIDE = 64


def bucket_of(bounds: Column, place: Column) -> Column:
    """Number of ``bounds`` (in order, null: none) at or before ``place``: a
    look at every ``_STRIDE``-th of them, then at those of one stride."""
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.size(bounds) / F.lit(_STRIDE)))), lambda i: F.get(bounds, (i * _STRIDE - 1).cast("int")))
    whole = F.size(F.filter(steps, lambda b: b <= place)) * _STRIDE
    return F.coalesce(F.when(bounds.isNotNull(), whole + F.size(F.filter(F.slice(bounds, whole + 1, F.lit(_STRIDE)), lambda b: b <= place))), F.lit(0))


def with_buckets(df: DataFrame, points: DataFrame, series: Sequence[str], at: str, places: dict[str, Column],
                 target_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``df`` with a bucket number for each of ``places`` (name -> position),
    by the bounds of ``points.at`` (``series_bounds``).  Equal positions share
    a bucket."""
    bounds = series_bounds(points, series, at, target_rows).withColumnsRenamed({"series": "__s", "bounds": "__bounds"})
    out = df.join(bounds, F.struct(*[df[c] for c in series]) == F.col("__s"), "left")
    for name, place in places.items():
        out = out.withColumn(name, bucket_of(F.col("__bounds"), place))
    return out.drop("__bounds", "__s")


def _reset_delta(v: Column, prev: Column) -> Column:
    """Counter delta; a drop is a reset, so the new value is the increase."""
    return F.when(prev.isNull(), F.lit(0.0)).when(v < prev, v.cast("double")).otherwise((v - prev).cast("double"))


def counter_increase(samples: DataFrame, series: Sequence[str], ts: str, value: str, range_seconds: int,
                     bucket_rows: int = DEFAULT_BUCKET_ROWS, bounds: DataFrame | None = None, extrapolate: bool = False) -> DataFrame:
    """Increase of a counter over the trailing range ``(t - range, t]`` at
    every sample ``t`` (H3), from raw samples.

    Deltas between consecutive samples treat a drop as a reset
    (``delta = v`` when ``v < prev``).  The delta of the first sample in the
    range is left out, because its earlier sample lies before the range; a
    range with fewer than two samples yields no row.  A series has one value
    per instant: of several samples at one instant the largest value counts (a
    counter that was read twice), and they give one row.  Samples without time
    or value do not count.

    With ``extrapolate`` the increase is carried on to the start of the range,
    as a metrics server does: as far as the range begins before its first
    sample, at most to where the counter would have been zero, but only by
    half of the mean gap between samples if the range begins more than 1.1
    gaps earlier.  (The range ends with a sample, so nothing is added there.)

    Linear in the number of samples, whatever the range holds.  Each sample
    also stands as a probe at ``t - range``.  Samples and probes are dealt by
    (series, bucket) and sorted once; that order gives the value before a
    sample, running sums of deltas, and the first sample after a probe.  What
    crosses a bucket comes from a table with a row per bucket.  A sample and
    its probe then meet by (series, t).  ``bounds`` (``series_bounds``) may be
    given by whoever stores the samples; buckets end at the bounds and at the
    bounds less the range, so neither samples nor probes crowd one.

    Returns ``series..., ts, increase, samples``.
    """
    back = int(range_seconds) * _MICROS
    key = F.struct(*[F.col(c) for c in series]).alias("__s")  # equal to itself with nulls inside, unlike its parts
    one = (samples.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).groupBy(key, F.col(ts).alias("__ts")).agg(F.max(value).alias("__v"))
           .withColumn("__t", epoch_micros("__ts")))
    if bounds is None:
        bounds = series_bounds(samples.withColumn("__t", epoch_micros(ts)), series, "__t", bucket_rows)
    cut = F.array_sort(F.array_union("bounds", F.transform("bounds", lambda b: b - back)))
    one = one.join(bounds.select(F.col("series").alias("__of"), cut.alias("__cut")), F.col("__s") == F.col("__of"), "left")
    row = lambda kind, at, v: F.struct(F.lit(kind).alias("__kind"), at.alias("__at"), bucket_of(F.col("__cut"), at).alias("__b"), v.alias("__v"))
    # 0: a sample, 1: its probe, which stands after a sample at the same instant.
    rows = one.select("__s", "__ts", F.inline(F.array(row(0, F.col("__t"), F.col("__v")), row(1, F.col("__t") - back, F.lit(None).cast(one.schema["__v"].dataType)))))

    w = Window.partitionBy("__s", "__b").orderBy("__at", "__kind")
    sample, upto = F.col("__kind") == 0, w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = (rows.withColumn("__d", F.when(sample, _reset_delta(F.col("__v"), before)).otherwise(F.lit(0.0)))
             .withColumn("__one", sample.cast("bigint"))
             .withColumns({"__c": F.sum("__d").over(upto), "__n": F.sum("__one").over(upto)})
             .withColumn("__own", F.when(sample, F.struct("__c", "__n", "__at", "__v")))
             .withColumn("__next", F.expr("lead(__own, 1) IGNORE NULLS OVER (PARTITION BY __s, __b ORDER BY __at, __kind)")))

    at = F.when(sample, F.col("__at"))
    per = d.groupBy("__s", "__b").agg(F.min(at).alias("__at"), F.min_by("__v", at).alias("__first"), F.max_by("__v", at).alias("__last"),
                                      F.sum("__d").alias("__d"), F.sum("__one").alias("__n"))
    wb = Window.partitionBy("__s").orderBy("__b")
    earlier = wb.rowsBetween(Window.unboundedPreceding, -1)
    crossing = F.when(F.col("__n") > 0, _reset_delta(F.col("__first"), F.last("__last", ignorenulls=True).over(earlier))).otherwise(F.lit(0.0))
    per = (per.withColumn("__x", crossing).withColumn("__dx", F.col("__d") + F.col("__x"))
              .withColumns({"__c0": F.coalesce(F.sum("__dx").over(earlier), F.lit(0.0)) + F.col("__x"), "__n0": F.coalesce(F.sum("__n").over(earlier), F.lit(0))})
              .withColumn("__f", F.when(F.col("__n") > 0, F.struct(F.col("__c0").alias("__c"), (F.col("__n0") + 1).alias("__n"), "__at", F.col("__first").alias("__v"))))
              .select(F.col("__s").alias("__ps"), F.col("__b").alias("__pb"), "__c0", "__n0",
                      F.expr("lead(__f, 1) IGNORE NULLS OVER (PARTITION BY __s ORDER BY __b)").alias("__after")))
    d = d.join(per, (F.col("__s") == F.col("__ps")) & (F.col("__b") == F.col("__pb")))
    near = F.col("__next").isNotNull()  # else the first sample of a later bucket
    pick = lambda f, base: F.when(~sample, F.when(near, F.col(f"__next.{f}") + F.col(base) if base else F.col(f"__next.{f}")).otherwise(F.col(f"__after.{f}")))
    wanted = {"__c": "__c0", "__n": "__n0"} | ({"__at": None, "__v": None} if extrapolate else {})
    out = d.groupBy("__s", "__ts").agg(
        F.max(F.when(sample, F.col("__c") + F.col("__c0"))).alias("__c"), F.max(F.when(sample, F.col("__n") + F.col("__n0"))).alias("__n"), F.max(at).alias("__t"),
        *[F.max(pick(f, base)).alias(f"__first{f}") for f, base in wanted.items()])
    increase, n = F.col("__c") - F.col("__first__c"), F.col("__n") - F.col("__first__n") + 1
    if extrapolate:
        sampled = (F.col("__t") - F.col("__first__at")).cast("double")
        gap = sampled / (n - 1)
        lead = (F.col("__first__at") - (F.col("__t") - back)).cast("double")
        zero = F.when((increase > 0) & (F.col("__first__v") >= 0), sampled * F.col("__first__v") / increase)
        lead = F.least(lead, zero)  # null: no limit
        increase = increase * (sampled + F.when(lead < gap * 1.1, lead).otherwise(gap / 2)) / sampled
    return out.where(n >= 2).select("__s.*", F.col("__ts").alias(ts), increase.alias("increase"), n.alias("samples"))
