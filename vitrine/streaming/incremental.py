"""Incrementally maintained aggregates and windowed rates with Structured
Streaming (H1, H2, H4).

* H1 / H2 - every micro-batch is aggregated on its own and written as a
  partition ``batch_id=N`` of one Parquet table; readers sum over all of it
  (S4).  ``foreachBatch`` is at-least-once, so a replayed batch replaces its
  own partition (dynamic partition overwrite): the result is exactly-once.
  H2 joins each micro-batch with the catalogue as it is when the batch runs
  (listed anew each time, S10), after counting the batch's events per (day,
  offer) so a hot offer is one row per day by the time it meets the catalogue.
* H4 - sliding event-time windows over raw samples with a watermark in append
  mode, written by the Parquet file sink (exactly-once through its commit
  log).  Samples are folded into panes of a millisecond, of a second, and so on
  up to one slide, each from the panes below it; then a window folds its panes.

Output and checkpoint are keyed by input path, query and output version, not by
the files that happen to be there: a later run, in another process too, goes on
from the checkpoint and handles only what was appended.  Runs use
``availableNow``: everything present is processed, then the query stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.plans import aggregates as agg
from vitrine.session import hadoop_path
from vitrine.sources import fixtures as fx
from vitrine.sources.store import stream_path
from vitrine.sources.tables import path_tag, read_table, table_path

# Version of each stream's output; a change of what it computes gets a new one.
VERSIONS = {"catalog_counts": 2, "offer_events": 2, "counter_rate": 3}
# Files that one micro-batch takes, at most.
MAX_FILES = 1000


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files: int | None = None) -> DataFrame:
    """A table as a file stream, with the schema taken from the table (no
    inference at run).  ``<sf_dir>/<table>.parquet`` may be one file (the
    input folder is streamed, filtered to that name) or a folder of files
    that arrive over time (the folder is streamed)."""
    schema = read_table(spark, sf_dir, table).schema
    path = table_path(sf_dir, table)
    p, fs = hadoop_path(spark, path)
    is_dir = fs.getFileStatus(p).isDirectory()
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files or MAX_FILES)
    return r.parquet(path) if is_dir else r.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def stream_folder(spark: SparkSession, name: str, sf_dir: str) -> str:
    """Output folder of a stream; its checkpoint lies beside it in the same
    folder, so a new store never meets a checkpoint that claims its input was
    already processed."""
    return stream_path(spark, name, sf_dir, VERSIONS[name.split("/")[0]])


def write_delta(delta: DataFrame, path: str, batch_id: int) -> None:
    """Replace the partition of one micro-batch (idempotent on replay)."""
    (delta.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def delta_table(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """All deltas as one table, with ``batch_id``; without rows if no micro-batch has run yet."""
    columns = empty.limit(0).withColumn("batch_id", F.lit(0).cast("bigint"))
    try:
        return spark.read.schema(columns.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return columns


def read_deltas(spark: SparkSession, path: str, keys: list[str], measure: str, empty: DataFrame) -> DataFrame:
    """The maintained aggregate: all deltas, summed by key."""
    return agg.resum(delta_table(spark, path, empty), keys, measure)


def _run(stream: DataFrame, apply: Callable[[DataFrame, int], None], folder: str) -> None:
    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{folder}/_checkpoint")
               .trigger(availableNow=True).start())
    q.awaitTermination()


# ---------------------------------------------------------------- H1
def run_catalog_counts(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> tuple[str, str]:
    """H1: catalogue appends feed per-category and per-(vendor, category)
    counts.  Returns the two delta tables."""
    out = stream_folder(spark, "catalog_counts", sf_dir)
    cat_path, brand_path = f"{out}/category", f"{out}/brand"

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_delta(agg.category_counts(batch), cat_path, batch_id)
            write_delta(agg.brand_counts(batch), brand_path, batch_id)
        finally:
            batch.unpersist()

    _run(fx.offers_from(table_stream(spark, sf_dir, "part", max_files)), apply, out)
    return cat_path, brand_path


def stream_category_counts(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    cat_path, _ = run_catalog_counts(spark, sf_dir, max_files)
    return read_deltas(spark, cat_path, ["category_id"], "offers_cnt", agg.category_counts(fx.offers(spark, sf_dir)))


def stream_brand_counts(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    _, brand_path = run_catalog_counts(spark, sf_dir, max_files)
    return read_deltas(spark, brand_path, ["vendor", "category_id"], "offers_cnt",
                       agg.brand_counts(fx.offers(spark, sf_dir)))


# ---------------------------------------------------------------- H2
def run_offer_events(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> str:
    """H2: event appends joined with the catalogue as it is when they
    arrive, counted per (day, offer, category, vendor)."""
    out = stream_folder(spark, "offer_events", sf_dir)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        offers = fx.offers_from(session.read.parquet(table_path(sf_dir, "part")))   # listed for this batch
        write_delta(agg.offer_events_daily(batch, offers), f"{out}/daily", batch_id)

    _run(fx.raw_events_from(table_stream(spark, sf_dir, "events", max_files)), apply, out)
    return f"{out}/daily"


def stream_offer_events(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    path = run_offer_events(spark, sf_dir, max_files)
    empty = agg.offer_events_daily(fx.raw_events(spark, sf_dir), fx.offers(spark, sf_dir))
    return read_deltas(spark, path, ["event_date", "offer_id", "category_id", "vendor"], "events_cnt", empty)


# ---------------------------------------------------------------- H4
def _delta(now: Column, before: Column) -> Column:
    return F.when(now < before, now).otherwise(now - before)


_PARTS = ["start", "n", "first", "last", "inside"]
# Widths in microseconds that panes below a slide may have, and how many panes one may hold.
SUB_PANES = [1_000, 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000]
FAN_OUT = 4_000


def pane_widths(slide_seconds: int) -> list[int]:
    """Widths in microseconds, up to the slide: each a multiple of the one
    before, and the longest that holds at most ``FAN_OUT`` of it."""
    slide = int(slide_seconds) * 1_000_000
    fitting, widths = [*(w for w in SUB_PANES if w < slide and slide % w == 0), slide], [1]
    while widths[-1] != slide:
        later = [w for w in fitting if w > widths[-1]]
        widths.append(max((w for w in later if w <= FAN_OUT * widths[-1]), default=later[0]))
    return widths[1:]


def instants(samples: DataFrame, series: list[str]) -> DataFrame:
    """Panes of a microsecond: one sample each, the largest of those at the instant."""
    one = samples.groupBy(*series, F.window("ts", "1 microsecond").alias("pane")).agg(F.max("value").alias("v"))
    return one.select(*series, "pane", F.col("pane.start").alias("start"), F.lit(1).cast("bigint").alias("n"),
                      F.col("v").alias("first"), F.col("v").alias("last"), F.lit(0.0).alias("inside"))


def gathered(panes: DataFrame, series: list[str], width: str, slide: str | None = None) -> DataFrame:
    """The panes of each longer pane (or sliding window), in order of time, as an array ``parts``."""
    longer = F.window("pane", width, slide) if slide else F.window("pane", width)
    return panes.groupBy(*series, longer.alias("pane_")).agg(F.sort_array(F.collect_list(F.struct(*_PARTS))).alias("parts"))


def folded(gathered_panes: DataFrame, series: list[str]) -> DataFrame:
    """One pane for each array of panes: increases inside panes plus the deltas
    from one pane's last value to the next one's first, a drop counting as a
    reset in both places."""
    begin = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("sum"), F.lit(0).cast("bigint").alias("n"))
    whole = F.aggregate("parts", begin, lambda a, p: F.struct(
        p["last"].alias("last"),
        (a["sum"] + p["inside"] + F.when(a["last"].isNull(), F.lit(0.0)).otherwise(_delta(p["first"], a["last"]))).alias("sum"),
        (a["n"] + p["n"]).alias("n")))
    return (gathered_panes.withColumn("whole", whole)
            .select(*series, F.col("pane_").alias("pane"), F.col("pane_.start").alias("start"), F.col("whole.n").alias("n"),
                    F.element_at("parts", 1)["first"].alias("first"), F.col("whole.last").alias("last"), F.col("whole.sum").alias("inside")))


def windowed_rates(samples: DataFrame, range_seconds: int, slide_seconds: int, delay_seconds: int) -> DataFrame:
    """Per-window rate of raw counter samples ``(metric, label, ts, value)``.

    A pane keeps its first and last value, its number of samples and the
    increase inside it.  Panes are built from panes, in chained aggregations,
    from one instant (of several samples at it the largest counts) up to one
    slide; a window folds its ``range / slide`` slides.  No array holds more than
    ``FAN_OUT`` panes, or those of one window, however densely a series is sampled.
    """
    if range_seconds % slide_seconds:
        raise ValueError("the range must be a multiple of the slide")
    series = ["metric", "label"]
    panes = instants(samples.withWatermark("ts", f"{delay_seconds} seconds"), series)
    for width in pane_widths(slide_seconds):
        panes = folded(gathered(panes, series, f"{width} microseconds"), series)
    windows = folded(gathered(panes, series, f"{range_seconds} seconds", f"{slide_seconds} seconds"), series)
    return (windows.where(F.col("n") >= 2)
            .select(*series, F.col("pane.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("pane.end").cast("timestamp_ntz").alias("window_end"),
                    (F.col("inside") / F.lit(float(range_seconds))).alias("rate"), F.col("n").alias("samples")))


def run_counter_rate(spark: SparkSession, source: str, out: str, metric: str, range_seconds: int,
                     slide_seconds: int, delay_seconds: int, max_files: int | None = None) -> None:
    """H4: rates of one counter over a folder of raw samples that arrive in
    files, in order of time within the delay."""
    samples = (spark.readStream.schema("metric string, label string, ts timestamp_ntz, value double")
                    .option("maxFilesPerTrigger", max_files or MAX_FILES).parquet(source)
                    .where(F.col("metric") == metric).withColumn("ts", F.col("ts").cast("timestamp")))
    rates = windowed_rates(samples, range_seconds, slide_seconds, delay_seconds)
    q = (rates.writeStream.format("parquet").option("path", f"{out}/rates").option("checkpointLocation", f"{out}/_checkpoint")
              .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def stream_counter_rate(spark: SparkSession, sf_dir: str, metric: str, range_seconds: int,
                        slide_seconds: int, delay_seconds: int) -> DataFrame:
    """The loaded samples replayed as a stream; the output belongs to that load."""
    source = fx.metric_samples_path(spark, sf_dir)
    name = f"counter_rate/{metric}_{range_seconds}_{slide_seconds}_{delay_seconds}/{path_tag(source)}"
    out = stream_folder(spark, name, sf_dir)
    run_counter_rate(spark, source, out, metric, range_seconds, slide_seconds, delay_seconds)
    return spark.read.parquet(f"{out}/rates")
