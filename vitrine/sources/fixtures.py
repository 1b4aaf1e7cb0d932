"""Views that map the driver's tables onto the catalogue's data model.

Projections of one table (``offers``, ``raw_events``, ``timings``) are
session views over the driver file.  Sources that need joins or running
totals (``offer_snapshots``, ``catalog_src``, ``metric_samples``) stand for
files the reference receives ready-made; they are loaded once into the
store (``sources.load``) and queried from there.

Each view is a lazy DataFrame over the whole input table; nothing is
sampled or capped.  Joins carry no broadcast hints: the planner broadcasts a
side only when its size (file statistics, and under AQE the runtime shuffle
size) is below ``spark.sql.autoBroadcastJoinThreshold``, and falls back to a
sort-merge join otherwise, so a dimension that grows with the data is never
shipped whole to every task.  One join is told to broadcast, once its side was
counted: the suppliers of ``catalog_src``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.columns import hour_floor
from vitrine.operators.series import running_sum
from vitrine.sources.load import load_path, load_table
from vitrine.plans.metrics import sample_bounds
from vitrine.sources.store import materialize, shuffles_freed, store_path, write_once
from vitrine.sources.tables import read_table, session_view, table_stamp

# Fixed values of the mapping: the row order that stands for file order.
CATALOG_ROW_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
SNAPSHOT_ORDER = ["l_orderkey", "l_linenumber", "seller_id"]
CATALOG_TABLES = ["lineitem", "part", "supplier", "nation", "region"]
# Suppliers up to this number (a key and a partner's name each) are sent to all tasks; beyond, lines meet them in a shuffle.
SUPPLIERS_SENT = 500_000


def _view(spark: SparkSession, sf_dir: str, name: str, table: str, build) -> DataFrame:
    return session_view(spark, f"vitrine_{table_stamp(spark, sf_dir, [table])}_v_{name}", build)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows ``(offer_id, price, seller_id, category_id, vendor)``."""
    return _view(spark, sf_dir, "offers", "part", lambda: offers_from(read_table(spark, sf_dir, "part")))


def offers_from(p: DataFrame) -> DataFrame:
    """The offers mapping over a ``part`` frame (batch or stream)."""
    return p.select(
        F.col("p_partkey").alias("offer_id"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_partkey") % 10).alias("seller_id"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.col("p_name").alias("vendor"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events in the ``raw_events`` layout."""
    return _view(spark, sf_dir, "raw_events", "events", lambda: raw_events_from(read_table(spark, sf_dir, "events")))


def raw_events_from(e: DataFrame) -> DataFrame:
    """The ``raw_events`` mapping over an ``events`` frame (batch or stream)."""
    return e.select(
        hour_floor("ts").alias("Hour"),
        F.col("event_type").alias("DeviceTypeName"),
        F.concat(F.lit("app_"), (F.col("event_id") % 4).cast("string")).alias("ApplicationName"),
        F.concat(F.lit("os_"), (F.col("event_id") % 3).cast("string")).alias("OSName"),
        F.concat(F.lit("prov_"), (F.col("user_id") % 10).cast("string")).alias("ProvinceName"),
        F.col("user_id").alias("ContentUnitID"),
    )


def offer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue snapshots: one row per line item, dated by ship date, with
    the load-order columns kept for version tie-breaks."""
    return load_table(spark, sf_dir, "offer_snapshots", lambda: _offer_snapshots(spark, sf_dir),
                      ["category_id", "offer_id", *SNAPSHOT_ORDER], ["lineitem", "part"])


def _offer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
        F.col("l_partkey").alias("offer_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.col("p_name").alias("vendor"),
        "l_orderkey", "l_linenumber",
    )


def catalog_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers with partner and category path, in the source file layout:
    ``Partner_Name, Category_ID, Category_FullPathName, Offer_ID, Offer_Name,
    Offer_Type`` plus the row-order columns and ``load_date`` (the ship
    date, which splits the rows into successive loads for the upserts).

    The rows are wide, so they are written where the join with the parts makes
    them.  It is a merge join whatever the sizes: the lines of a part lie
    together, so that what depends on the part takes little room in the files
    and groupings by offer are combined before they are shuffled."""
    return load_table(spark, sf_dir, "catalog_src", lambda: _catalog_src(spark, sf_dir), None, CATALOG_TABLES)


def _catalog_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Path, id and partner depend only on the dimension rows, so they are
    # computed there (once per part / supplier) and carried by the joins.
    # Suppliers come first: they add one short column, so that lines are still
    # narrow when they are shuffled for the parts, and not shuffled after that.
    # They are counted, as AQE sees that they are few when the lines are shuffled.
    li = read_table(spark, sf_dir, "lineitem").select(*CATALOG_ROW_ORDER, F.col("l_shipdate").cast("date").alias("load_date"))
    p = read_table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    levels = F.array(F.col("p_type"), F.col("p_brand"), F.get(words, 0), F.get(words, 1))
    path = F.array_join(F.slice(levels, F.lit(1), F.col("p_size") % 4 + 1), "\\")
    parts = p.select("p_partkey", path.alias("Category_FullPathName"),
                     F.col("p_name").alias("Offer_Name"), F.col("p_type").alias("Offer_Type")) \
             .withColumn("Category_ID", F.md5("Category_FullPathName"))
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit(" "), F.col("r_name"))
                                                   .alias("Partner_Name"))
    supp = (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("s_suppkey", "Partner_Name"))
    with shuffles_freed(spark):
        few = supp.count() <= SUPPLIERS_SENT
    lines = li.join(F.broadcast(supp) if few else supp, li.l_suppkey == supp.s_suppkey).select(*li.columns, "Partner_Name")
    j = lines.join(parts.hint("merge"), lines.l_partkey == parts.p_partkey)
    return j.select(
        "Partner_Name", "Category_ID", "Category_FullPathName",
        F.col("l_partkey").alias("Offer_ID"), "Offer_Name", "Offer_Type",
        *CATALOG_ROW_ORDER, "load_date",
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing samples ``(query, iteration, seconds)``."""
    return _view(spark, sf_dir, "timings", "orders", lambda: _timings(spark, sf_dir))


def _timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("query"),
                    F.col("o_orderkey").alias("iteration"),
                    (F.col("o_totalprice") / 1e6).alias("seconds"))


# Fixed values of the metric mapping: metric names, the counter wrap used to
# create resets, and the scale of the gauge.
QUERIES_METRIC = "queries_total"
TIME_METRIC = "query_time_us"
MEMORY_METRIC = "memory_bytes"
QUERIES_WRAP = 500
MEMORY_SCALE = 1e6
METRIC_BUCKET_ROWS = 1 << 20
SAMPLES = "metric_samples"


def metric_samples(spark: SparkSession, sf_dir: str, bucket_rows: int = METRIC_BUCKET_ROWS) -> DataFrame:
    """Samples ``(metric, label, ts, value)`` as a scraper would store them,
    derived from the events: two counters (one with resets) and one gauge per
    event type.

    The counters are running totals per event type in ``event_id`` order.
    Event types are few, so each is a hot key; the running totals are
    computed bucket by bucket (``running_sum``), never one type per task.
    The table is loaded in order of time: a file stream replays it in order
    (the watermark is global across series) and time filters skip files.
    """
    return load_table(spark, sf_dir, SAMPLES, lambda: _metric_samples(spark, sf_dir, bucket_rows),
                      ["ts", "metric", "label", "value"], ["events"], in_order=True)


def metric_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cuts the long series of the samples into buckets, computed once and stored."""
    return materialize(spark, store_path(spark, "metric_bounds", sf_dir, ["events"]), lambda: sample_bounds(metric_samples(spark, sf_dir)))


def metric_samples_path(spark: SparkSession, sf_dir: str) -> str:
    """The finished build of the loaded samples, as files a stream can replay."""
    metric_samples(spark, sf_dir)
    return write_once(spark, load_path(spark, sf_dir, SAMPLES, ["events"]), None)


def _metric_samples(spark: SparkSession, sf_dir: str, bucket_rows: int) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    r = running_sum(e, ["event_type"], ["event_id"],
                    {"__n": F.lit(1).cast("bigint"),
                     "__us": F.round(F.col("value") * 100).cast("bigint")},
                    F.floor(F.col("event_id") / F.lit(bucket_rows)))
    label = F.col("event_type").alias("label")
    queries = r.select(F.lit(QUERIES_METRIC).alias("metric"), label, "ts",
                       (F.col("__n") % QUERIES_WRAP).cast("double").alias("value"))
    time_us = r.select(F.lit(TIME_METRIC).alias("metric"), label, "ts", F.col("__us").cast("double").alias("value"))
    memory = e.select(F.lit(MEMORY_METRIC).alias("metric"), label, "ts",
                      (F.col("value") * MEMORY_SCALE).alias("value"))
    return queries.unionByName(time_us).unionByName(memory)
