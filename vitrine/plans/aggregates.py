"""Maintained aggregates (E1-E6): batch builds, persistence, reads.

The three pre-aggregates are written as Parquet under the shared store
(``vitrine.session.store_root``).  A build writes a new folder and is only
read once its ``_SUCCESS`` marker exists, so a job that dies halfway (lost
executor, killed driver) leaves nothing a reader would pick up; the next call
rebuilds it.  Readers always re-aggregate by key (S4, S5): the batch build
has one row per key, but stream deltas (``vitrine.streaming``) add one row per
key and micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.columns import month_key
from vitrine.operators.relational import count_by, pick_per_key
from vitrine.sources.store import materialize, store_path

# ---------------------------------------------------------------- builds
def category_counts(offers: DataFrame) -> DataFrame:
    """``catalog_by_category``: offers per category."""
    return count_by(offers, ["category_id"], "offers_cnt")


def brand_counts(offers: DataFrame) -> DataFrame:
    """``catalog_by_brand``: offers per (vendor, category) (E5)."""
    return count_by(offers, ["vendor", "category_id"], "offers_cnt")


def offer_events_daily(raw_events: DataFrame, offers: DataFrame) -> DataFrame:
    """``offer_events``: events per (day, offer, category, vendor).

    Events are first counted per (day, offer id).  That map-side combined
    aggregate is what crosses the shuffle and meets the catalogue in the
    join, so an offer that receives a third of all events arrives as one row
    per day instead of a third of the event table.  Summing the per-day
    counts over the matching catalogue rows equals counting the joined rows.
    """
    per_day = (raw_events.groupBy(F.to_date("Hour").alias("event_date"), F.col("ContentUnitID"))
                         .agg(F.count(F.lit(1)).alias("n")))
    j = per_day.join(offers.select("offer_id", "category_id", "vendor"),
                     per_day.ContentUnitID == offers.offer_id, "inner")
    return (j.groupBy("event_date", "offer_id", "category_id", "vendor")
             .agg(F.sum("n").cast("bigint").alias("events_cnt")))


def latest_versions(snapshots: DataFrame, load_order: list[str], per_month: bool = True) -> DataFrame:
    """Newest ``snapshot_date`` per (month, category, offer), load order
    breaking ties (E1); ``per_month=False`` gives the global latest."""
    keys = (["snapshot_month"] if per_month else []) + ["category_id", "offer_id"]
    d = snapshots.withColumn("snapshot_month", month_key("snapshot_date")) if per_month else snapshots
    return pick_per_key(d, keys, ["snapshot_date", *load_order], latest=True)


def offer_days(offer_events: DataFrame) -> DataFrame:
    """Daily rows per offer: what anti-joins and coverage ask of ``offer_events``."""
    return count_by(offer_events, ["offer_id"], "days")


# ---------------------------------------------------------------- stored
# Sources are given as functions: they are only called when something has to be built.
Source = Callable[[], DataFrame]


def stored_category_counts(spark: SparkSession, sf_dir: str, offers: Source) -> DataFrame:
    return materialize(spark, store_path(spark, "catalog_by_category", sf_dir, ["part"]),
                       lambda: category_counts(offers()), sort_by=["category_id"])


def stored_brand_counts(spark: SparkSession, sf_dir: str, offers: Source) -> DataFrame:
    return materialize(spark, store_path(spark, "catalog_by_brand", sf_dir, ["part"]),
                       lambda: brand_counts(offers()), sort_by=["vendor", "category_id"])


def stored_offer_events(spark: SparkSession, sf_dir: str, raw_events: Source, offers: Source) -> DataFrame:
    """Daily aggregate partitioned by ``event_date`` (S7), sorted by offer."""
    return materialize(spark, store_path(spark, "offer_events", sf_dir, ["events", "part"]),
                       lambda: offer_events_daily(raw_events(), offers()),
                       partition_by=["event_date"], sort_by=["offer_id"])


def stored_offer_days(spark: SparkSession, sf_dir: str, offer_events: Source) -> DataFrame:
    """The daily aggregate's projection without the day, a row per offer."""
    return materialize(spark, store_path(spark, "offer_days", sf_dir, ["events", "part"]),
                       lambda: offer_days(offer_events()), sort_by=["offer_id"])


def resum(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Re-aggregate a stored aggregate by its key."""
    return df.groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(measure))
