"""Catalogue questions on the raw tables and on the pre-aggregates
(D1-D10, C1-C5, B6, B12, F1, F2).

Every function takes DataFrames and returns a DataFrame; sorting keys end
with the group key so limits are deterministic (S11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.columns import safe_ratio
from vitrine.operators.relational import anti_join, count_by, top_k
from vitrine.plans.aggregates import offer_days, resum

OFFER_COLUMNS = ["offer_id", "category_id", "vendor", "price"]


# ---------------------------------------------------------------- raw
def top_categories(offers: DataFrame, k: int = 20) -> DataFrame:
    """Offers per category, top k."""
    return top_k(count_by(offers, ["category_id"], "offers_cnt"),
                 [F.desc("offers_cnt"), F.asc("category_id")], k)


def top_brands(offers: DataFrame, k: int = 30) -> DataFrame:
    """Offers per vendor, top k."""
    return top_k(count_by(offers, ["vendor"], "offers_cnt"), [F.desc("offers_cnt"), F.asc("vendor")], k)


def avg_offers_per_brand(offers: DataFrame) -> DataFrame:
    """Offers per (category, vendor), then their mean per category."""
    per_brand = count_by(offers, ["category_id", "vendor"], "offers_per_brand")
    return (per_brand.groupBy("category_id")
                     .agg(F.round(F.avg("offers_per_brand"), 6).alias("avg_offers_per_brand"))
                     .orderBy(F.desc("avg_offers_per_brand"), F.asc("category_id")))


def events_by_device(raw_events: DataFrame) -> DataFrame:
    """Events per device type, all of them, largest first."""
    return count_by(raw_events, ["DeviceTypeName"], "events_cnt") \
        .orderBy(F.desc("events_cnt"), F.asc("DeviceTypeName"))


def offers_without_events(offers: DataFrame, raw_events: DataFrame) -> DataFrame:
    """Catalogue rows whose offer id has no event (left anti-join, S1)."""
    return anti_join(offers, raw_events, "offer_id", "ContentUnitID").select(*OFFER_COLUMNS)


# ---------------------------------------------------------------- pre-aggregated
# A stored aggregate may hold several rows of a key (a stream adds one per
# micro-batch), so every reader sums again.
def top_categories_mv(category_counts: DataFrame, k: int = 20) -> DataFrame:
    """Top k categories read from the per-category aggregate."""
    return top_k(resum(category_counts, ["category_id"], "offers_cnt"),
                 [F.desc("offers_cnt"), F.asc("category_id")], k)


def top_brands_mv(brand_counts: DataFrame, k: int = 30) -> DataFrame:
    """D3: sum of the per-(vendor, category) counts per vendor, top k."""
    return top_k(resum(brand_counts, ["vendor"], "offers_cnt"), [F.desc("offers_cnt"), F.asc("vendor")], k)


def avg_offers_per_brand_mv(brand_counts: DataFrame) -> DataFrame:
    """Mean of the per-(vendor, category) counts per category.

    The mean over brands is the sum of counts over the number of distinct
    brands, so repeated keys are summed by the first aggregation.
    """
    return (resum(brand_counts, ["vendor", "category_id"], "offers_cnt").groupBy("category_id")
            .agg(F.round(F.avg("offers_cnt"), 6).alias("avg_offers_per_brand"))
            .orderBy(F.desc("avg_offers_per_brand"), F.asc("category_id")))


def offers_without_events_mv(offers: DataFrame, offer_events: DataFrame) -> DataFrame:
    """C4: the same anti-join against the daily events aggregate."""
    return anti_join(offers, offer_events, "offer_id").select(*OFFER_COLUMNS)


def offers_without_events_count(offers: DataFrame, offer_events: DataFrame) -> DataFrame:
    """``countIf(ev.offer_id IS NULL)`` after the left join = anti-join size."""
    return offers_without_events_mv(offers, offer_events).agg(
        F.count(F.lit(1)).alias("offers_without_events"))


def coverage_rows(offers: DataFrame, offer_events: DataFrame) -> DataFrame:
    """D9 as written (S2): the left join to *daily* rows counts joined rows.

    The joined-row counts are derived without materialising the fan-out:
    each catalogue row contributes ``max(days, 1)`` rows, ``days`` of them
    matched.  The daily table is reduced to one row per offer first.
    """
    return coverage_of_days(offers, offer_days(offer_events))


def coverage_of_days(offers: DataFrame, days_per_offer: DataFrame) -> DataFrame:
    """D9 from the number of daily rows per offer."""
    per = days_per_offer.select(F.col("offer_id").alias("__k"), F.col("days").alias("__rows"))
    j = offers.select("offer_id").join(per, F.col("offer_id") == F.col("__k"), "left")
    days = F.coalesce(F.col("__rows"), F.lit(0))
    agg = j.agg(F.sum(days).cast("bigint").alias("offers_with_events"),
                F.sum(F.greatest(days, F.lit(1))).cast("bigint").alias("total_offers"))
    return agg.select("offers_with_events", "total_offers",
                      F.round(safe_ratio("offers_with_events", "total_offers"), 6).alias("coverage_ratio"))


def coverage_offers(offers: DataFrame, offer_events: DataFrame) -> DataFrame:
    """D9 per offer: catalogue rows with at least one event day."""
    ids = offer_events.select(F.col("offer_id").alias("__k")).distinct()
    j = offers.select("offer_id").join(ids, F.col("offer_id") == F.col("__k"), "left")
    agg = j.agg(F.count("__k").alias("offers_with_events"), F.count(F.lit(1)).alias("total_offers"))
    return agg.select("offers_with_events", "total_offers",
                      F.round(safe_ratio("offers_with_events", "total_offers"), 6).alias("coverage_ratio"))
