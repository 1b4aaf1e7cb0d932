"""The SQL surface: the catalogue's tables as session views under the names
its users know, and the two dashboard panels that rely on SQL features.

``register_ecom_views`` binds ``ecom_offers``, ``raw_events`` and the three
pre-aggregates (``catalog_by_category_mv``, ``catalog_by_brand_mv``,
``offer_events_mv``); any Spark SQL runs over them.  Views are looked up by the
state of their input at each call, so files that were appended are seen by the
next call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.plans import aggregates as agg
from vitrine.sources import fixtures as fx


def ecom_tables(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Catalogue tables and stored pre-aggregates of one input folder, by name, each looked up when it is called."""
    def offers() -> DataFrame:
        return fx.offers(spark, sf_dir)

    def events() -> DataFrame:
        return fx.raw_events(spark, sf_dir)

    return {
        "ecom_offers": offers,
        "raw_events": events,
        "catalog_by_category_mv": lambda: agg.stored_category_counts(spark, sf_dir, offers),
        "catalog_by_brand_mv": lambda: agg.stored_brand_counts(spark, sf_dir, offers),
        "offer_events_mv": lambda: agg.stored_offer_events(spark, sf_dir, events, offers),
    }


def register_ecom_views(spark: SparkSession, sf_dir: str) -> None:
    """Plain names (``ecom_offers``, ``raw_events``, ``*_mv``) for ad-hoc SQL."""
    for name, table in ecom_tables(spark, sf_dir).items():
        table().createOrReplaceTempView(name)


def panel_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverage panel, select aliases reused in the same select.
    Daily rows are counted per offer before they meet the catalogue."""
    t = ecom_tables(spark, sf_dir)
    return spark.sql("""
        WITH days AS (SELECT offer_id AS id, count(*) AS n FROM {mv} GROUP BY offer_id),
             seen AS (SELECT coalesce(n, 0) AS n FROM {offers} LEFT JOIN days ON id = offer_id)
        SELECT CAST(sum(n) AS BIGINT) AS offers_with_events,
               CAST(sum(greatest(n, 1)) AS BIGINT) AS total_offers,
               try_divide(offers_with_events, total_offers) AS coverage_ratio
        FROM seen""", mv=t["offer_events_mv"](), offers=t["ecom_offers"]())


def panel_offers_without_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows that the daily aggregate never mentions."""
    t = ecom_tables(spark, sf_dir)
    return spark.sql("""
        SELECT count(*) AS offers_without_events FROM {offers} AS c
        WHERE NOT EXISTS (SELECT 1 FROM {mv} AS m WHERE m.offer_id = c.offer_id)""",
                     mv=t["offer_events_mv"](), offers=t["ecom_offers"]())
