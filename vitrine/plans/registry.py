"""Named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables (or stores Spark derived from
them); none runs on invented input.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import relational as rel
from vitrine.plans import aggregates as agg
from vitrine.plans import catalog as cat
from vitrine.plans import documents as docs
from vitrine.plans import hierarchy as hi
from vitrine.plans import metrics as met
from vitrine.plans import sql_surface as sqls
from vitrine.session import store_root
from vitrine.sources import tables as src
from vitrine.sources import fixtures as fx
from vitrine.sources.store import materialize, store_path, write_once
from vitrine.streaming import incremental as inc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _offers(spark, sf_dir):
    return lambda: fx.offers(spark, sf_dir)


def _offer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.stored_offer_events(spark, sf_dir, lambda: fx.raw_events(spark, sf_dir), _offers(spark, sf_dir))


def _offer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.stored_offer_days(spark, sf_dir, lambda: _offer_events(spark, sf_dir))


# ---------------------------------------------------------------- catalogue
def _category_counts(spark, sf_dir):
    return agg.stored_category_counts(spark, sf_dir, _offers(spark, sf_dir))


def _brand_counts(spark, sf_dir):
    return agg.stored_brand_counts(spark, sf_dir, _offers(spark, sf_dir))


@register("top_categories_raw")
def q_top_categories_raw(spark, sf_dir):
    return cat.top_categories(fx.offers(spark, sf_dir))


@register("top_categories_mv")
def q_top_categories_mv(spark, sf_dir):
    return cat.top_categories_mv(_category_counts(spark, sf_dir))


@register("top_brands_raw")
def q_top_brands_raw(spark, sf_dir):
    return cat.top_brands(fx.offers(spark, sf_dir))


@register("top_brands_mv")
def q_top_brands_mv(spark, sf_dir):
    return cat.top_brands_mv(_brand_counts(spark, sf_dir))


@register("avg_offers_per_brand_raw")
def q_avg_offers_per_brand_raw(spark, sf_dir):
    return cat.avg_offers_per_brand(fx.offers(spark, sf_dir))


@register("avg_offers_per_brand_mv")
def q_avg_offers_per_brand_mv(spark, sf_dir):
    return cat.avg_offers_per_brand_mv(_brand_counts(spark, sf_dir))


@register("offers_without_events_raw")
def q_offers_without_events_raw(spark, sf_dir):
    return cat.offers_without_events(fx.offers(spark, sf_dir), fx.raw_events(spark, sf_dir))


@register("offers_without_events_mv")
def q_offers_without_events_mv(spark, sf_dir):
    return cat.offers_without_events_mv(fx.offers(spark, sf_dir), _offer_days(spark, sf_dir))


@register("offers_without_events_count")
def q_offers_without_events_count(spark, sf_dir):
    return cat.offers_without_events_count(fx.offers(spark, sf_dir), _offer_days(spark, sf_dir))


@register("coverage_rows")
def q_coverage_rows(spark, sf_dir):
    return cat.coverage_of_days(fx.offers(spark, sf_dir), _offer_days(spark, sf_dir))


@register("coverage_offers")
def q_coverage_offers(spark, sf_dir):
    return cat.coverage_offers(fx.offers(spark, sf_dir), _offer_days(spark, sf_dir))


@register("events_by_device")
def q_events_by_device(spark, sf_dir):
    return cat.events_by_device(fx.raw_events(spark, sf_dir))


@register("offer_events_daily")
def q_offer_events_daily(spark, sf_dir):
    return agg.offer_events_daily(fx.raw_events(spark, sf_dir), fx.offers(spark, sf_dir))


@register("offer_events_daily_mv")
def q_offer_events_daily_mv(spark, sf_dir):
    return agg.resum(_offer_events(spark, sf_dir),
                     ["event_date", "offer_id", "category_id", "vendor"], "events_cnt")


@register("offers_latest_in_month")
def q_offers_latest_in_month(spark, sf_dir):
    return agg.latest_versions(fx.offer_snapshots(spark, sf_dir), ["l_orderkey", "l_linenumber", "seller_id"])


@register("offers_latest")
def q_offers_latest(spark, sf_dir):
    return agg.latest_versions(fx.offer_snapshots(spark, sf_dir), ["l_orderkey", "l_linenumber", "seller_id"],
                               per_month=False)


# ---------------------------------------------------------------- documents
# Fixed values for repeatable document loads: the load timestamps and the
# two overlapping load windows used by the upsert queries.
LOAD_TS = dt.datetime(2025, 1, 1, 0, 0, 0)
SECOND_LOAD_TS = dt.datetime(2025, 2, 1, 0, 0, 0)
FIRST_LOAD_BEFORE = "1998-01-01"
SECOND_LOAD_FROM = "1997-01-01"


def _catalog(spark, sf_dir):
    return fx.catalog_src(spark, sf_dir)


def _categories(spark, sf_dir):
    """Category documents, built once per input and stored (like the
    reference's load step); queries read the stored documents."""
    return materialize(spark, store_path(spark, "categories", sf_dir, fx.CATALOG_TABLES),
                           lambda: docs.categories_docs(_catalog(spark, sf_dir), fx.CATALOG_ROW_ORDER, LOAD_TS),
                           sort_by=["partner", "level"])


def _products(spark, sf_dir):
    return materialize(spark, store_path(spark, "products", sf_dir, fx.CATALOG_TABLES),
                           lambda: docs.products_docs(_catalog(spark, sf_dir), fx.CATALOG_ROW_ORDER, LOAD_TS),
                           sort_by=["type", "partner"], spread=False)


@register("profile_summary")
def q_profile_summary(spark, sf_dir):
    return docs.profile_summary(spark, _catalog(spark, sf_dir))


@register("top_partner_categories")
def q_top_partner_categories(spark, sf_dir):
    return docs.top_partner_categories(_catalog(spark, sf_dir))


@register("multi_partner_offers")
def q_multi_partner_offers(spark, sf_dir):
    return docs.multi_partner_offers(_catalog(spark, sf_dir))


@register("categories_docs")
def q_categories_docs(spark, sf_dir):
    return docs.categories_flat(docs.categories_docs(_catalog(spark, sf_dir), fx.CATALOG_ROW_ORDER, LOAD_TS))


@register("products_docs")
def q_products_docs(spark, sf_dir):
    return docs.products_flat(docs.products_docs(_catalog(spark, sf_dir), fx.CATALOG_ROW_ORDER, LOAD_TS))


def _two_loads(spark, sf_dir):
    src = _catalog(spark, sf_dir)
    return (src.where(F.col("load_date") < F.lit(FIRST_LOAD_BEFORE).cast("date")),
            src.where(F.col("load_date") >= F.lit(SECOND_LOAD_FROM).cast("date")))


@register("categories_upsert")
def q_categories_upsert(spark, sf_dir):
    first, second = _two_loads(spark, sf_dir)
    old = docs.categories_docs(first, fx.CATALOG_ROW_ORDER, LOAD_TS)
    new = docs.categories_docs(second, fx.CATALOG_ROW_ORDER, SECOND_LOAD_TS)
    return docs.categories_flat(rel.upsert_replace(old, new, "_id"))


@register("products_upsert")
def q_products_upsert(spark, sf_dir):
    first, second = _two_loads(spark, sf_dir)
    old = docs.products_docs(first, fx.CATALOG_ROW_ORDER, LOAD_TS)
    new = docs.products_docs(second, fx.CATALOG_ROW_ORDER, SECOND_LOAD_TS)
    return docs.products_flat(rel.upsert_set_on_insert(old, new, "_id", ["created_at"]))


# Fixed rule of the test source with gaps: which rows lack an id, a path or a partner.
def _gaps(spark, sf_dir):
    d = _catalog(spark, sf_dir)
    no = lambda c, cond: F.when(~cond, F.col(c)).alias(c)
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    return d.select(no("Partner_Name", order % 17 == 0), no("Category_ID", (line == 2) & (order % 11 == 0)),
                    no("Category_FullPathName", order % 7 == 0), no("Offer_ID", (line == 1) & (order % 13 == 0)),
                    *[c for c in d.columns if c not in ("Partner_Name", "Category_ID", "Category_FullPathName", "Offer_ID")])


@register("rejected_rows")
def q_rejected_rows(spark, sf_dir):
    """Source rows that a document build has no key for (none here)."""
    return docs.rejected_rows(_catalog(spark, sf_dir), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "partner", "category_id", "offer_id", "reason")


@register("rejected_rows_gaps")
def q_rejected_rows_gaps(spark, sf_dir):
    """G16 over the source with gaps."""
    return docs.rejected_rows(_gaps(spark, sf_dir), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "partner", "category_id", "offer_id", "reason")


@register("categories_docs_gaps")
def q_categories_docs_gaps(spark, sf_dir):
    """E9 over the source with gaps: null partners, paths and ids."""
    d = docs.categories_flat(docs.categories_docs(_gaps(spark, sf_dir), fx.CATALOG_ROW_ORDER, LOAD_TS))
    return d.select("partner", "category_id", "path", "level", "total_products")


@register("multi_partner_offers_gaps")
def q_multi_partner_offers_gaps(spark, sf_dir):
    """D13 over the source with gaps, where offers divisible by three name no partner and so have one only."""
    named = F.when(F.col("Offer_ID") % 3 != 0, F.col("Partner_Name"))
    return docs.multi_partner_offers(_gaps(spark, sf_dir).withColumn("Partner_Name", named))


@register("categories_json")
def q_categories_json(spark, sf_dir):
    return docs.categories_json(_categories(spark, sf_dir))


@register("documents_json")
def q_documents_json(spark, sf_dir):
    return docs.products_json(_products(spark, sf_dir))


# ---------------------------------------------------------------- hierarchy
@register("categories_by_level")
def q_categories_by_level(spark, sf_dir):
    return hi.categories_by_level(_categories(spark, sf_dir))


@register("categories_by_partner_level")
def q_categories_by_partner_level(spark, sf_dir):
    return hi.categories_by_partner_level(_categories(spark, sf_dir))


@register("category_depth")
def q_category_depth(spark, sf_dir):
    return hi.category_depth(_categories(spark, sf_dir))


@register("categories_filter_level_partner")
def q_categories_filter_level_partner(spark, sf_dir):
    return hi.categories_filter(_categories(spark, sf_dir), 1, "_asia")


@register("categories_containing")
def q_categories_containing(spark, sf_dir):
    return hi.categories_containing(_categories(spark, sf_dir), "Brand#4")


@register("top_categories_by_products")
def q_top_categories_by_products(spark, sf_dir):
    return hi.top_categories_by_products(_categories(spark, sf_dir))


@register("largest_at_level")
def q_largest_at_level(spark, sf_dir):
    return hi.largest_at_levels(_categories(spark, sf_dir), (1, 4))


@register("deepest_category")
def q_deepest_category(spark, sf_dir):
    return hi.deepest_category(_categories(spark, sf_dir))


@register("leaf_categories")
def q_leaf_categories(spark, sf_dir):
    return hi.leaf_categories(_categories(spark, sf_dir))


@register("children_per_category")
def q_children_per_category(spark, sf_dir):
    return hi.children_per_category(_categories(spark, sf_dir))


@register("category_children")
def q_category_children(spark, sf_dir):
    return hi.category_children(_categories(spark, sf_dir))


@register("first_categories")
def q_first_categories(spark, sf_dir):
    return hi.first_categories(_categories(spark, sf_dir), 1, "_asia", 3)


@register("products_type_in_branch")
def q_products_type_in_branch(spark, sf_dir):
    return hi.products_in_branch(_products(spark, sf_dir), "PROMO", "Brand#4")


@register("products_depth4")
def q_products_depth4(spark, sf_dir):
    return hi.products_deeper_than(_products(spark, sf_dir), 3)


@register("product_sample")
def q_product_sample(spark, sf_dir):
    return hi.product_sample(_products(spark, sf_dir), 3)


@register("products_by_type")
def q_products_by_type(spark, sf_dir):
    return hi.products_by_type(_products(spark, sf_dir))


@register("products_by_partner")
def q_products_by_partner(spark, sf_dir):
    return hi.products_by_partner(_products(spark, sf_dir))


@register("products_by_root")
def q_products_by_root(spark, sf_dir):
    return hi.products_by_root(_products(spark, sf_dir))


@register("top_product_categories")
def q_top_product_categories(spark, sf_dir):
    return hi.top_product_categories(_products(spark, sf_dir))


@register("level_name_stats")
def q_level_name_stats(spark, sf_dir):
    return hi.level_name_stats(_products(spark, sf_dir))


@register("busiest_level")
def q_busiest_level(spark, sf_dir):
    return hi.busiest_level(_products(spark, sf_dir))


@register("top3_per_level")
def q_top3_per_level(spark, sf_dir):
    return hi.top_names_per_level(_products(spark, sf_dir), (1, 2, 3), 3)


# ---------------------------------------------------------------- metrics
# Fixed value: samples of one label are about 21 minutes apart in the
# driver data, so the one-minute range of the dashboards becomes six hours.
RATE_RANGE_SECONDS = 6 * 3600


@register("counter_rate")
def q_counter_rate(spark, sf_dir):
    return met.counter_rate(fx.metric_samples(spark, sf_dir), fx.QUERIES_METRIC, RATE_RANGE_SECONDS,
                            fx.metric_bounds(spark, sf_dir))


@register("latency_ratio")
def q_latency_ratio(spark, sf_dir):
    return met.ratio_of_rates(fx.metric_samples(spark, sf_dir), fx.TIME_METRIC, fx.QUERIES_METRIC,
                              RATE_RANGE_SECONDS, bounds=fx.metric_bounds(spark, sf_dir))


@register("gauge_scaled")
def q_gauge_scaled(spark, sf_dir):
    return met.gauge_scaled(fx.metric_samples(spark, sf_dir), fx.MEMORY_METRIC)


@register("last_window")
def q_last_window(spark, sf_dir):
    return met.last_window(fx.metric_samples(spark, sf_dir), 5)


@register("timing_summary")
def q_timing_summary(spark, sf_dir):
    return met.timing_summary(fx.timings(spark, sf_dir))


# ---------------------------------------------------------------- loads
@register("csv_load")
def q_csv_load(spark, sf_dir):
    """A3: the catalogue written as a headed CSV to the store, read back
    positionally, header rows filtered, text cast."""
    path = store_path(spark, "offers_csv", sf_dir, ["part"])
    return src.read_offers_csv(spark, write_once(spark, path, lambda target: src.write_offers_csv(fx.offers(spark, sf_dir), target)))


@register("merge_partial_counts")
def q_merge_partial_counts(spark, sf_dir):
    """Partial per-category counts of the snapshots up to a day and after
    it, two frames, merged by summing."""
    snaps = fx.offer_snapshots(spark, sf_dir)
    split = F.lit(FIRST_LOAD_BEFORE).cast("date")
    partials = [rel.count_by(part, ["category_id"], "offers_cnt")
                for part in (snaps.where(F.col("snapshot_date") < split), snaps.where(F.col("snapshot_date") >= split))]
    return rel.merge_partial_sums(partials, ["category_id"], ["offers_cnt"])


# ---------------------------------------------------------------- namespace
def _ecom(spark, sf_dir) -> tuple[str, str]:
    """The namespace with both tables filled by column-list inserts,
    once per state of the input and session, and the day of that load."""
    db = f"vitrine_ecom_{src.table_stamp(spark, sf_dir, ['part', 'events'])}"
    return db, src.load_namespace(spark, fx.offers(spark, sf_dir), fx.raw_events(spark, sf_dir), db,
                                  f"{store_root(spark)}/ecom/{db}-{uuid.uuid4().hex}")


@register("ecom_offers_table")
def q_ecom_offers_table(spark, sf_dir):
    """Rows read through the namespace, with whether the date
    took its default on the day of the load and the month partition belongs to it."""
    db, day = _ecom(spark, sf_dir)
    t = spark.table(f"{db}.ecom_offers")
    in_month = F.col("snapshot_month") == F.year("snapshot_date") * 100 + F.month("snapshot_date")
    return t.select("offer_id", "price", "seller_id", "category_id", "vendor",
                    F.datediff("snapshot_date", F.lit(day).cast("date")).between(0, 1).alias("dated_today"), in_month.alias("in_month"))


@register("raw_events_table")
def q_raw_events_table(spark, sf_dir):
    """Events per day partition and device, read through the namespace."""
    t = spark.table(f"{_ecom(spark, sf_dir)[0]}.raw_events")
    return rel.count_by(t, ["event_date", "DeviceTypeName"], "events_cnt")


# ---------------------------------------------------------------- streaming
STREAM_SLIDE_SECONDS = 3600
STREAM_DELAY_SECONDS = 3600


@register("stream_category_counts")
def q_stream_category_counts(spark, sf_dir):
    return inc.stream_category_counts(spark, sf_dir)


@register("stream_brand_counts")
def q_stream_brand_counts(spark, sf_dir):
    return inc.stream_brand_counts(spark, sf_dir)


@register("stream_offer_events")
def q_stream_offer_events(spark, sf_dir):
    return inc.stream_offer_events(spark, sf_dir)


@register("stream_counter_rate")
def q_stream_counter_rate(spark, sf_dir):
    return inc.stream_counter_rate(spark, sf_dir, fx.QUERIES_METRIC, RATE_RANGE_SECONDS,
                                   STREAM_SLIDE_SECONDS, STREAM_DELAY_SECONDS)


# ---------------------------------------------------------------- SQL surface
@register("panel_coverage_sql")
def q_panel_coverage_sql(spark, sf_dir):
    return sqls.panel_coverage(spark, sf_dir)


@register("panel_offers_without_events_sql")
def q_panel_offers_without_events_sql(spark, sf_dir):
    return sqls.panel_offers_without_events(spark, sf_dir)
