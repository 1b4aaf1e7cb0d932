"""Category and product documents (E9, E10, E7, E8, A8) and the source
profile (D11-D16).

The source is the offers-with-paths layout (``CATALOG_REQUIRED`` columns)
plus the columns that define row order.  Row order replaces "first in file"
(S12): it is an explicit list of columns, so results do not depend on how
files were split into tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import columns as fn
from vitrine.operators.relational import top_k, upsert_set_on_insert
from vitrine.sources.store import exists, remove
from vitrine.sources.tables import CATALOG_REQUIRED, iso_text, require_columns, to_json_documents


def _ts(value: dt.datetime | Column | None) -> Column:
    """Load timestamp: one value for the whole load."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, Column):
        return value
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def normalized(src: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Source columns cleaned as the loaders do: partner normalised (G7),
    ids and type as text (G6); ``keep`` passes row-order columns through.
    (Column names are case-insensitive, so the raw ``Offer_ID`` and the
    cleaned ``offer_id`` never live side by side.)"""
    require_columns(src, CATALOG_REQUIRED)
    return src.select(
        fn.normalize_partner("Partner_Name").alias("partner"),
        F.col("Category_ID").cast("string").alias("category_id"),
        F.col("Offer_ID").cast("string").alias("offer_id"),
        F.col("Offer_Name").cast("string").alias("offer_name"),
        F.col("Offer_Type").cast("string").alias("offer_type"),
        F.col("Category_FullPathName").alias("path_text"),
        *keep,
    )


def _keyed(src: DataFrame, key: str, payload: Sequence[str], row_order: Sequence[str]) -> DataFrame:
    """Cleaned partner, key, payload and row order; rows without the key left to ``rejected_rows``.

    The clean-up's regular expressions run per row, in the scan's stage: one
    grouping on the cleaned key follows, so source rows are shuffled once.
    """
    return normalized(src, row_order).select("partner", key, *payload, *row_order).where(F.col(key).isNotNull())


def _clean_keys(df: DataFrame, *rest: str) -> DataFrame:
    out = []
    if "Partner_Name" in df.columns:
        out.append(fn.normalize_partner("Partner_Name").alias("partner"))
    if "Category_ID" in df.columns:
        out.append(F.col("Category_ID").cast("string").alias("category_id"))
    if "Offer_ID" in df.columns:
        out.append(F.col("Offer_ID").cast("string").alias("offer_id"))
    return df.select(*out, *rest)


# ---------------------------------------------------------------- profile
def profile_summary(spark: SparkSession, src: DataFrame) -> DataFrame:
    """D11-D14 in one row: distinct (partner, category) pairs, deepest path,
    offers sold by more than one partner, distinct offer types.

    Each figure is a scalar subquery that reads only its own columns (so
    the four Parquet scans together read about what one wide scan would)
    and reduces to distinct raw values before any per-value work: partner
    clean-up and path parsing run on distinct values only.
    """
    require_columns(src, CATALOG_REQUIRED)
    raw_pairs = src.select("Partner_Name", "Category_ID").distinct()
    pairs = _clean_keys(raw_pairs).distinct().agg(F.count(F.lit(1)))
    paths = src.select("Category_FullPathName").distinct()
    depth = paths.agg(F.coalesce(F.max(fn.depth(fn.split_path("Category_FullPathName"))), F.lit(0)))
    multi = _multi_partner_count(src)
    types = src.select(F.col("Offer_Type").cast("string").alias("t")).where(F.col("t").isNotNull()) \
               .distinct().agg(F.count(F.lit(1)))
    return spark.range(1).select(
        pairs.scalar().alias("unique_categories"),
        depth.scalar().cast("int").alias("max_depth"),
        multi.scalar().alias("offers_multi_partner"),
        types.scalar().alias("unique_types"),
    )


def multi_partner_offers(src: DataFrame) -> DataFrame:
    """Offers listed under more than one partner, with the count.

    Distinct pairs first (map-combined), then a plain count: a pair occurs once.
    """
    clean = src.select(fn.normalize_partner("Partner_Name").alias("partner"), F.col("Offer_ID").cast("string").alias("offer_id"))
    return (clean.distinct().groupBy("offer_id").agg(F.count("partner").alias("partners_cnt"))
            .where(F.col("partners_cnt") > 1))


def _multi_partner_count(src: DataFrame) -> DataFrame:
    """Number of offers under several partners: one shuffle of an offer's smallest and largest partner."""
    clean = src.select(fn.normalize_partner("Partner_Name").alias("partner"), F.col("Offer_ID").cast("string").alias("offer_id"))
    per = clean.groupBy("offer_id").agg((F.min("partner") != F.max("partner")).alias("several"))
    return per.agg(F.count_if("several"))


def top_partner_categories(src: DataFrame, k: int = 10) -> DataFrame:
    """Rows per (partner, category), top k."""
    raw = src.groupBy("Partner_Name", "Category_ID").agg(F.count("Offer_ID").alias("n"))
    g = _clean_keys(raw, "n").groupBy("partner", "category_id").agg(F.sum("n").alias("products_cnt"))
    return top_k(g, [F.desc("products_cnt"), F.asc("partner"), F.asc("category_id")], k)


# ---------------------------------------------------------------- documents
def categories_docs(src: DataFrame, row_order: Sequence[str], load_ts=None) -> DataFrame:
    """One document per (partner, category_id).

    ``total_products`` is the group size and the path comes from the first
    row in ``row_order`` whose path is not null (D16): the minimum of
    ``struct(row order..., path)`` over rows with a path, in one grouping on
    the cleaned key, combined map-side.  Rows whose category id is null have
    no key; ``rejected_rows`` returns them with the reason.
    """
    require_columns(src, CATALOG_REQUIRED)
    first = F.min(F.when(F.col("path_text").isNotNull(),
                         F.struct(*[F.col(c) for c in row_order], F.col("path_text").alias("path"))))
    g = (_keyed(src, "category_id", ["path_text"], row_order)
         .groupBy("partner", "category_id").agg(F.count(F.lit(1)).alias("total_products"), first.alias("f")))
    parts = fn.split_path(F.col("f.path"))
    return g.select(
        fn.doc_key("partner", "category_id").alias("_id"),
        "partner", "category_id",
        fn.last_or_null(parts).alias("name"),
        fn.join_path(parts).alias("path"),
        parts.alias("path_array"),
        F.size(parts).alias("level"),
        fn.parent_path(parts).alias("parent_path"),
        F.struct(F.col("total_products").alias("total_products"),
                 _ts(load_ts).alias("last_updated")).alias("metadata"),
    )


def products_docs(src: DataFrame, row_order: Sequence[str], load_ts=None) -> DataFrame:
    """One document per (partner, offer_id), the first source row in
    ``row_order`` kept (E2), breadcrumbs enumerated from the path (G14)."""
    require_columns(src, CATALOG_REQUIRED)
    payload = ["offer_name", "offer_type", "category_id", "path_text"]
    first = F.min(F.struct(*[F.col(c) for c in row_order], *payload))
    g = _keyed(src, "offer_id", payload, row_order).groupBy("partner", "offer_id").agg(first.alias("f")) \
        .select("partner", "offer_id", F.struct(F.col("f.offer_name").alias("name"), F.col("f.offer_type").alias("type"),
                                                F.col("f.category_id"), F.col("f.path_text").alias("path")).alias("f"))
    parts = fn.split_path(F.col("f.path"))
    ts = _ts(load_ts)
    return g.select(
        fn.doc_key("partner", "offer_id").alias("_id"),
        "partner", "offer_id",
        F.col("f.name").alias("name"),
        F.col("f.type").alias("type"),
        F.struct(F.col("f.category_id").alias("id"),
                 fn.last_or_null(parts).alias("name"),
                 fn.join_path(parts).alias("full_path"),
                 fn.breadcrumbs(parts).alias("breadcrumbs")).alias("category"),
        ts.alias("updated_at"),
        ts.alias("created_at"),
    )


def rejected_rows(src: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Source rows that one of the document builds has no key for (G16), with
    the reason: ``category`` (E9), ``offer`` (E10) or ``category,offer``."""
    n = normalized(src, keep)
    reason = F.concat_ws(",", F.when(F.col("category_id").isNull(), "category"), F.when(F.col("offer_id").isNull(), "offer"))
    return n.withColumn("reason", reason).where(F.col("reason") != "")


def write_rejected(src: DataFrame, path: str) -> None:
    """The reject output beside a load: one Parquet folder, readable like any other."""
    rejected_rows(src).write.mode("overwrite").parquet(path)


# ---------------------------------------------------------------- flat views
def categories_flat(cats: DataFrame) -> DataFrame:
    """Categories with nested fields flattened (arrays joined with ``|``)."""
    return cats.select("_id", "partner", "category_id", "name", "path",
                       F.array_join("path_array", "|").alias("path_parts"), "level", "parent_path",
                       F.col("metadata.total_products").alias("total_products"),
                       F.col("metadata.last_updated").alias("last_updated"))


def products_flat(prods: DataFrame) -> DataFrame:
    return prods.select(
        "_id", "partner", "offer_id", "name", "type",
        F.col("category.id").alias("category_id"),
        F.col("category.name").alias("category_name"),
        F.col("category.full_path").alias("full_path"),
        F.array_join(F.transform("category.breadcrumbs",
                                 lambda b: F.concat(b["level"].cast("string"), F.lit(":"), b["name"])),
                     "|").alias("breadcrumbs"),
        "updated_at", "created_at")


def products_json(prods: DataFrame) -> DataFrame:
    """Each product as JSON text with ISO timestamps."""
    d = prods.select("_id", "partner", "offer_id", "name", "type", "category",
                     iso_text(F.col("updated_at")).alias("updated_at"),
                     iso_text(F.col("created_at")).alias("created_at"))
    return to_json_documents(d, ["_id", "partner", "offer_id", "name", "type", "category",
                                 "updated_at", "created_at"])


def categories_json(cats: DataFrame) -> DataFrame:
    """Each category as JSON text with ISO timestamps."""
    d = cats.withColumn("metadata", F.struct(F.col("metadata.total_products").alias("total_products"),
                                             iso_text(F.col("metadata.last_updated")).alias("last_updated")))
    return to_json_documents(d, ["_id", "partner", "category_id", "name", "path", "path_array", "level",
                                 "parent_path", "metadata"])


# ---------------------------------------------------------------- persisted collections
# A collection is one Parquet table partitioned by a hash prefix of ``_id``.
# Its number of prefixes is fixed when it is made.
PREFIXES = 256


def _with_prefix(df: DataFrame, prefixes: int) -> DataFrame:
    return df.withColumn("prefix", F.pmod(F.xxhash64("_id"), F.lit(prefixes)).cast("int"))


def read_collection(spark: SparkSession, root: str) -> DataFrame:
    """The stored documents of a collection."""
    return spark.read.parquet(f"{root}/docs").drop("prefix")


def _apply_staged(spark: SparkSession, root: str) -> None:
    """Put the staged partitions in place and forget the stage; a repeat does the same again."""
    staged = spark.read.parquet(f"{root}/staged")
    (staged.hint("rebalance", "prefix").sortWithinPartitions("prefix", "_id").write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("prefix").parquet(f"{root}/docs"))
    remove(spark, f"{root}/staged/_SUCCESS")  # first, so that half a stage is never taken for a whole one
    remove(spark, f"{root}/staged")


def upsert_collection(spark: SparkSession, root: str, new_docs: DataFrame, kind: str, prefixes: int = PREFIXES) -> None:
    """Apply a load to a stored document collection (E7 for ``categories``:
    whole documents replaced; E8 for ``products``: ``created_at`` kept).

    Only the prefixes that the load touches are read, joined and replaced, so a
    load costs what it holds, not what the collection holds.  The merged
    partitions are staged first; a run that dies before its stage is complete
    changes nothing, and one that dies later is finished by the next call
    before it goes on.  One writer per collection at a time.
    """
    if exists(spark, f"{root}/staged/_SUCCESS"):
        _apply_staged(spark, root)
    if not exists(spark, f"{root}/docs"):
        _with_prefix(new_docs, prefixes).write.mode("overwrite").parquet(f"{root}/staged")
        return _apply_staged(spark, root)
    _with_prefix(new_docs, prefixes).write.mode("overwrite").parquet(f"{root}/load")  # read twice below
    new = spark.read.parquet(f"{root}/load")
    touched = [r.prefix for r in new.select("prefix").distinct().collect()]  # at most ``prefixes`` numbers
    old = spark.read.parquet(f"{root}/docs").where(F.col("prefix").isin(touched))
    keep = () if kind == "categories" else ("created_at",)
    merged = upsert_set_on_insert(old.drop("prefix"), new.drop("prefix"), "_id", keep)
    _with_prefix(merged, prefixes).write.mode("overwrite").parquet(f"{root}/staged")
    _apply_staged(spark, root)
