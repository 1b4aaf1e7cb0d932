"""Questions over the category tree and the product documents
(B2, B5, B7-B11, B13, C7, C8, D17-D25, F4-F8, G13, G15, G18, G19).

The tree is a materialised path: a category's children are the documents
whose ``parent_path`` equals its ``path``, across partners (C7 note).
Joins against the child side always go through a per-``parent_path``
aggregate, so a parent with millions of children is one row by the time it
is shuffled; nothing is collected into arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.columns import element_or_null, round_half_even
from vitrine.operators.relational import count_by, top_k, top_k_per_group

def _total():
    return F.col("metadata.total_products")


# ---------------------------------------------------------------- categories
def categories_by_level(cats: DataFrame) -> DataFrame:
    """Categories per level, ascending."""
    return count_by(cats, ["level"], "categories_cnt").orderBy("level")


def categories_by_partner_level(cats: DataFrame) -> DataFrame:
    """Categories and their product sum per (partner, level)."""
    return (cats.groupBy("partner", "level")
                .agg(F.count(F.lit(1)).alias("categories_cnt"),
                     F.sum(_total()).cast("bigint").alias("products_sum"))
                .orderBy("partner", "level"))


def category_depth(cats: DataFrame) -> DataFrame:
    """Mean level (2 decimals, halves to even on the exact value) and max level; no row on empty input."""
    return (cats.agg(round_half_even(F.avg("level"), 2).alias("avg_level"), F.max("level").alias("max_level"))
                .where(F.col("max_level").isNotNull()))


def categories_filter(cats: DataFrame, level: int, partner: str) -> DataFrame:
    """B5 (+B2, B14): documents at a level for a partner, nested field
    projected under a flat name."""
    return (cats.where((F.col("level") == level) & (F.col("partner") == partner))
                .select("_id", "name", _total().alias("total_products"), "path"))


def categories_containing(cats: DataFrame, part: str) -> DataFrame:
    """Documents whose path holds ``part`` as one of its elements."""
    return cats.where(F.array_contains("path_array", part)).select("_id", "name", "level", "path")


def top_categories_by_products(cats: DataFrame, k: int = 10) -> DataFrame:
    """F8: top k documents by the nested product total."""
    d = cats.select("_id", "name", "path", _total().alias("total_products"))
    return top_k(d, [F.desc("total_products"), F.asc("_id")], k)


def largest_at_levels(cats: DataFrame, levels: Sequence[int] = (1, 4)) -> DataFrame:
    """the category with most products at each given level."""
    d = cats.where(F.col("level").isin(list(levels))).select("level", "_id", "name", "path",
                                                             _total().alias("total_products"))
    return top_k_per_group(d, ["level"], [F.desc("total_products"), F.asc("_id")], 1).drop("rank")


def deepest_category(cats: DataFrame) -> DataFrame:
    """deepest level first, then most products."""
    d = cats.select("_id", "name", "path", "level", _total().alias("total_products"))
    return top_k(d, [F.desc("level"), F.desc("total_products"), F.asc("_id")], 1)


def _children(cats: DataFrame) -> DataFrame:
    return (cats.where(F.col("parent_path").isNotNull())
                .groupBy(F.col("parent_path").alias("__parent"))
                .agg(F.count(F.lit(1)).alias("children_cnt")))


def leaf_categories(cats: DataFrame, k: int = 10) -> DataFrame:
    """C7 (+B10): categories no document names as parent, top k by products."""
    kids = _children(cats).select("__parent")
    leaves = cats.join(kids, cats.path == kids.__parent, "left_anti")
    d = leaves.select("_id", "partner", "level", "path", _total().alias("total_products"))
    return top_k(d, [F.desc("total_products"), F.asc("_id")], k)


def children_per_category(cats: DataFrame) -> DataFrame:
    """Every category with the number of documents below it (the child
    list of the lookup, counted instead of collected; 0 = leaf)."""
    kids = _children(cats)
    j = cats.select("_id", "path").join(kids, F.col("path") == F.col("__parent"), "left")
    return j.select("_id", "path", F.coalesce(F.col("children_cnt"), F.lit(0)).alias("children_cnt"))


CHILDREN_PER_SALT = 1 << 20


def category_children(cats: DataFrame, children_per_salt: int = CHILDREN_PER_SALT) -> DataFrame:
    """The lookup's pairs, a row per (parent ``_id``, child ``_id``); a leaf
    has one row without a child.

    Joined on the path, never collected.  A left join cannot split a hot key of
    its right side, so both sides are salted: children are counted per path,
    and those of a path with more than ``children_per_salt`` are dealt by a hash
    of their id into as many salts as that takes, to each of which the parent's
    row is replicated.  Only such paths (one per ``children_per_salt`` rows at
    most) meet the children in the join that tells them their salts.
    """
    kids = cats.select(F.col("_id").alias("child_id"), F.col("parent_path").alias("__parent")).where(F.col("__parent").isNotNull())
    salts = F.ceil(F.col("__n") / F.lit(children_per_salt)).cast("int")
    counts = kids.groupBy("__parent").agg(F.count(F.lit(1)).alias("__n")).withColumn("__salts", salts)
    hot = counts.where(F.col("__salts") > 1).select(F.col("__parent").alias("__hot"), "__salts")
    dealt = (kids.join(hot, F.col("__parent") == F.col("__hot"), "left")
                 .withColumn("__salt", F.pmod(F.xxhash64("child_id"), F.coalesce("__salts", F.lit(1))).cast("int")).select("child_id", "__parent", "__salt"))
    parents = (cats.select(F.col("_id").alias("parent_id"), "path")
                   .join(counts.select(F.col("__parent").alias("__counted"), "__salts"), F.col("path") == F.col("__counted"), "left")
                   .withColumn("__of", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))))
    pairs = parents.join(dealt, (F.col("path") == F.col("__parent")) & (F.col("__of") == F.col("__salt")), "left")
    return pairs.where(F.col("child_id").isNotNull() | F.col("__salts").isNull()).select("parent_id", "child_id")


def first_categories(cats: DataFrame, level: int, partner: str, n: int = 3) -> DataFrame:
    """the first n categories at a level of a partner, by key."""
    return top_k(categories_filter(cats, level, partner), [F.asc("_id")], n)


# ---------------------------------------------------------------- products
def _crumbs(prods: DataFrame) -> DataFrame:
    """One row per breadcrumb; documents without any vanish."""
    return prods.select(F.explode("category.breadcrumbs").alias("bc")) \
                .select(F.col("bc.level").alias("level"), F.col("bc.name").alias("name"))


def products_in_branch(prods: DataFrame, type_: str, branch: str) -> DataFrame:
    """Products of a type with ``branch`` anywhere in their breadcrumbs."""
    return (prods.where((F.col("type") == type_) & F.array_contains("category.breadcrumbs.name", branch))
                 .select("_id", "name", F.col("category.full_path").alias("full_path")))


def products_deeper_than(prods: DataFrame, levels: int = 3) -> DataFrame:
    """Products whose breadcrumb at position ``levels`` exists."""
    return (prods.where(F.size("category.breadcrumbs") > levels)
                 .select("_id", "name", F.size("category.breadcrumbs").alias("depth")))


def product_sample(prods: DataFrame, levels: int = 3) -> DataFrame:
    """B13 (+F4): one product deeper than ``levels`` if any, else any one;
    the smallest id wins so the sample is repeatable."""
    d = prods.select("_id", "name", F.size("category.breadcrumbs").alias("depth"))
    return top_k(d, [(F.col("depth") > levels).desc(), F.asc("_id")], 1)


def products_by_type(prods: DataFrame, k: int = 5) -> DataFrame:
    """D18."""
    return top_k(count_by(prods, ["type"], "cnt"), [F.desc("cnt"), F.asc("type")], k)


def products_by_partner(prods: DataFrame) -> DataFrame:
    """D19."""
    return count_by(prods, ["partner"], "cnt").orderBy(F.desc("cnt"), F.asc("partner"))


def products_by_root(prods: DataFrame) -> DataFrame:
    """Products per first breadcrumb; no breadcrumb is one null group."""
    root = element_or_null("category.breadcrumbs", 0)["name"]
    return count_by(prods, [root.alias("root_category")], "products_cnt") \
        .orderBy(F.desc("products_cnt"), F.asc_nulls_first("root_category"))


def top_product_categories(prods: DataFrame, k: int = 10) -> DataFrame:
    """Products per category id with a representative name and path
    (that of the smallest document id: a deterministic ``$first``).

    The top k are found by counting ids alone; representatives are then
    picked among the products of those k ids only."""
    d = prods.select("_id", F.col("category.id").alias("category_id"), F.col("category.name").alias("name"),
                     F.col("category.full_path").alias("full_path"))
    top = top_k(count_by(d, ["category_id"], "count"), [F.desc("count"), F.asc("category_id")], k)
    top = top.select(F.col("category_id").alias("__id"), "count")
    rep = (d.join(F.broadcast(top), d["category_id"].eqNullSafe(top["__id"]))      # k rows
            .groupBy("category_id", "count").agg(F.min_by(F.struct("name", "full_path"), "_id").alias("__rep")))
    return top_k(rep.select("category_id", F.col("__rep.name").alias("name"), F.col("__rep.full_path").alias("full_path"), "count"),
                 [F.desc("count"), F.asc("category_id")], k)


def level_name_stats(prods: DataFrame, k: int = 30) -> DataFrame:
    """Products per (level, name) over exploded breadcrumbs."""
    return top_k(count_by(_crumbs(prods), ["level", "name"], "cnt"),
                 [F.asc("level"), F.desc("cnt"), F.asc("name")], k)


def busiest_level(prods: DataFrame) -> DataFrame:
    """The breadcrumb level held by most products."""
    return top_k(count_by(_crumbs(prods), ["level"], "cnt"), [F.desc("cnt"), F.asc("level")], 1)


def top_names_per_level(prods: DataFrame, levels: Sequence[int] = (1, 2, 3), k: int = 3) -> DataFrame:
    """F7 (+B11): top k names at each level, one pass over all levels."""
    c = _crumbs(prods).where(F.col("level").isin(list(levels)))
    return top_k_per_group(count_by(c, ["level", "name"], "cnt"), ["level"],
                           [F.desc("cnt"), F.asc("name")], k)
