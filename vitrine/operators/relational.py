"""Relational building blocks shared by the plans.

All of them are compositions of DataFrame operators.  The design rules:

* aggregations run as partial + final (map-side combine), so a key that
  holds a third of the rows is collapsed before the shuffle;
* per-key "pick one row" steps (latest version, first in file order) are
  aggregates (``max`` / ``min`` of a row struct led by the order keys), not
  windows, for
  the same reason: a window sends every row of a hot key to one task;
* per-group top-k uses ``row_number`` with a ``<= k`` filter, which Spark
  plans as a partial ``WindowGroupLimit`` before the shuffle, so each map
  task forwards at most k rows per group;
* anti-joins compare against the de-duplicated key list only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# ---------------------------------------------------------------- sort/limit
def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Sort and keep k rows (F1).  Callers put the group key last in
    ``order`` so ties at the limit are resolved the same way every run
    (planned as ``TakeOrderedAndProject``: a bounded heap per task)."""
    return df.orderBy(*_cols(order)).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first k rows of every group in one pass."""
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def count_by(df: DataFrame, keys: Sequence, name: str = "cnt") -> DataFrame:
    """Rows per key; null keys form their own group."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


# ---------------------------------------------------------------- joins
def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key never occurs in ``right``.

    The right side is reduced to its distinct keys first: the partial
    aggregate removes repeats (a hot key becomes one row per map task)
    before anything is shuffled, and its output partitioning is reused by
    the sort-merge anti-join.  The planner may still broadcast the key list
    when its measured size is under the broadcast threshold.
    """
    right_key = right_key or left_key
    keys = right.select(F.col(right_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return left.join(keys, left[left_key] == keys["__k"], "left_anti")


# ---------------------------------------------------------------- de-dup
def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = True) -> DataFrame:
    """One row per key: the one with the largest (``latest``) or smallest
    ``order`` tuple (E1, E2).

    Expressed as ``max`` / ``min`` of a struct that starts with the order
    columns and carries the rest of the row, so the choice is combined
    map-side and a key with many versions is reduced before it is shuffled.
    Rows that tie on ``order`` are told apart by the remaining columns, so
    the pick is deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    payload = [c for c in rest if c not in order]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])
    chooser = F.max if latest else F.min
    picked = df.groupBy(*keys).agg(chooser(row).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


# ---------------------------------------------------------------- merges
def merge_partial_sums(parts: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Merge of partial aggregates by key (E3): union then re-sum."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(*keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


def upsert_replace(old: DataFrame, new: DataFrame, key: str = "_id") -> DataFrame:
    """Whole-row replace by key (E7): rows of ``new`` win, untouched old rows
    stay.  One full outer join on the unique key; ``new`` is read once."""
    return upsert_set_on_insert(old, new, key, ())


def upsert_set_on_insert(old: DataFrame, new: DataFrame, key: str = "_id",
                         insert_only: Sequence[str] = ("created_at",)) -> DataFrame:
    """Upsert with set and set-on-insert.

    For a key present in ``new`` every column comes from ``new`` except the
    ``insert_only`` ones, which keep the old value when the key existed.
    Keys only in ``old`` keep their old row.  One full outer join on the
    unique key; no row is duplicated.
    """
    o = old.alias("o")
    n = new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    has_new = F.col(f"n.{key}").isNotNull()
    out = []
    for c in new.columns:
        if c == key:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        elif c in insert_only:
            out.append(F.when(F.col(f"o.{key}").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            out.append(F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return j.select(*out)
