"""A key holding a third of all rows: results stay exact and the plans
combine map-side before any shuffle on that key."""

import datetime as dt
import re

from pyspark.sql import functions as F

from vitrine.operators import relational as rel
from vitrine.operators.series import counter_increase
from vitrine.plans import aggregates as agg
from vitrine.plans import catalog as cat


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_inputs(spark, n=30000):
    offers = spark.range(0, 300).select(F.col("id").alias("offer_id"), F.lit(1.0).alias("price"),
                                        (F.col("id") % 10).alias("seller_id"),
                                        F.when(F.col("id") < 100, F.lit(7)).otherwise(F.col("id") % 40)
                                         .cast("bigint").alias("category_id"),
                                        F.when(F.col("id") < 100, F.lit("hot")).otherwise(F.concat(F.lit("v"),
                                               (F.col("id") % 13).cast("string"))).alias("vendor"))
    # One offer (id 5) receives a third of all events.
    events = spark.range(0, n).select(
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), (F.col("id") % 48).cast("int"))).alias("Hour"),
        F.lit("phone").alias("DeviceTypeName"), F.lit("a").alias("ApplicationName"),
        F.lit("o").alias("OSName"), F.lit("p").alias("ProvinceName"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 250).cast("bigint").alias("ContentUnitID"))
    return offers, events


def test_hot_offer_daily_counts_exact_and_combined(spark):
    offers, events = _hot_inputs(spark)
    got = agg.offer_events_daily(events, offers)
    naive = (events.join(offers, events.ContentUnitID == offers.offer_id)
                   .groupBy(F.to_date("Hour").alias("event_date"), "offer_id", "category_id", "vendor")
                   .agg(F.count(F.lit(1)).alias("events_cnt")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))
    # The events are counted per (day, offer) right below the shuffle on
    # the offer id, so the hot offer crosses it as one row per day and task.
    assert re.search(r"Exchange hashpartitioning\([^\n]*ContentUnitID[^\n]*\n[^\n]*partial_count", _plan(got))


def test_hot_keys_in_anti_join_and_counts(spark):
    offers, events = _hot_inputs(spark)
    without = cat.offers_without_events(offers, events)
    assert without.count() == 300 - 250
    assert re.search(r"Exchange hashpartitioning\([^\n]*\n[^\n]*HashAggregate\(keys=\[__k", _plan(without))
    top = cat.top_categories(offers, 1).first()
    assert (top.category_id, top.offers_cnt) == (7, 100 + len([i for i in range(100, 300) if i % 40 == 7]))
    brands = {r.vendor: r.offers_cnt for r in cat.top_brands(offers, 30).collect()}
    assert brands["hot"] == 100


def test_pick_per_key_hot_key_is_combined_map_side(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97)
                                       .alias("k"), F.col("id").alias("version"), (F.col("id") * 7).alias("v"))
    got = rel.pick_per_key(df, ["k"], ["version"], latest=True)
    want = df.groupBy("k").agg(F.max("version").alias("version"))
    assert sorted(tuple(r) for r in got.select("k", "version").collect()) == \
           sorted(tuple(r) for r in want.collect())
    plan = _plan(got)
    assert plan.count("max(") >= 2          # partial and final aggregate around the exchange


def test_hot_series_rate_spreads_over_buckets(spark):
    # A single series holding every sample: the work is split into slices of about equally many rows.
    from vitrine.functions.columns import epoch_micros
    from vitrine.operators.series import with_buckets
    base = dt.datetime(2024, 1, 1)
    rows = [("m", "only", base + dt.timedelta(minutes=5 * i), float(i % 400)) for i in range(4000)]
    s = spark.createDataFrame(rows, "metric string, label string, ts timestamp_ntz, value double")
    out = counter_increase(s, ["metric", "label"], "ts", "value", 3600, bucket_rows=100)
    assert out.count() == 4000 - 1
    t = s.withColumn("__t", epoch_micros("ts"))
    cut = with_buckets(t, t.withColumn("at", F.col("__t")), ["metric", "label"], "at", {"b": F.col("__t")}, 100)
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert len(sizes) >= 40 and max(sizes) <= 200


def test_hot_offer_is_spread_over_files(spark):
    # An offer with a third of the rows: a rebalanced load cuts it by size.
    import tempfile
    path = tempfile.mkdtemp(prefix="vitrine-hot-") + "/t"
    df = spark.range(0, 600_000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 997).alias("offer_id"),
                                        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        df.hint("rebalance").sortWithinPartitions("offer_id", "payload").write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    per = spark.read.parquet(path).where("offer_id = 5").groupBy(F.input_file_name()).count().collect()
    assert len(per) > 4 and max(r["count"] for r in per) < 100_000


def test_hot_category_documents_exact(spark):
    """One (partner, category) holds a third of the source rows."""
    from vitrine.plans import documents as docs
    n = 9000
    src = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(" Hot Partner")).otherwise(F.concat(F.lit("p"), (F.col("id") % 7)
                                                                      .cast("string"))).alias("Partner_Name"),
        F.when(F.col("id") % 3 == 0, F.lit("c0")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50)
                                                            .cast("string"))).alias("Category_ID"),
        F.when(F.col("id") % 3 == 0, F.lit("A\\\\B")).otherwise(F.lit("X")).alias("Category_FullPathName"),
        (F.col("id") % 400).cast("string").alias("Offer_ID"), F.lit("n").alias("Offer_Name"),
        F.lit("t").alias("Offer_Type"), F.col("id").alias("ord"))
    cats = docs.categories_docs(src, ["ord"], dt.datetime(2025, 1, 1))
    hot = cats.where(F.col("_id") == "_hot_partner_c0").first()
    assert hot.metadata.total_products == n // 3 and hot.path == "A/B"
    assert re.search(r"Exchange hashpartitioning\([^\n]*partner#[^\n]*\n[^\n]*partial_", _plan(cats))
    prods = docs.products_docs(src, ["ord"], dt.datetime(2025, 1, 1))
    assert prods.count() == src.select("Partner_Name", "Offer_ID").distinct().count()


def test_scans_prune_columns_and_push_filters(spark):
    from paths import SF01
    from vitrine.plans.registry import QUERIES
    plan = _plan(QUERIES["top_categories_raw"](spark, SF01))
    assert "ReadSchema: struct<p_size:int>" in plan
    plan = _plan(QUERIES["offers_without_events_raw"](spark, SF01))
    assert "ReadSchema: struct<user_id:bigint>" in plan and "PushedFilters: [IsNotNull(user_id)]" in plan
    plan = _plan(QUERIES["events_by_device"](spark, SF01))
    assert "ReadSchema: struct<event_type:string>" in plan


def test_hot_parent_is_spread_over_tasks(spark):
    """One path is the parent of most categories: its children are dealt into salts, on both sides."""
    from vitrine.plans import hierarchy as hi
    n = 6000
    kids = [(f"k{i}", f"root/{i}", "root") for i in range(n)]
    rows = [("r1", "root", None), ("r2", "root", None), ("leaf", "alone", None), ("nopath", None, None), ("x", "other", None), ("y", "other/1", "other"), *kids]
    cats = spark.createDataFrame(rows, "_id string, path string, parent_path string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold")
           if spark.conf.get(k, None) is not None}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = hi.category_children(cats, children_per_salt=300).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.set(k, old[k]) if k in old else spark.conf.unset(k)
    pairs = sorted(((r.parent_id, r.child_id) for r in got), key=repr)
    want = [(p, f"k{i}") for p in ("r1", "r2") for i in range(n)] + [("x", "y")] + [(i, None) for i in ("leaf", "nopath", "y", *(k for k, _, _ in kids))]
    assert pairs == sorted(want, key=repr)
    tasks = {}
    for r in got:
        if r.parent_id == "r1":
            tasks[r.task] = tasks.get(r.task, 0) + 1
    assert len(tasks) >= 6 and max(tasks.values()) < n / 3
