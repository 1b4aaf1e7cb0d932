"""Sources, sinks and stream replays."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from harness import compare, duck
from paths import SF001
from vitrine.plans import documents as docs
from vitrine.plans.oracle_sql import ORACLE
from vitrine.plans.registry import QUERIES
from vitrine.sources import fixtures as fx
from vitrine.sources import tables as tb
from vitrine.streaming import incremental as inc


def test_ecom_namespace_default_and_partitions(spark):
    loc = tempfile.mkdtemp(prefix="vitrine-db-")
    tb.create_ecom_tables(spark, "ecom_t", loc)
    tb.insert_offers(spark, fx.offers(spark, SF001), "ecom_t")
    tb.insert_raw_events(spark, fx.raw_events(spark, SF001), "ecom_t")
    r = spark.sql("SELECT count(*) AS n, min(snapshot_date) AS d, min(snapshot_month) AS m "
                  "FROM ecom_t.ecom_offers").first()
    today = dt.date.today()
    assert r.n == 200 and r.d == today and r.m == today.year * 100 + today.month
    days = spark.sql("SELECT count(DISTINCT event_date) AS n FROM ecom_t.raw_events").first().n
    assert days > 1
    spark.sql("DROP DATABASE ecom_t CASCADE")


def test_csv_header_rows_filtered_and_bad_numbers_raise(spark):
    path = tempfile.mkdtemp(prefix="vitrine-csv-") + "/offers"
    tb.write_offers_csv(fx.offers(spark, SF001).repartition(3), path)
    back = tb.read_offers_csv(spark, path)
    assert back.count() == 200                                  # three header lines removed
    bad = tempfile.mkdtemp(prefix="vitrine-csv-") + "/bad.csv"
    with open(bad, "w") as f:
        f.write("0,offer_id,price,seller_id,category_id,vendor\n0,12x,1.0,1,1,v\n")
    with pytest.raises(Exception):
        tb.read_offers_csv(spark, bad).collect()


def test_csv_quotes_empty_text_and_missing_ids(spark):
    path = tempfile.mkdtemp(prefix="vitrine-csv-") + "/q.csv"
    with open(path, "w") as f:
        f.write('0,offer_id,price,seller_id,category_id,vendor\n0,1,1.0,1,1,"Acme ""X"", Ltd"\n0,2,1.0,1,1,""\n0,3,1.0,1,1,"two\nlines"\n')
    got = {r.offer_id: r.vendor for r in tb.read_offers_csv(spark, path).collect()}
    assert got == {1: 'Acme "X", Ltd', 2: "", 3: "two\nlines"}
    empty = tempfile.mkdtemp(prefix="vitrine-csv-") + "/e.csv"
    with open(empty, "w") as f:
        f.write("0,,1.0,1,1,v\n")
    with pytest.raises(Exception):                                  # an empty id is no number
        tb.read_offers_csv(spark, empty).collect()
    odd = spark.createDataFrame([(7, 2.5, 1, 1, 'a "b", c'), (8, 2.5, 1, 1, "")], "offer_id long, price double, seller_id long, category_id long, vendor string")
    out = tempfile.mkdtemp(prefix="vitrine-csv-") + "/o"
    tb.write_offers_csv(odd, out)
    assert sorted(map(tuple, tb.read_offers_csv(spark, out).collect())) == sorted(map(tuple, odd.collect()))


def test_json_documents_round_trip(spark):
    prods = docs.products_docs(fx.catalog_src(spark, SF001), fx.CATALOG_ROW_ORDER, dt.datetime(2025, 1, 1))
    js = docs.products_json(prods).orderBy("_id").limit(5).collect()
    flat = docs.products_flat(prods).orderBy("_id").limit(5).collect()
    for j, f in zip(js, flat):
        d = json.loads(j.doc_json)
        assert d["_id"] == f._id and d["category"]["full_path"] == f.full_path
        assert d["updated_at"] == "2025-01-01T00:00:00"
        assert [b["level"] for b in d["category"]["breadcrumbs"]] == list(range(1, len(d["category"]["breadcrumbs"]) + 1))


def test_delta_replay_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="vitrine-delta-") + "/d"
    delta = spark.createDataFrame([(1, 2), (2, 3)], "k int, n long")
    inc.write_delta(delta, path, 0)
    inc.write_delta(delta, path, 0)          # the same micro-batch again
    inc.write_delta(delta, path, 1)
    out = inc.read_deltas(spark, path, ["k"], "n", delta)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 4), (2, 6)]


def test_stream_rerun_changes_nothing(spark):
    first = sorted(tuple(r) for r in QUERIES["stream_category_counts"](spark, SF001).collect())
    again = sorted(tuple(r) for r in QUERIES["stream_category_counts"](spark, SF001).collect())
    batch = sorted(tuple(r) for r in QUERIES["top_categories_raw"](spark, SF001).collect())
    assert first == again
    assert sum(n for _, n in first) == 200
    assert set(batch) <= set(first)


def test_stream_rate_windows_are_closed(spark):
    out = QUERIES["stream_counter_rate"](spark, SF001)
    last = fx.metric_samples(spark, SF001).agg(F.max("ts")).first()[0]
    assert out.count() > 0
    assert out.agg(F.max("window_end")).first()[0] <= last - dt.timedelta(hours=1)


def test_pre_aggregates_equal_raw_forms(spark):
    """Every pre-aggregate form against the raw form, also when a store repeats keys."""
    from vitrine.plans import aggregates as agg
    from vitrine.plans import catalog as cat
    from vitrine.plans import sql_surface as sqls
    offers, events = fx.offers(spark, SF001), fx.raw_events(spark, SF001)
    daily = agg.offer_events_daily(events, offers)
    halves = [offers.where("offer_id % 2 = 0"), offers.where("offer_id % 2 = 1")]
    cats, brands = (build(halves[0]).unionByName(build(halves[1])) for build in (agg.category_counts, agg.brand_counts))
    pairs = [(cat.top_categories(offers), cat.top_categories_mv(cats)), (cat.top_brands(offers), cat.top_brands_mv(brands)),
             (cat.avg_offers_per_brand(offers), cat.avg_offers_per_brand_mv(brands)),
             (cat.offers_without_events(offers, events), cat.offers_without_events_mv(offers, daily)),
             (cat.offers_without_events_count(offers, daily), sqls.panel_offers_without_events(spark, SF001)),
             (cat.coverage_rows(offers, daily).drop("coverage_ratio"), sqls.panel_coverage(spark, SF001).drop("coverage_ratio"))]
    for raw, mv in pairs:
        assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, mv.collect()))
    sqls.register_ecom_views(spark, SF001)
    assert spark.sql("SELECT count(*) FROM ecom_offers").first()[0] == 200
    spark.catalog.dropTempView("ecom_offers")
    sqls.register_ecom_views(spark, SF001)
    assert spark.sql("SELECT count(*) FROM ecom_offers").first()[0] == 200


def _files_of(spark, root):
    return {r.f: r.prefix for r in spark.read.parquet(f"{root}/docs").select(F.input_file_name().alias("f"), "prefix").distinct().collect()}


def test_stored_collections_upsert(spark):
    root = tempfile.mkdtemp(prefix="vitrine-coll-")
    src = fx.catalog_src(spark, SF001)
    first = src.where(F.col("load_date") < F.lit("1998-01-01").cast("date"))
    second = src.where(F.col("load_date") >= F.lit("1997-01-01").cast("date"))
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    for kind, build, flat in (("products", docs.products_docs, docs.products_flat), ("categories", docs.categories_docs, docs.categories_flat)):
        stored = lambda: sorted(map(tuple, flat(docs.read_collection(spark, f"{root}/{kind}")).collect()))  # noqa: B023, E731
        want = sorted(map(tuple, QUERIES[f"{kind}_upsert"](spark, SF001).collect()))
        docs.upsert_collection(spark, f"{root}/{kind}", build(first, fx.CATALOG_ROW_ORDER, t1), kind, prefixes=8)
        for _ in range(2):  # the same load again changes nothing
            docs.upsert_collection(spark, f"{root}/{kind}", build(second, fx.CATALOG_ROW_ORDER, t2), kind, prefixes=8)
            assert stored() == want


def test_upsert_touches_its_prefixes_only(spark):
    root = tempfile.mkdtemp(prefix="vitrine-prefix-") + "/c"
    schema = "_id string, v int"
    docs.upsert_collection(spark, root, spark.createDataFrame([(f"d{i}", 1) for i in range(200)], schema), "categories", prefixes=16)
    before = _files_of(spark, root)
    assert set(before.values()) == set(range(16))
    load = spark.createDataFrame([("d7", 2), ("new", 2)], schema)
    docs.upsert_collection(spark, root, load, "categories", prefixes=16)
    after, touched = _files_of(spark, root), {r.prefix for r in docs._with_prefix(load, 16).collect()}
    assert {f for f, p in before.items() if p not in touched} == {f for f, p in after.items() if p not in touched}
    assert not {f for f, p in after.items() if p in touched} & set(before)
    got = {r._id: r.v for r in docs.read_collection(spark, root).collect()}
    assert len(got) == 201 and got["d7"] == got["new"] == 2 and sum(got.values()) == 203


def test_upsert_that_dies_is_finished(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="vitrine-dies-") + "/c"
    schema = "_id string, v int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    docs.upsert_collection(spark, root, frame([("a", 1), ("b", 1)]), "categories", prefixes=4)
    with monkeypatch.context() as m:
        m.setattr(docs, "_apply_staged", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            docs.upsert_collection(spark, root, frame([("b", 2)]), "categories", prefixes=4)
    assert {r._id: r.v for r in docs.read_collection(spark, root).collect()} == {"a": 1, "b": 1}
    docs.upsert_collection(spark, root, frame([("c", 3)]), "categories", prefixes=4)
    assert {r._id: r.v for r in docs.read_collection(spark, root).collect()} == {"a": 1, "b": 2, "c": 3}


def test_json_sink_writes_one_document_per_line(spark):
    path = tempfile.mkdtemp(prefix="vitrine-json-") + "/products"
    prods = docs.products_docs(fx.catalog_src(spark, SF001), fx.CATALOG_ROW_ORDER, dt.datetime(2025, 1, 1))
    tb.write_json_documents(docs.products_json(prods), path)
    back = spark.read.json(path)
    assert back.count() == prods.count()
    assert back.select(F.max(F.size("category.breadcrumbs"))).first()[0] == 4


def test_write_once_first_finished_build_wins(spark):
    from vitrine.sources.store import write_once
    path = tempfile.mkdtemp(prefix="vitrine-once-") + "/t"
    write = lambda v: lambda p: spark.createDataFrame([(v,)], "v int").write.parquet(p)

    def raced(p):                                  # another writer finishes while this one writes
        write(2)(f"{path}/build-other")
        write(1)(p)

    chosen = write_once(spark, path, raced)
    assert [r.v for r in spark.read.parquet(chosen).collect()] == [2]
    assert write_once(spark, path, write(3)) == chosen


def test_appended_files_are_seen_at_the_next_call(spark):
    src_dir = tempfile.mkdtemp(prefix="vitrine-append-")
    part = spark.read.parquet(f"{SF001}/part.parquet")
    part.where("p_partkey <= 100").write.parquet(f"{src_dir}/part.parquet")
    count = lambda: sum(r.offers_cnt for r in QUERIES["top_categories_mv"](spark, src_dir).collect())
    first, top = fx.offers(spark, src_dir).count(), count()
    part.where("p_partkey > 100").write.mode("append").parquet(f"{src_dir}/part.parquet")
    assert (first, fx.offers(spark, src_dir).count()) == (101, 200) and count() > top


def test_local_disk_is_refused_on_a_cluster(spark, monkeypatch):
    from vitrine import session
    monkeypatch.setattr(session, "_one_machine", lambda s: False)
    with pytest.raises(RuntimeError):
        session.store_root(spark)


@pytest.mark.parametrize("name", ["avg_offers_per_brand_mv", "csv_load", "ecom_offers_table"])
def test_file_checkpoint_folder_holds_the_store_on_a_cluster(spark, monkeypatch, name):
    """``spark.checkpoint.dir`` is shared by Spark's own rule, as a mount too."""
    from vitrine import session
    want, held = sorted(QUERIES[name](spark, SF001).collect()), spark.conf.get(session.STORE_CONF)
    monkeypatch.setattr(session, "_one_machine", lambda s: False)
    spark.conf.unset(session.STORE_CONF)
    try:
        assert session.store_root(spark) == spark.conf.get("spark.checkpoint.dir") + "/vitrine-store"
        assert sorted(QUERIES[name](spark, SF001).collect()) == want and want
    finally:
        spark.conf.set(session.STORE_CONF, held)


# A query for each table of the store that findings F2 to F23 name.
@pytest.mark.parametrize("name", ["busiest_level", "categories_by_level", "categories_docs_gaps", "counter_rate", "coverage_rows",
                                  "csv_load", "documents_json", "ecom_offers_table", "gauge_scaled"])
def test_stored_tables_are_right_in_a_file_checkpoint_folder_on_a_cluster(spark, monkeypatch, name):
    from vitrine import session
    held = spark.conf.get(session.STORE_CONF)
    monkeypatch.setattr(session, "_one_machine", lambda s: False)
    spark.conf.unset(session.STORE_CONF)
    try:
        problems, n = compare(QUERIES[name](spark, SF001), duck(SF001), ORACLE[name])
        assert not problems and n
    finally:
        spark.conf.set(session.STORE_CONF, held)


_APPEND_RUN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from vitrine.streaming import incremental as inc
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
     .config("spark.sql.session.timeZone", "UTC").config("spark.vitrine.store", {store!r}).getOrCreate())
s.sparkContext.setLogLevel("ERROR")
cats = inc.stream_category_counts(s, {src!r})
daily = inc.stream_offer_events(s, {src!r})
print("RESULT", sum(r.offers_cnt for r in cats.collect()), sum(r.events_cnt for r in daily.collect()),
      s.read.parquet(inc.stream_folder(s, "catalog_counts", {src!r}) + "/category").select("batch_id").distinct().count())
"""


def test_second_process_handles_only_appended_files(spark):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    src_dir, store = tempfile.mkdtemp(prefix="vitrine-two-"), tempfile.mkdtemp(prefix="vitrine-two-store-")
    part, events = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("part", "events"))

    def run():
        text = _APPEND_RUN.format(root=root, store=store, src=src_dir)
        out = subprocess.run([sys.executable, "-c", text], capture_output=True, text=True, timeout=300)
        return [int(x) for x in out.stdout.split("RESULT")[1].split()]

    part.where("p_partkey <= 100").write.parquet(f"{src_dir}/part.parquet")
    events.where("event_id % 2 = 0").write.parquet(f"{src_dir}/events.parquet")
    first = run()
    part.where("p_partkey > 100").write.mode("append").parquet(f"{src_dir}/part.parquet")
    events.where("event_id % 2 = 1").write.mode("append").parquet(f"{src_dir}/events.parquet")
    second = run()
    # The catalogue of each batch is the one that is there when it runs, so the
    # first half of the events met half of the catalogue.
    ids = lambda e, top: e.where(F.col("user_id").between(0, top)).count()
    halves = [events.where(f"event_id % 2 = {k}") for k in (0, 1)]
    assert first == [101, ids(halves[0], 100), 1]
    assert second == [200, ids(halves[0], 100) + ids(halves[1], 199), 2]


def test_raw_counter_stream_over_several_batches(spark):
    """Resets inside panes, on pane borders and between batches, against a plain fold per window."""
    import random
    r = random.Random(3)
    base, rows = dt.datetime(2024, 1, 1), []
    for label in ("a", "b"):
        at, value = 0, 0
        while at < 6000:
            at += r.choice([20, 40, 60, 60, 120, 700])
            value = r.randint(0, 5) if r.random() < 0.2 else value + r.randint(0, 9)
            rows.append(("m", label, base + dt.timedelta(seconds=at), float(value)))
    rows += [("m", label, base + dt.timedelta(seconds=60_000), 0.0) for label in ("a", "b")]   # moves the watermark on
    rows.sort(key=lambda x: x[2])
    src_dir, out = tempfile.mkdtemp(prefix="vitrine-raw-"), tempfile.mkdtemp(prefix="vitrine-raw-out-")
    schema = "metric string, label string, ts timestamp_ntz, value double"
    size, slide, delay = 600, 60, 120
    for k in range(0, len(rows), 40):
        spark.createDataFrame(rows[k:k + 40], schema).coalesce(1).write.mode("append").parquet(src_dir)
    inc.run_counter_rate(spark, src_dir, out, "m", size, slide, delay, max_files=1)
    got = {(q.label, (q.window_start - base).total_seconds()): (round(q.rate * size, 6), q.samples) for q in spark.read.parquet(f"{out}/rates").collect()}
    want = {}
    for label in ("a", "b"):
        own = [((ts - base).total_seconds(), v) for _, lab, ts, v in rows if lab == label]
        for start in range(-size, 6000 + size, slide):
            inside = [v for s, v in own if start <= s < start + size]
            if len(inside) > 1:
                want[label, float(start)] = (float(sum(b if b < a else b - a for a, b in zip(inside, inside[1:]))), len(inside))
    assert got == want and len(want) > 150


def test_streams_over_several_micro_batches(spark):
    """Tables that arrive as several files, one file per micro-batch: the
    maintained aggregates equal the batch computation over all files."""
    src_dir = tempfile.mkdtemp(prefix="vitrine-multi-")
    for t in ["part", "events"]:
        spark.read.parquet(f"{SF001}/{t}.parquet").repartition(4).write.parquet(f"{src_dir}/{t}.parquet")
    cats = inc.stream_category_counts(spark, src_dir, max_files=1)
    batches = spark.read.parquet(inc.stream_folder(spark, "catalog_counts", src_dir) + "/category").select("batch_id").distinct()
    assert batches.count() == 4
    from vitrine.plans import aggregates as agg
    offers, events = fx.offers(spark, src_dir), fx.raw_events(spark, src_dir)
    assert sorted(map(tuple, cats.collect())) == sorted(map(tuple, agg.category_counts(offers).collect()))
    brands = inc.stream_brand_counts(spark, src_dir, max_files=1)
    assert sorted(map(tuple, brands.collect())) == sorted(map(tuple, agg.brand_counts(offers).collect()))
    daily = inc.stream_offer_events(spark, src_dir, max_files=1)
    assert sorted(map(tuple, daily.collect())) == \
        sorted(map(tuple, agg.offer_events_daily(events, offers).collect()))


def test_delta_table_before_and_after_a_batch(spark):
    path = tempfile.mkdtemp(prefix="vitrine-none-") + "/d"
    empty = spark.createDataFrame([], "k int, n long")
    assert inc.read_deltas(spark, path, ["k"], "n", empty).collect() == []
    inc.write_delta(spark.createDataFrame([(1, 2), (1, 3)], "k int, n long"), path, 7)
    inc.write_delta(empty, path, 8)                                     # a batch without rows
    inc.write_delta(spark.createDataFrame([(1, 9)], "k int, n long"), path, 7)   # replayed with another result
    assert [tuple(r) for r in inc.read_deltas(spark, path, ["k"], "n", empty).collect()] == [(1, 9)]


def test_panes_of_a_burst_are_bounded(spark):
    """A million samples of one series in one hour, half of them within a second."""
    n = 1_000_000
    ts = F.timestamp_micros(F.lit(1_700_000_000_000_000 - 1_700_000_000_000_000 % 3_600_000_000) + F.when(F.col("id") < n // 2, F.col("id") * 7_000).otherwise(3_550_000_000 + F.col("id")))
    s = spark.range(0, n).select(F.lit("m").alias("metric"), F.lit("l").alias("label"), ts.alias("ts"), (F.col("id") % 1000).cast("double").alias("value"))
    series, panes, sizes = ["metric", "label"], inc.instants(s, ["metric", "label"]), []
    assert inc.pane_widths(3600) == [1_000, 1_000_000, 3_600_000_000] and inc.pane_widths(90) == [1_000, 1_000_000, 90_000_000]
    for width in inc.pane_widths(3600):
        arrays = inc.gathered(panes, series, f"{width} microseconds").persist()
        sizes.append(arrays.agg(F.max(F.size("parts"))).first()[0])
        panes = inc.folded(arrays, series)
    assert max(sizes) <= inc.FAN_OUT and sizes[0] == 1000
    row = panes.collect()
    assert len(row) == 1 and (row[0].n, row[0].first, row[0].last, row[0].inside) == (n, 0.0, 999.0, float(n - n // 1000))
    rates = inc.windowed_rates(s, 3600, 3600, 0).collect()
    assert [(r.samples, r.rate * 3600) for r in rates] == [(n, pytest.approx(n - n // 1000))]


def test_largest_value_at_an_instant_counts_in_a_stream(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("m", "l", base + dt.timedelta(seconds=s), float(v)) for s, v in ((0, 3), (15, 5), (15, 7), (15, 7), (30, 9))]
    s = spark.createDataFrame(rows, "metric string, label string, ts timestamp, value double")
    assert [(r.samples, r.rate * 60) for r in inc.windowed_rates(s, 60, 60, 0).collect()] == [(3, 6.0)]


# ---------------------------------------------------------------- splittable CSV
def _big_csv(seed, rows, end="\n"):
    import csv
    import random
    r = random.Random(seed)
    path = tempfile.mkdtemp(prefix="vitrine-split-") + "/one.csv"
    want = []
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["0", "offer_id", "price", "seller_id", "category_id", "vendor"])
        for i in range(rows):
            vendor = "".join(r.choice(['a', 'é', ' ', ',', '""', '"', "\n", "\r\n", "\n\n", "x,y\n1,2,3,4,5,6"]) for _ in range(r.choice([0, 1, 3, 12]))) if r.random() < 0.4 else f"vendor {i}"
            if r.random() < 0.01:
                vendor = "line\n" * 400                                # longer than a split
            want.append((i, i / 4, i % 7, i % 11, vendor))
            w.writerow(["0", *want[-1]])
    return path, want


@pytest.mark.parametrize("seed,end,split,sent", [(1, "\n", "1k", 100_000), (2, "\r\n", "700b", 100_000), (3, "\n", "3k", 0), (4, "\n", "1g", 100_000)])
def test_one_csv_file_is_read_by_many_tasks(spark, monkeypatch, seed, end, split, sent):
    path, want = _big_csv(seed, 900, end)
    monkeypatch.setattr(tb, "PIECES_SENT", sent)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        splits = tb.csv_lines(spark, path).select("block").distinct().count()
        got = sorted(map(tuple, tb.read_offers_csv(spark, path).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == want and splits >= (8 if split != "1g" else 1)


def test_csv_quote_that_is_never_closed_raises(spark):
    path = tempfile.mkdtemp(prefix="vitrine-open-") + "/o.csv"
    with open(path, "w") as f:
        f.write('0,1,1.0,1,1,v\n0,2,1.0,1,1,"open\n0,3,1.0,1,1,v\n')
    with pytest.raises(Exception, match="never closed"):
        tb.read_offers_csv(spark, path).collect()


# ---------------------------------------------------------------- repeatable loads
def test_load_that_dies_between_inserts_is_repeated(spark, monkeypatch):
    loc, db = tempfile.mkdtemp(prefix="vitrine-dies-"), "ecom_dies"
    offers, events = fx.offers(spark, SF001), fx.raw_events(spark, SF001)
    with monkeypatch.context() as m:
        m.setattr(tb, "insert_raw_events", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            tb.load_namespace(spark, offers, events, db, loc)
    assert tb.loaded_on(spark, db) is None and spark.table(f"{db}.ecom_offers").count() == 200
    for _ in range(2):
        assert tb.load_namespace(spark, offers, events, db, loc) == str(dt.date.today())
        assert spark.table(f"{db}.ecom_offers").count() == 200 and spark.table(f"{db}.raw_events").count() == events.count()
    tb.insert_offers(spark, offers, db)                                 # a later load appends
    assert spark.table(f"{db}.ecom_offers").count() == 400
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_replaced_file_changes_the_stamp(spark):
    import os
    d = tempfile.mkdtemp(prefix="vitrine-stamp-")
    os.makedirs(f"{d}/t.parquet/p=1")
    for name in ("a", "b"):
        with open(f"{d}/t.parquet/p=1/{name}", "w") as f:
            f.write("12345")
    stamp = lambda: tb.table_stamp(spark, d, ["t"])
    first = stamp()
    assert stamp() == first
    kept = os.stat(f"{d}/t.parquet")
    with open(f"{d}/t.parquet/p=1/b", "w") as f:
        f.write("54321")                                                # of equal size, deeper than the table's folder
    os.utime(f"{d}/t.parquet/p=1/b", (1, 1))
    os.utime(f"{d}/t.parquet", ns=(kept.st_atime_ns, kept.st_mtime_ns))
    assert stamp() != first


def _star(spark, lines: int = 4000, parts: int = 125) -> str:
    """Own tables of the catalogue: keys that are null, that repeat (parts beyond 120), that meet nothing, and a hot part."""
    d = tempfile.mkdtemp(prefix="vitrine-star-")
    i = F.col("id")
    spark.range(lines).select(
        (i % 900).alias("l_orderkey"), F.when(i % 97 > 0, F.when(i % 3 == 0, 7).otherwise(i * i % 131)).cast("bigint").alias("l_partkey"),
        F.when(i % 89 > 0, i % 23).alias("l_suppkey"), (i % 7).cast("int").alias("l_linenumber"),
        F.timestamp_seconds(i * 86400 + 9).cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{d}/lineitem.parquet")
    spark.range(parts).select(
        F.when(i % 50 > 0, i % 120).alias("p_partkey"), F.when(i % 11 > 0, F.concat(F.lit("w"), i % 5, F.lit(" v"), i)).alias("p_name"),
        F.concat(F.lit("Brand#"), i % 4).alias("p_brand"), F.concat(F.lit("T"), i % 3).alias("p_type"), (i % 9).cast("int").alias("p_size")).write.parquet(f"{d}/part.parquet")
    spark.range(22).select((i % 20).alias("s_suppkey"), F.when(i > 0, i % 6).cast("int").alias("s_nationkey")).write.parquet(f"{d}/supplier.parquet")
    spark.range(5).select(i.cast("int").alias("n_nationkey"), (i % 3).cast("int").alias("n_regionkey")).write.parquet(f"{d}/nation.parquet")
    spark.range(3).select(i.cast("int").alias("r_regionkey"), F.concat(F.lit("Re Gion"), i).alias("r_name")).write.parquet(f"{d}/region.parquet")
    return d


def _star_sql(d: str):
    import duckdb
    con = duckdb.connect()
    for t in fx.CATALOG_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    return con


def _shuffle_files(spark) -> set[str]:
    listed = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while listed.hasNext():
        names.add(listed.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


@pytest.fixture
def many_partitions(spark):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("most", [fx.SUPPLIERS_SENT, 1])
def test_catalogue_source_is_shuffled_narrow_and_stored_by_part(spark, many_partitions, monkeypatch, most):
    """Wide rows are written where the last join makes them, the lines of a part in one file; few suppliers are no reason for a shuffle."""
    import re

    from vitrine.plans import oracle_sql as sql
    monkeypatch.setattr(fx, "SUPPLIERS_SENT", most)
    d = _star(spark)
    plan = fx._catalog_src(spark, d)._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sent.count("l_partkey") == sent.count("p_partkey") == 1 and len([c for c in sent if c.startswith("l_")]) == (1 if most > 1 else 2)
    assert "Exchange" not in plan.split("SortMergeJoin [l_partkey")[0]
    src = fx.catalog_src(spark, d)
    per = src.withColumn("file", F.input_file_name()).groupBy("l_partkey").agg(F.countDistinct("file").alias("files")).collect()
    assert len(per) > 20 and {r.files for r in per} == {1}
    problems, n = compare(src, _star_sql(d), sql.with_(sql.CATALOG_SRC) + "SELECT * FROM catalog_src")
    assert n > 1000 and not problems


def test_builds_leave_no_shuffle_files(spark, many_partitions):
    """The disk a build needs is free before the next build begins."""
    from vitrine.plans import registry
    d, conf = _star(spark, parts=120), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(conf), _shuffle_files(spark)
    prods = registry._products(spark, d)
    assert not _shuffle_files(spark) - before and spark.conf.get(conf) == was
    assert prods.count() == prods.select("_id").distinct().count() > 100
    problems, n = compare(QUERIES["level_name_stats"](spark, d), _star_sql(d), ORACLE["level_name_stats"])
    assert n > 20 and not problems
