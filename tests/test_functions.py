"""Scalar functions on hand-made edge rows (FIXTURES.md §4)."""

import re

import pytest
from pyspark.sql import functions as F

from vitrine.functions import columns as fn


def _split_py(s):
    # Behaviour to match, written out: strip, split on backslash runs,
    # strip the parts, drop empty ones; None gives [].
    if s is None:
        return []
    return [p.strip() for p in re.split(r"\\+", str(s).strip()) if p.strip()]


def _partner_py(x):
    if x is None:
        return "_unknown"
    s = str(x).strip().lower().replace(" ", "_")
    return s if s.startswith("_") else "_" + s


PATHS = [None, "", "   ", "One", "A\\\\B \\ C\\", "\tA \n\\ B\t", "\\\\", "Строительство\\Инструмент"]
PARTNERS = [None, "", "Acme", " _Acme ", "A b c", "\tLead", "MIDDLE EAST", "_x"]


def test_split_path_edges(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "p string")
    got = [r.parts for r in df.select(fn.split_path("p").alias("parts")).collect()]
    assert got == [_split_py(p) for p in PATHS]


def test_path_helpers(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "p string").select(fn.split_path("p").alias("a"))
    rows = df.select(fn.join_path("a").alias("path"), fn.parent_path("a").alias("parent"),
                     fn.last_or_null("a").alias("name"), fn.depth("a").alias("level"),
                     fn.breadcrumbs("a").alias("bc"), "a").collect()
    for r in rows:
        parts = r.a
        assert r.path == "/".join(parts)
        assert r.parent == ("/".join(parts[:-1]) if len(parts) > 1 else None)
        assert r.name == (parts[-1] if parts else None)
        assert r.level == len(parts)
        assert [(b.level, b.name) for b in r.bc] == [(i + 1, p) for i, p in enumerate(parts)]


def test_partner_cleanup_edges(spark):
    df = spark.createDataFrame([(p,) for p in PARTNERS], "p string")
    got = [r.x for r in df.select(fn.normalize_partner("p").alias("x")).collect()]
    assert got == [_partner_py(p) for p in PARTNERS]


def test_element_or_null_and_key(spark):
    df = spark.createDataFrame([(["a"], "p", None), ([], "p", "1")], "arr array<string>, a string, b string")
    rows = df.select(fn.element_or_null("arr", 0).alias("e0"), fn.element_or_null("arr", 3).alias("e3"),
                     fn.doc_key("a", "b").alias("k")).collect()
    assert [(r.e0, r.e3, r.k) for r in rows] == [("a", None, None), (None, None, "p_1")]


def test_epoch_micros_is_zone_free(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.179575",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        v = df.select(fn.epoch_micros("ts").alias("us")).first().us
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == 1704067207179575


def test_safe_ratio_and_month(spark):
    df = spark.createDataFrame([(1, 0, "2024-03-05")], "a int, b int, d string")
    r = df.select(fn.safe_ratio("a", "b").alias("r"), fn.month_key(F.col("d").cast("date")).alias("m")).first()
    assert r.r is None and r.m == 202403


def test_require_columns_raises(spark):
    from vitrine.sources.tables import require_columns
    df = spark.createDataFrame([(1,)], "Partner_Name int")
    with pytest.raises(ValueError, match="Missing columns"):
        require_columns(df)


def test_rounding_by_the_exact_value(spark):
    import random
    r = random.Random(2)
    values = [2.675, 0.125, 0.375, 1.005, 2.5, 3.5, -2.5, -0.125, -2.675, 0.0, 1e-9, 1e15 + 0.3, 4503599627370497.5, 1e300, -1e300, float("inf"), 0.285, 1.115, 8.345, 5e-324]
    values += [r.uniform(-1000, 1000) for _ in range(3000)] + [k / 8 for k in range(-400, 400)] + [k / 200 for k in range(-2000, 2000)] + [r.uniform(-1, 1) * 10 ** r.randint(-5, 14) for _ in range(2000)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    for digits in (0, 1, 2, 5):
        got = df.select("x", fn.round_half_even("x", digits).alias("y")).collect()
        assert all(q.y == (None if q.x is None else q.x if q.x == float("inf") else float(round(q.x, digits))) for q in got)
