"""Reference SQL for every registered query, written for DuckDB over the
base tables (``part``, ``lineitem``, ``events`` ... as views).

These texts are the correctness oracle: an independent formulation of each
question in plain SQL (windows where the Spark plan uses aggregates, joins
where it uses pre-aggregation), compared row for row with the Spark result.
Column names and types are aligned with the Spark output.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixture views
OFFERS = """offers AS (
  SELECT p_partkey AS offer_id, p_retailprice AS price, p_partkey % 10 AS seller_id,
         CAST(p_size AS BIGINT) AS category_id, p_name AS vendor
  FROM part)"""

RAW_EVENTS = """raw_events AS (
  SELECT date_trunc('hour', ts) AS "Hour", event_type AS "DeviceTypeName",
         'app_' || CAST(event_id % 4 AS VARCHAR) AS "ApplicationName",
         'os_' || CAST(event_id % 3 AS VARCHAR) AS "OSName",
         'prov_' || CAST(user_id % 10 AS VARCHAR) AS "ProvinceName",
         user_id AS "ContentUnitID"
  FROM events)"""

OFFER_EVENTS = """offer_events AS (
  SELECT CAST(r."Hour" AS DATE) AS event_date, o.offer_id, o.category_id, o.vendor,
         CAST(count(*) AS BIGINT) AS events_cnt
  FROM raw_events r JOIN offers o ON r."ContentUnitID" = o.offer_id
  GROUP BY 1, 2, 3, 4)"""

SNAPSHOTS = """offer_snapshots AS (
  SELECT CAST(l_shipdate AS DATE) AS snapshot_date, l_partkey AS offer_id, l_extendedprice AS price,
         l_suppkey AS seller_id, CAST(p_size AS BIGINT) AS category_id, p_name AS vendor,
         l_orderkey, l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CAT = with_(OFFERS)
EV = with_(OFFERS, RAW_EVENTS)
MV = with_(OFFERS, RAW_EVENTS, OFFER_EVENTS)

ORACLE: dict[str, str] = {}

def _ranked(key: str, k: int) -> str:
    """Groups of the catalogue by size, the k first by an explicit rank."""
    return CAT + f""", sizes AS (SELECT DISTINCT {key}, count(*) OVER (PARTITION BY {key}) AS offers_cnt FROM offers)
SELECT {key}, offers_cnt FROM sizes
QUALIFY row_number() OVER (ORDER BY offers_cnt DESC, {key}) <= {k}"""


ORACLE["top_categories_raw"] = ORACLE["top_categories_mv"] = _ranked("category_id", 20)
ORACLE["top_brands_raw"] = ORACLE["top_brands_mv"] = _ranked("vendor", 30)

# The mean over brands is all offers of a category over its number of brands.
ORACLE["avg_offers_per_brand_raw"] = ORACLE["avg_offers_per_brand_mv"] = CAT + """
SELECT category_id, round(count(*) / count(DISTINCT vendor), 6) AS avg_offers_per_brand
FROM offers GROUP BY category_id"""

_UNSEEN = EV + """, unseen AS (
  SELECT offer_id, category_id, vendor, price FROM offers
  WHERE NOT EXISTS (SELECT 1 FROM raw_events WHERE "ContentUnitID" = offer_id))
"""
ORACLE["offers_without_events_raw"] = ORACLE["offers_without_events_mv"] = _UNSEEN + "SELECT * FROM unseen"
ORACLE["offers_without_events_count"] = _UNSEEN + "SELECT count(*) AS offers_without_events FROM unseen"

# Days with events per catalogue row; a row without any still counts as one joined row.
_DAYS = EV + """, days AS (
  SELECT offer_id, (SELECT count(DISTINCT CAST("Hour" AS DATE)) FROM raw_events WHERE "ContentUnitID" = offer_id) AS n
  FROM offers)
"""
ORACLE["coverage_rows"] = _DAYS + """
SELECT CAST(sum(n) AS BIGINT) AS offers_with_events, CAST(sum(greatest(n, 1)) AS BIGINT) AS total_offers,
       round(sum(n) / sum(greatest(n, 1)), 6) AS coverage_ratio FROM days"""
ORACLE["coverage_offers"] = _DAYS + """
SELECT count(*) FILTER (WHERE n > 0) AS offers_with_events, count(*) AS total_offers,
       round(count(*) FILTER (WHERE n > 0) / count(*), 6) AS coverage_ratio FROM days"""

ORACLE["ecom_offers_table"] = CAT + "SELECT *, TRUE AS dated_today, TRUE AS in_month FROM offers"
ORACLE["raw_events_table"] = EV + """
SELECT CAST("Hour" AS DATE) AS event_date, "DeviceTypeName", count(*) AS events_cnt FROM raw_events GROUP BY ALL"""

ORACLE["events_by_device"] = EV + """
SELECT "DeviceTypeName", count(*) AS events_cnt FROM raw_events
GROUP BY "DeviceTypeName" ORDER BY events_cnt DESC, "DeviceTypeName\""""

ORACLE["offer_events_daily"] = MV + "SELECT * FROM offer_events"
ORACLE["offer_events_daily_mv"] = ORACLE["offer_events_daily"]

_LATEST = with_(SNAPSHOTS) + """
SELECT {month_col} category_id, offer_id, snapshot_date, price, seller_id, vendor, l_orderkey, l_linenumber
FROM (SELECT *, {month_expr} AS snapshot_month,
             row_number() OVER (PARTITION BY {part} category_id, offer_id
                                ORDER BY snapshot_date DESC, l_orderkey DESC, l_linenumber DESC,
                                         seller_id DESC) AS rn
      FROM offer_snapshots)
WHERE rn = 1"""

ORACLE["offers_latest_in_month"] = _LATEST.format(
    month_col="snapshot_month,", month_expr="CAST(year(snapshot_date) * 100 + month(snapshot_date) AS INTEGER)",
    part="snapshot_month,")
ORACLE["offers_latest"] = _LATEST.format(month_col="", month_expr="0", part="")


# ---------------------------------------------------------------- documents
CATALOG_SRC = r"""catalog_src AS (
  SELECT ' ' || r_name AS "Partner_Name", md5(path) AS "Category_ID", path AS "Category_FullPathName",
         l_partkey AS "Offer_ID", p_name AS "Offer_Name", p_type AS "Offer_Type",
         l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_shipdate AS DATE) AS load_date
  FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, p_name, p_type, r_name,
               array_to_string(list_slice([p_type, p_brand, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)],
                                          1, p_size % 4 + 1), chr(92)) AS path
        FROM lineitem JOIN part ON l_partkey = p_partkey
             JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey))"""


def _src(where: str = "TRUE") -> str:
    return rf"""src AS (
  SELECT CASE WHEN pn IS NULL THEN '_unknown' WHEN starts_with(pn, '_') THEN pn ELSE '_' || pn END AS partner,
         category_id, offer_id, offer_name, offer_type, path_text, parts,
         l_orderkey, l_linenumber, l_suppkey, l_partkey
  FROM (SELECT replace(lower(regexp_replace("Partner_Name", '^\s+|\s+$', '', 'g')), ' ', '_') AS pn,
               CAST("Category_ID" AS VARCHAR) AS category_id, CAST("Offer_ID" AS VARCHAR) AS offer_id,
               CAST("Offer_Name" AS VARCHAR) AS offer_name, CAST("Offer_Type" AS VARCHAR) AS offer_type,
               "Category_FullPathName" AS path_text,
               list_filter(list_transform(regexp_split_to_array(coalesce("Category_FullPathName", ''), '\\+'),
                                          lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
                           lambda x: x <> '') AS parts,
               l_orderkey, l_linenumber, l_suppkey, l_partkey
        FROM catalog_src WHERE {where}))"""


def _categories(name: str, src: str, ts: str) -> str:
    return rf"""{name} AS (
  SELECT partner || '_' || category_id AS _id, partner, category_id,
         CASE WHEN len(parts) > 0 THEN parts[len(parts)] END AS name,
         array_to_string(parts, '/') AS path, parts AS path_array, CAST(len(parts) AS INTEGER) AS level,
         CASE WHEN len(parts) > 1 THEN array_to_string(parts[1:len(parts) - 1], '/') END AS parent_path,
         total_products, TIMESTAMP '{ts}' AS last_updated
  FROM (SELECT g.partner, g.category_id, g.total_products, coalesce(f.parts, []::VARCHAR[]) AS parts
        FROM (SELECT partner, category_id, count(*) AS total_products FROM {src}
              WHERE category_id IS NOT NULL GROUP BY partner, category_id) g
        LEFT JOIN (SELECT partner, category_id, parts FROM (
                     SELECT partner, category_id, parts,
                            row_number() OVER (PARTITION BY partner, category_id
                                               ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) AS rn
                     FROM {src} WHERE category_id IS NOT NULL AND path_text IS NOT NULL) WHERE rn = 1) f
          ON g.partner = f.partner AND g.category_id = f.category_id))"""


def _products(name: str, src: str, ts: str) -> str:
    return rf"""{name} AS (
  SELECT partner || '_' || offer_id AS _id, partner, offer_id, offer_name AS name, offer_type AS type,
         category_id, CASE WHEN len(parts) > 0 THEN parts[len(parts)] END AS category_name,
         array_to_string(parts, '/') AS full_path, parts,
         TIMESTAMP '{ts}' AS updated_at, TIMESTAMP '{ts}' AS created_at
  FROM (SELECT *, row_number() OVER (PARTITION BY partner, offer_id
                                     ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey) AS rn
        FROM {src} WHERE offer_id IS NOT NULL) WHERE rn = 1)"""


LOAD_TS = "2025-01-01 00:00:00"
SECOND_LOAD_TS = "2025-02-01 00:00:00"
DOCS = with_(CATALOG_SRC, _src(), _categories("categories", "src", LOAD_TS), _products("products", "src", LOAD_TS))
SRC = with_(CATALOG_SRC, _src())

CATEGORIES_FLAT = """SELECT _id, partner, category_id, name, path, array_to_string(path_array, '|') AS path_parts,
       level, parent_path, total_products, last_updated FROM {t}"""
PRODUCTS_FLAT = """SELECT _id, partner, offer_id, name, type, category_id, category_name, full_path,
       array_to_string(list_transform(parts, lambda x, i: CAST(i AS VARCHAR) || ':' || x), '|') AS breadcrumbs,
       updated_at, created_at FROM {t}"""

ORACLE["profile_summary"] = SRC + """
SELECT (SELECT count(*) FROM (SELECT DISTINCT partner, category_id FROM src)) AS unique_categories,
       (SELECT CAST(coalesce(max(len(parts)), 0) AS INTEGER) FROM src) AS max_depth,
       (SELECT count(*) FROM (SELECT offer_id FROM src GROUP BY offer_id
                              HAVING count(DISTINCT partner) > 1)) AS offers_multi_partner,
       (SELECT count(DISTINCT offer_type) FROM src) AS unique_types"""

ORACLE["top_partner_categories"] = SRC + """
SELECT partner, category_id, count(offer_id) AS products_cnt FROM src
GROUP BY partner, category_id ORDER BY products_cnt DESC, partner, category_id LIMIT 10"""

ORACLE["multi_partner_offers"] = SRC + """
SELECT offer_id, count(DISTINCT partner) AS partners_cnt FROM src
GROUP BY offer_id HAVING count(DISTINCT partner) > 1"""

ORACLE["categories_docs"] = DOCS + CATEGORIES_FLAT.format(t="categories")
ORACLE["products_docs"] = DOCS + PRODUCTS_FLAT.format(t="products")

_TWO = with_(CATALOG_SRC,
             _src("load_date < DATE '1998-01-01'").replace("src AS", "src_a AS", 1),
             _src("load_date >= DATE '1997-01-01'").replace("src AS", "src_b AS", 1),
             _categories("cat_a", "src_a", LOAD_TS), _categories("cat_b", "src_b", SECOND_LOAD_TS),
             _products("prod_a", "src_a", LOAD_TS), _products("prod_b", "src_b", SECOND_LOAD_TS))

ORACLE["categories_upsert"] = _TWO + CATEGORIES_FLAT.format(
    t="(SELECT * FROM cat_a WHERE _id NOT IN (SELECT _id FROM cat_b) UNION ALL SELECT * FROM cat_b)")

ORACLE["products_upsert"] = _TWO + PRODUCTS_FLAT.format(t="""(
  SELECT b._id, b.partner, b.offer_id, b.name, b.type, b.category_id, b.category_name, b.full_path, b.parts,
         b.updated_at, coalesce(a.created_at, b.created_at) AS created_at
  FROM prod_b b LEFT JOIN prod_a a ON a._id = b._id
  UNION ALL
  SELECT * FROM prod_a WHERE _id NOT IN (SELECT _id FROM prod_b))""")

ORACLE["documents_json"] = DOCS + """
SELECT _id, CAST(to_json({'_id': _id, 'partner': partner, 'offer_id': offer_id, 'name': name, 'type': type,
                     'category': {'id': category_id, 'name': category_name, 'full_path': full_path,
                                  'breadcrumbs': list_transform(parts, lambda x, i: {'level': i, 'name': x})},
                     'updated_at': strftime(updated_at, '%Y-%m-%dT%H:%M:%S'),
                     'created_at': strftime(created_at, '%Y-%m-%dT%H:%M:%S')}) AS VARCHAR) AS doc_json
FROM products"""

ORACLE["categories_by_level"] = DOCS + """
SELECT level, count(*) AS categories_cnt FROM categories GROUP BY level ORDER BY level"""

ORACLE["categories_by_partner_level"] = DOCS + """
SELECT partner, level, count(*) AS categories_cnt, CAST(sum(total_products) AS BIGINT) AS products_sum
FROM categories GROUP BY partner, level ORDER BY partner, level"""

ORACLE["category_depth"] = DOCS + """
SELECT round(avg(level), 2) AS avg_level, max(level) AS max_level FROM categories HAVING count(*) > 0"""

ORACLE["categories_filter_level_partner"] = DOCS + """
SELECT _id, name, total_products, path FROM categories WHERE level = 1 AND partner = '_asia'"""

ORACLE["categories_containing"] = DOCS + """
SELECT _id, name, level, path FROM categories WHERE list_contains(path_array, 'Brand#4')"""

ORACLE["top_categories_by_products"] = DOCS + """
SELECT _id, name, path, total_products FROM categories ORDER BY total_products DESC, _id LIMIT 10"""

ORACLE["largest_at_level"] = DOCS + """
SELECT level, _id, name, path, total_products FROM (
  SELECT *, row_number() OVER (PARTITION BY level ORDER BY total_products DESC, _id) AS rn
  FROM categories WHERE level IN (1, 4)) WHERE rn = 1"""

ORACLE["deepest_category"] = DOCS + """
SELECT _id, name, path, level, total_products FROM categories
ORDER BY level DESC, total_products DESC, _id LIMIT 1"""

ORACLE["leaf_categories"] = DOCS + """
SELECT c._id, c.partner, c.level, c.path, c.total_products FROM categories c
WHERE NOT EXISTS (SELECT 1 FROM categories ch WHERE ch.parent_path = c.path)
ORDER BY total_products DESC, _id LIMIT 10"""

ORACLE["children_per_category"] = DOCS + """
SELECT c._id, c.path, coalesce(k.n, 0) AS children_cnt
FROM categories c
LEFT JOIN (SELECT parent_path, count(*) AS n FROM categories GROUP BY parent_path) k ON k.parent_path = c.path"""

ORACLE["products_type_in_branch"] = DOCS + """
SELECT _id, name, full_path FROM products WHERE type = 'PROMO' AND list_contains(parts, 'Brand#4')"""

ORACLE["products_depth4"] = DOCS + """
SELECT _id, name, CAST(len(parts) AS INTEGER) AS depth FROM products WHERE len(parts) > 3"""

ORACLE["product_sample"] = DOCS + """
SELECT _id, name, CAST(len(parts) AS INTEGER) AS depth FROM products
ORDER BY (len(parts) > 3) DESC, _id LIMIT 1"""

ORACLE["products_by_type"] = DOCS + """
SELECT type, count(*) AS cnt FROM products GROUP BY type ORDER BY cnt DESC, type LIMIT 5"""

ORACLE["products_by_partner"] = DOCS + """
SELECT partner, count(*) AS cnt FROM products GROUP BY partner ORDER BY cnt DESC, partner"""

ORACLE["products_by_root"] = DOCS + """
SELECT parts[1] AS root_category, count(*) AS products_cnt FROM products
GROUP BY 1 ORDER BY products_cnt DESC, root_category NULLS FIRST"""

ORACLE["top_product_categories"] = DOCS + """
SELECT category_id, category_name AS name, full_path, count FROM (
  SELECT category_id, category_name, full_path,
         count(*) OVER (PARTITION BY category_id) AS count,
         row_number() OVER (PARTITION BY category_id ORDER BY _id) AS rn
  FROM products) WHERE rn = 1
ORDER BY count DESC, category_id LIMIT 10"""

CRUMBS = """crumbs AS (
  SELECT CAST(unnest(generate_series(1, len(parts))) AS INTEGER) AS level, unnest(parts) AS name
  FROM products WHERE len(parts) > 0)"""
CR = with_(CATALOG_SRC, _src(), _products("products", "src", LOAD_TS), CRUMBS)

ORACLE["level_name_stats"] = CR + """
SELECT level, name, count(*) AS cnt FROM crumbs GROUP BY level, name
ORDER BY level, cnt DESC, name LIMIT 30"""

ORACLE["busiest_level"] = CR + """
SELECT level, count(*) AS cnt FROM crumbs GROUP BY level ORDER BY cnt DESC, level LIMIT 1"""

ORACLE["top3_per_level"] = CR + """
SELECT level, name, cnt, rank FROM (
  SELECT level, name, cnt, CAST(row_number() OVER (PARTITION BY level ORDER BY cnt DESC, name) AS INTEGER) AS rank
  FROM (SELECT level, name, count(*) AS cnt FROM crumbs WHERE level IN (1, 2, 3) GROUP BY level, name))
WHERE rank <= 3"""


# ---------------------------------------------------------------- metrics
METRIC_SAMPLES = """metric_samples AS (
  SELECT 'queries_total' AS metric, event_type AS label, ts,
         CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) % 500 AS DOUBLE) AS value
  FROM events
  UNION ALL
  SELECT 'query_time_us', event_type, ts,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY event_type ORDER BY event_id
                                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS DOUBLE)
  FROM events
  UNION ALL
  SELECT 'memory_bytes', event_type, ts, value * 1e6 FROM events)"""

RANGE_US = 6 * 3600 * 1_000_000


def _increase(metrics: str) -> str:
    return f"""deltas AS (
  SELECT metric, label, ts, epoch_us(ts) AS t,
         CASE WHEN prev IS NULL THEN NULL WHEN value < prev THEN value ELSE value - prev END AS delta
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, label ORDER BY ts) AS prev
        FROM metric_samples WHERE metric IN ({metrics}))),
increases AS (
  SELECT metric, label, ts, s - coalesce(f, 0) AS increase, samples FROM (
    SELECT metric, label, ts, sum(delta) OVER w AS s, first_value(delta) OVER w AS f, count(*) OVER w AS samples
    FROM deltas
    WINDOW w AS (PARTITION BY metric, label ORDER BY t RANGE BETWEEN {RANGE_US - 1} PRECEDING AND CURRENT ROW))
  WHERE samples >= 2)"""


ORACLE["counter_rate"] = with_(METRIC_SAMPLES, _increase("'queries_total'")) + """
SELECT metric, label, ts, increase / 21600.0 AS rate, samples FROM increases"""

ORACLE["latency_ratio"] = with_(METRIC_SAMPLES, _increase("'query_time_us', 'queries_total'")) + """
SELECT n.label, n.ts,
       CASE WHEN d.increase = 0 THEN NULL ELSE (n.increase / 21600.0) / (d.increase / 21600.0) END / 1e6 AS latency_s
FROM increases n JOIN increases d ON n.label = d.label AND n.ts = d.ts
WHERE n.metric = 'query_time_us' AND d.metric = 'queries_total'"""

ORACLE["gauge_scaled"] = with_(METRIC_SAMPLES) + """
SELECT label, ts, value / 1e9 AS memory_gb FROM metric_samples WHERE metric = 'memory_bytes'"""

ORACLE["last_window"] = with_(METRIC_SAMPLES) + """
SELECT metric, label, ts, value FROM metric_samples
WHERE ts >= (SELECT max(ts) FROM metric_samples) - INTERVAL 5 MINUTE
  AND ts <= (SELECT max(ts) FROM metric_samples)"""

ORACLE["timing_summary"] = """
SELECT o_orderpriority AS query, min(o_totalprice / 1e6) AS min_s, round(avg(o_totalprice / 1e6), 6) AS mean_s,
       max(o_totalprice / 1e6) AS max_s, count(*) AS iterations
FROM orders GROUP BY o_orderpriority ORDER BY query"""

ORACLE["csv_load"] = with_(OFFERS) + "SELECT offer_id, price, seller_id, category_id, vendor FROM offers"

ORACLE["merge_partial_counts"] = with_(SNAPSHOTS) + """
SELECT category_id, count(*) AS offers_cnt FROM offer_snapshots GROUP BY category_id"""


# ---------------------------------------------------------------- streaming
ORACLE["stream_category_counts"] = CAT + "SELECT category_id, count(*) AS offers_cnt FROM offers GROUP BY category_id"
ORACLE["stream_brand_counts"] = CAT + """
SELECT vendor, category_id, count(*) AS offers_cnt FROM offers GROUP BY vendor, category_id"""
ORACLE["stream_offer_events"] = ORACLE["offer_events_daily"]

SLIDE_US = 3600 * 1_000_000
DELAY_US = 3600 * 1_000_000
ORACLE["stream_counter_rate"] = with_(METRIC_SAMPLES) + f"""
, win AS (
  SELECT metric, label, ts, value, (epoch_us(ts) // {SLIDE_US}) * {SLIDE_US} - k * {SLIDE_US} AS ws
  FROM (SELECT *, unnest(range(0, {RANGE_US // SLIDE_US})) AS k FROM metric_samples
        WHERE metric = 'queries_total')),
d AS (
  SELECT metric, label, ws, ts,
         CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS delta
  FROM (SELECT *, lag(value) OVER (PARTITION BY metric, label, ws ORDER BY ts) AS prev FROM win))
SELECT metric, label, make_timestamp(ws) AS window_start, make_timestamp(ws + {RANGE_US}) AS window_end,
       sum(delta) / 21600.0 AS rate, count(*) AS samples
FROM d GROUP BY metric, label, ws
HAVING count(*) >= 2
   AND ws + {RANGE_US} <= (SELECT epoch_us(max(ts)) FROM metric_samples WHERE metric = 'queries_total') - {DELAY_US}"""


# ---------------------------------------------------------------- SQL surface
ORACLE["panel_coverage_sql"] = _DAYS + """
SELECT CAST(sum(n) AS BIGINT) AS offers_with_events, CAST(sum(greatest(n, 1)) AS BIGINT) AS total_offers,
       sum(n) / sum(greatest(n, 1)) AS coverage_ratio FROM days"""
ORACLE["panel_offers_without_events_sql"] = ORACLE["offers_without_events_count"]


# ---------------------------------------------------------------- rows without keys
GAPS = CATALOG_SRC.replace("catalog_src AS", "whole AS", 1) + """, catalog_src AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 17 <> 0 THEN "Partner_Name" END AS "Partner_Name",
                    CASE WHEN NOT (l_linenumber = 2 AND l_orderkey % 11 = 0) THEN "Category_ID" END AS "Category_ID",
                    CASE WHEN l_orderkey % 7 <> 0 THEN "Category_FullPathName" END AS "Category_FullPathName",
                    CASE WHEN NOT (l_linenumber = 1 AND l_orderkey % 13 = 0) THEN "Offer_ID" END AS "Offer_ID")
  FROM whole)"""
_REJECTED = """
SELECT l_orderkey, l_linenumber, partner, category_id, offer_id,
       concat_ws(',', CASE WHEN category_id IS NULL THEN 'category' END, CASE WHEN offer_id IS NULL THEN 'offer' END) AS reason
FROM src WHERE category_id IS NULL OR offer_id IS NULL"""
ORACLE["rejected_rows"] = with_(CATALOG_SRC, _src()) + _REJECTED
ORACLE["rejected_rows_gaps"] = with_(GAPS, _src()) + _REJECTED
ORACLE["categories_docs_gaps"] = with_(GAPS, _src(), _categories("cats", "src", "2025-01-01")) + """
SELECT partner, category_id, path, level, total_products FROM cats"""
ORACLE["multi_partner_offers_gaps"] = with_(GAPS, _src()) + """
SELECT offer_id, count(DISTINCT CASE WHEN CAST(offer_id AS BIGINT) % 3 <> 0 THEN partner ELSE '_unknown' END) AS partners_cnt
FROM src GROUP BY offer_id HAVING partners_cnt > 1"""
ORACLE["category_children"] = with_(CATALOG_SRC, _src(), _categories("cats", "src", "2025-01-01")) + """
SELECT c._id AS parent_id, k._id AS child_id FROM cats c LEFT JOIN cats k ON k.parent_path = c.path"""
ORACLE["first_categories"] = with_(CATALOG_SRC, _src(), _categories("cats", "src", "2025-01-01")) + """
SELECT _id, name, total_products, path FROM cats WHERE level = 1 AND partner = '_asia' ORDER BY _id LIMIT 3"""
ORACLE["categories_json"] = with_(CATALOG_SRC, _src(), _categories("cats", "src", "2025-01-01")) + """
SELECT _id, CAST(to_json({'_id': _id, 'partner': partner, 'category_id': category_id, 'name': name, 'path': path,
                          'path_array': path_array, 'level': level, 'parent_path': parent_path,
                          'metadata': {'total_products': total_products, 'last_updated': strftime(last_updated, '%Y-%m-%dT%H:%M:%S')}}) AS VARCHAR) AS doc_json
FROM cats"""
