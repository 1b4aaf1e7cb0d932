"""Sources and sinks: Parquet and CSV scans, the required-column guard,
the ``ecom`` namespace with its typed tables, and JSON document export.

Scans never select ``*`` for the caller: every reader returns the plain
DataFrame and the plans project what they need, so Catalyst prunes columns
and pushes filters into the Parquet reader (``ReadSchema`` / ``PushedFilters``
in ``explain``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from vitrine.functions.columns import month_key
from vitrine.session import hadoop_path

# Columns the offers-with-paths source must carry (A4).
CATALOG_REQUIRED = ["Partner_Name", "Category_ID", "Category_FullPathName",
                    "Offer_ID", "Offer_Name", "Offer_Type"]


def path_tag(path: str) -> str:
    """Short stable name for a folder URI (used in view and store names)."""
    return hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:12]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _files(spark: SparkSession, path: str) -> list[tuple[str, ...]]:
    """Path, size and time of every file of a table; one listing, done in the JVM."""
    p, fs = hadoop_path(spark, path)
    status = fs.getFileStatus(p)
    if status.isFile():
        return [(path, str(status.getLen()), str(status.getModificationTime()))]
    listed = spark.sparkContext._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().listLeafStatuses(fs, p).toString()
    return sorted(re.findall(r"path=([^;]+);[^}]*?length=(\d+);[^}]*?modification_time=(\d+)", listed))


def table_stamp(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> str:
    """State of the named tables: path, size and time of each of their files.

    Nothing is remembered: a table that grew, or in which a file was replaced,
    under the same path has another stamp at the next call.
    """
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    for n in sorted(names):
        h.update(f"|{n}|{_files(spark, table_path(sf_dir, n))}".encode())
    return h.hexdigest()[:12]


def session_view(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A temp view registered once per session, then looked up by name.

    The file listing and footer reads of a Parquet scan, and the analysis of
    a fixture mapping, happen when the view is created, not on every query.
    Names carry the state of the input (``table_stamp``), so a view of files
    that have changed is not found again.
    """
    try:
        return spark.table(name)
    except AnalysisException:
        build().createOrReplaceTempView(name)
        return spark.table(name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole-file Parquet scan of one driver table (A1, A2), registered as
    a session view on first use."""
    return session_view(spark, f"vitrine_{table_stamp(spark, sf_dir, [name])}_{name}",
                        lambda: spark.read.parquet(table_path(sf_dir, name)))


def require_columns(df: DataFrame, required: Iterable[str] = CATALOG_REQUIRED) -> DataFrame:
    """Abort on the driver, before any job runs, when columns are missing (A4)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in source: {missing}")
    return df


CSV_HEADER = "offer_id"
CSV_SCHEMA = ", ".join(f"_c{i} string" for i in range(6))
CSV_OPTIONS = {"escape": '"', "emptyValue": ""}
# Pieces of quoted text (below) up to this number are sent to all tasks; beyond, lines meet them in a shuffle.
PIECES_SENT = 100_000
_CHUNK_BITS = 10


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines ``(file, block, line, value)`` of CSV files: ``block`` is
    where the split that holds the line begins, ``line`` a number that rises
    along a split.  Spark cuts files into splits as it does for any text."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"), "value"))


def quoted_pieces(lines: DataFrame) -> DataFrame:
    """Runs of lines that belong to one record: ``(file, block, from, to, record)``.

    A line with an odd number of quotes opens or closes quoted text that holds
    line feeds.  Each split lists such lines; how many lie in the splits before
    it (a running sum over a row per split) says whether it begins inside
    quotes, and the lines pair up from there.  A record that crosses splits has
    a piece in each.  A file whose quotes do not pair raises.
    """
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'))), F.lit(2)) == 1
    per = lines.groupBy("file", "block").agg(F.min("line").alias("lo"), F.max("line").alias("hi"),
                                             F.sort_array(F.collect_list(F.when(odd, F.col("line")))).alias("odd")).withColumn("n", F.size("odd"))
    split = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("before", F.coalesce(F.sum("n").over(split), F.lit(0)))
              .withColumn("total", F.sum("n").over(Window.partitionBy("file"))))
    none = F.array().cast("array<bigint>")
    edges = F.concat(F.when(F.col("before") % 2 == 1, F.array("lo")).otherwise(none), "odd",
                     F.when((F.col("before") + F.col("n")) % 2 == 1, F.array("hi")).otherwise(none))
    unpaired = F.raise_error(F.concat("file", F.lit(": a quote is never closed"))).cast("bigint")
    first = F.when(F.col("total") % 2 == 1, unpaired).otherwise(F.floor(F.col("before") / 2))
    pieces = F.transform(F.sequence(F.lit(0), (F.size("edges") / 2 - 1).cast("int")), lambda j: F.struct(
        F.get("edges", (2 * j).cast("int")).alias("from"), F.get("edges", (2 * j + 1).cast("int")).alias("to"), (F.col("first") + j).cast("bigint").alias("record")))
    return (per.withColumn("edges", edges).where(F.size("edges") > 0).withColumn("first", first)
               .select("file", "block", F.inline(pieces)))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV records as text, one a row, read by as many tasks as the files have
    splits although quoted fields may hold line feeds (RFC 4180 quotes).

    The files are read once for the pieces (``quoted_pieces``, run here).  Lines
    in no piece are records; the others are joined in order.  Lines find their
    piece by split and a run of line numbers: the pieces are broadcast if they
    are at most ``PIECES_SENT``, which is checked, else the planner joins them.
    """
    lines, pieces = csv_lines(spark, path), quoted_pieces(csv_lines(spark, path))
    found = pieces.limit(PIECES_SENT + 1).toArrow()
    if found.num_rows == 0:
        return _whole_records(lines)
    runs = F.explode(F.sequence(F.shiftright("from", _CHUNK_BITS), F.shiftright("to", _CHUNK_BITS)))
    few = found.num_rows <= PIECES_SENT
    held = (spark.createDataFrame(found) if few else pieces).withColumn("chunk", runs)
    held = F.broadcast(held) if few else held
    at = lines.withColumn("chunk", F.shiftright("line", _CHUNK_BITS))
    meets = [at[c] == held[c] for c in ("file", "block", "chunk")] + [at["line"].between(held["from"], held["to"])]
    whole = at.join(held, meets, "left_anti")
    parts = at.join(held, meets).select(at["file"], "record", at["block"], "line", "value")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n")
    return _whole_records(whole.select("value").unionByName(parts.groupBy("file", "record").agg(text.alias("value")).select("value")))


def _whole_records(text: DataFrame) -> DataFrame:
    """Without the carriage return of a line's end, and without empty lines."""
    return text.select(F.regexp_replace("value", r"\r\z", "").alias("value")).where(F.col("value") != "")


def read_offers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Positional catalogue CSV with its header line kept as data.

    Columns arrive as ``_c0.._c5`` (``c1..c6`` in the original); ``_c0`` is
    unused.  Quotes inside quoted text are doubled (RFC 4180), and quoted text
    may hold line feeds; a file is read by as many tasks as it has splits
    (``csv_records``).  The file has no nulls: an
    empty field, quoted or not, is empty text, so a vendor may be empty and an
    empty or malformed number raises as the original conversion functions do.
    Only rows whose id is the header's text are removed.
    """
    raw = csv_records(spark, path).select(F.from_csv("value", CSV_SCHEMA, CSV_OPTIONS).alias("r")).select("r.*")
    text = {i: F.coalesce(F.col(f"_c{i}"), F.lit("")) for i in range(1, 6)}
    return (raw.where(text[1] != CSV_HEADER)
               .select(text[1].cast("bigint").alias("offer_id"),
                       text[2].cast("double").alias("price"),
                       text[3].cast("bigint").alias("seller_id"),
                       text[4].cast("bigint").alias("category_id"),
                       text[5].alias("vendor")))


def write_offers_csv(offers: DataFrame, path: str) -> None:
    """Write a catalogue CSV in the source layout: leading unused column and
    one header line per file (each part file starts with it)."""
    (offers.select(F.lit("0").alias("ix"), "offer_id", "price", "seller_id", "category_id", "vendor")
           .write.mode("overwrite").option("header", "true").option("escape", '"').option("emptyValue", '""').csv(path))


# ---------------------------------------------------------------- namespace
def create_ecom_tables(spark: SparkSession, db: str = "ecom", location: str | None = None) -> None:
    """``CREATE DATABASE`` / typed tables with a default and derived
    partition columns (A5, A6).

    Month and day partitions are explicit columns derived on insert
    (``snapshot_month = year*100 + month``, ``event_date = to_date(Hour)``),
    which gives static and dynamic partition pruning on reads.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {db}.ecom_offers (
            snapshot_date DATE DEFAULT current_date(),
            offer_id BIGINT, price DOUBLE, seller_id BIGINT,
            category_id BIGINT, vendor STRING, snapshot_month INT)
        USING parquet PARTITIONED BY (snapshot_month)""")
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {db}.raw_events (
            Hour TIMESTAMP_NTZ, DeviceTypeName STRING, ApplicationName STRING,
            OSName STRING, ProvinceName STRING, ContentUnitID BIGINT, event_date DATE)
        USING parquet PARTITIONED BY (event_date)""")


def insert_offers(spark: SparkSession, offers: DataFrame, db: str = "ecom",
                  snapshot_date: Column | None = None, replace: bool = False) -> None:
    """Column-list insert (A7, G2, G3): without ``snapshot_date`` the column is
    not named and takes its default; the month partition is derived from the
    same day.  Rows are rebalanced by the partition column, so a month is
    written by few tasks in files of the advisory size.  With ``replace`` the
    rows take the place of all that the table holds, so that a load can be
    repeated."""
    day = F.current_date() if snapshot_date is None else snapshot_date
    rows = offers.select(*([] if snapshot_date is None else [day.alias("snapshot_date")]),
                         "offer_id", "price", "seller_id", "category_id", "vendor", month_key(day).alias("snapshot_month"))
    _insert(spark, rows, f"{db}.ecom_offers", "snapshot_month", replace)


def insert_raw_events(spark: SparkSession, events: DataFrame, db: str = "ecom", replace: bool = False) -> None:
    """Column-list insert of events, the day partition derived from ``Hour``."""
    rows = events.select("Hour", "DeviceTypeName", "ApplicationName", "OSName", "ProvinceName", "ContentUnitID",
                         F.to_date("Hour").alias("event_date"))
    _insert(spark, rows, f"{db}.raw_events", "event_date", replace)


_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _insert(spark: SparkSession, rows: DataFrame, target: str, partition: str, replace: bool) -> None:
    mode = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "static")
    try:
        spark.sql(f"INSERT {'OVERWRITE' if replace else 'INTO'} {target} ({', '.join(rows.columns)}) SELECT * FROM {{rows}}",
                  rows=rows.hint("rebalance", partition))
    finally:
        spark.conf.set(_OVERWRITE, mode)


_LOADED = "vitrine.loaded"


def loaded_on(spark: SparkSession, db: str) -> str | None:
    """The day of the load that filled the namespace, None while none has done so to the end."""
    if not spark.catalog.databaseExists(db):
        return None
    about = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {db}").collect()}
    found = re.search(rf"\({re.escape(_LOADED)},\s*([0-9-]+)\)", about.get("Properties") or "")
    return found and found[1]


def load_namespace(spark: SparkSession, offers: DataFrame, raw_events: DataFrame, db: str = "ecom", location: str | None = None) -> str:
    """Fill the namespace once (A5-A7): both tables are made and loaded, then the
    namespace is marked with the day of the load.  A run that dies before the
    mark is repeated whole by the next call.  Returns the day."""
    day = loaded_on(spark, db)
    if day is None:
        day = str(spark.sql("SELECT current_date()").first()[0])
        create_ecom_tables(spark, db, location)
        insert_offers(spark, offers, db, replace=True)
        insert_raw_events(spark, raw_events, db, replace=True)
        spark.sql(f"ALTER DATABASE {db} SET DBPROPERTIES ('{_LOADED}' = '{day}')")
    return day


# ---------------------------------------------------------------- JSON sink
def iso_text(ts: Column) -> Column:
    """ISO-8601 text of a timestamp: seconds, plus microseconds when non-zero."""
    return F.when(F.date_format(ts, "SSSSSS") == "000000",
                  F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def to_json_documents(df: DataFrame, keys: list[str], id_col: str = "_id") -> DataFrame:
    """One JSON text per document with the chosen keys.

    Non-ASCII text is written as is; timestamps are rendered as ISO text by
    the caller (``iso_text``) so the output does not depend on writer options.
    """
    doc = F.to_json(F.struct(*[F.col(k) for k in keys]), {"ignoreNullFields": "false"})
    return df.select(F.col(id_col), doc.alias("doc_json"))


def write_json_documents(df: DataFrame, path: str) -> None:
    df.select("doc_json").write.mode("overwrite").text(path)
