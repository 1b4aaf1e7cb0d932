"""The shared store: where loaded tables, pre-aggregates, documents and
stream outputs are written (``vitrine.session.store_root``)."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from vitrine import __version__
from vitrine.session import hadoop_path, store_root
from vitrine.sources.tables import path_tag, session_view, table_stamp


def _code_version() -> str:
    """Hash of the package source: stored outputs are keyed by it, so code
    that computes something differently never reads tables built before."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1(__version__.encode())
    for d, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:10]


STORE_VERSION = _code_version()


def store_path(spark: SparkSession, name: str, sf_dir: str, inputs: Iterable[str]) -> str:
    """Folder of an output derived from the named tables of one input folder:
    keyed by path, state of those tables and code version, so neither changed
    inputs nor changed code reuse an old output."""
    tag = hashlib.sha1(f"{table_stamp(spark, sf_dir, inputs)}|{STORE_VERSION}".encode()).hexdigest()[:12]
    return f"{store_root(spark)}/{name}/{tag}"


def stream_path(spark: SparkSession, name: str, sf_dir: str, version: int) -> str:
    """Folder of a stream's output and checkpoint: keyed by input path, query
    and the version of the output's schema alone, so a later run goes on where
    the last one stopped, whatever files have come since."""
    return f"{store_root(spark)}/stream/v{version}/{name}/{path_tag(sf_dir)}"


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def _builds(spark: SparkSession, path: str) -> list[str]:
    """Finished builds below ``path``, the first finished one first."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    done = []
    for st in fs.listStatus(p):
        mark, _ = hadoop_path(spark, f"{st.getPath().toString()}/_SUCCESS")
        if st.isDirectory() and fs.exists(mark):
            done.append((fs.getFileStatus(mark).getModificationTime(), st.getPath().getName()))
    return [f"{path}/{name}" for _, name in sorted(done)]


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: Spark removes those of a
    query when it has ended, not when the driver happens to collect its plan."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


def write_once(spark: SparkSession, path: str, write) -> str:
    """Build-once write: ``write(folder)`` fills a folder of its own below
    ``path``; the first build with a ``_SUCCESS`` marker is the one that
    readers take.  Nothing is renamed or deleted, so a writer that dies, or
    two that write at once, never touch a folder that is being read."""
    done = _builds(spark, path)
    if not done:
        write(f"{path}/build-{uuid.uuid4().hex}")
        done = _builds(spark, path)
    return done[0]


def store_view_name(path: str) -> str:
    return f"vitrine_store_{path_tag(path)}"


def materialize(spark: SparkSession, path: str, build, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, spread: bool = True) -> DataFrame:
    """Read ``path`` if a finished build is there, else build and write it.

    Writing to storage is also how lineage is cut: readers start from the
    files, never from the plan that produced them.  The write goes through a
    ``rebalance`` on the partition columns: AQE then sizes output files to
    the advisory partition size (splitting skewed partitions, merging small
    ones), so a partitioned table gets a few right-sized files per
    partition value instead of one file per task and value.  A build that ends
    in a grouping has its rows spread by the grouping's own shuffle, whose
    small partitions AQE merges; with ``spread=False`` they are not sent again.

    The stored table is registered as a session view, so later reads skip
    the listing.  Nothing is cached: a caller who wants a table in memory
    caches it (``spark.catalog.cacheTable(store_view_name(path))``).
    """
    def write(target: str) -> None:
        df = build().hint("rebalance", *(partition_by or [])) if spread else build()
        if sort_by:
            df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        with shuffles_freed(spark):
            w.parquet(target)

    return session_view(spark, store_view_name(path), lambda: spark.read.parquet(write_once(spark, path, write)))
