"""Loading derived source tables into the store.

The reference loads its source files into tables before it queries them;
here a loaded table is a Parquet folder under the store, written once per
state of its inputs and registered as a session view.

Layout: ``rebalance`` sizes the files (AQE splits what is large and merges
what is small, by bytes, so one hot key is spread over as many files as its
rows need), and rows are sorted inside each file on keys that end in a unique
column.  A table whose reader needs it in order of a column (samples, by
time) is range partitioned on it into ``spark.sql.shuffle.partitions`` parts,
a number the cluster sets.  A table without such keys (the wide source rows)
is written by the tasks of its last join, which AQE merges and splits by
bytes too, so its rows are shuffled no more than the joins need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from vitrine.sources.store import shuffles_freed, store_path, store_view_name, write_once
from vitrine.sources.tables import session_view


def load_path(spark: SparkSession, sf_dir: str, name: str, inputs: Sequence[str]) -> str:
    return store_path(spark, f"tables/{name}", sf_dir, inputs)


def load_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
               cluster_by: Sequence[str] | None, inputs: Sequence[str], in_order: bool = False) -> DataFrame:
    """Write ``build()`` once as a clustered Parquet table (as it comes, without ``cluster_by``) and return it.

    The write only counts once its ``_SUCCESS`` marker is there; a lost
    job leaves no marker and the next call writes the table again.
    """
    path = load_path(spark, sf_dir, name, inputs)

    def write(target: str) -> None:
        df = build()
        if cluster_by:
            df = df.repartitionByRange(*cluster_by) if in_order else df.hint("rebalance")
            df = df.sortWithinPartitions(*cluster_by)
        with shuffles_freed(spark):
            df.write.parquet(target)

    return session_view(spark, store_view_name(path), lambda: spark.read.parquet(write_once(spark, path, write)))
