"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text below this many characters is handed to Python in one record batch.
BATCH_CHARS = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one input table; Spark's reader is the only thing that opens the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Where a local session without ``spark.checkpoint.dir`` keeps its scratch folder's name.
SCRATCH_CONF = "spark.vitrine.scratch"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only on a local master without one."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_CONF, None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="vitrine-llm-")
        spark.conf.set(SCRATCH_CONF, d)
    return d.rstrip("/")


def free(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until `df` has no column called so."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write `df` as Parquet below the shared folder and read it back.

    The write goes through Spark's commit protocol, so a lost executor costs
    its running tasks only, and later readers never recompute the input.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of `column` at most (one longer text stays whole)."""
    for b in batches:
        k = b.schema.get_field_index(column)
        if b.num_rows < 2 or b.column(k).nbytes <= limit:
            yield b
            continue
        start = held = 0
        for i, n in enumerate(pa.compute.binary_length(b.column(k)).to_pylist()):
            if held and held + (n or 0) > limit:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        yield b.slice(start)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema, column: str = "text", limit: int = BATCH_CHARS) -> DataFrame:
    """`fn` over the record batches of `df`, each of bounded size."""
    def run(it):
        for b in sliced(it, column, limit):
            yield fn(b)
    return df.mapInArrow(run, schema)


def ascii_lower(text):
    """Column: `text` (null: empty) so lower-cased that ASCII words compare as if only A-Z were folded.

    The Kelvin sign is the one character outside ASCII that folds to an ASCII
    letter by itself; it is moved aside first.  Every other fold keeps
    characters above U+007F, which words here never match.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
