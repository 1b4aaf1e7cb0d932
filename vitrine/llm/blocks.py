"""Documents in blocks, and answers from slices of a hash space to them.

What a corpus-wide count says about a document has to meet its text again.
Documents are dealt into blocks, written once: a row per block, bucketed by the
part of the table it is from.  A block sends keys to slices (ranges of a 64-bit
hash), each in one row with a binary body; a slice, gathered in one task,
answers each block; and the answers, grouped by part, are joined with the
blocks, whose text is not moved.  A block works out its keys anew when it reads
its answers, so answers need not repeat them.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import shared_folder, sliced

#: What a block sends to a slice.
SENT = "slice long, part long, block long, body binary"


#: The bytes that Spark puts into one record batch, at most (a longer row is alone).
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """What is run inside hands rows to Python in batches of `n_bytes`; they are off the heap on both sides."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def _filled(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """The same rows in tables of about `limit` bytes of text, also of several batches."""
    held, size = [], 0
    for batch in itertools.chain.from_iterable(sliced([b], "text", limit) for b in batches):
        n = batch.column("text").nbytes
        if held and size + n > limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.Table.from_batches(held)


def blocks_of(docs: DataFrame, block_bytes: int, level: int = 1) -> DataFrame:
    """(part, block, n_bytes, payload), written: docs (text and other columns) in blocks of about `block_bytes` of text.

    Parts are numbered so that each is a bucket of its own, as even as the
    scan's tasks; a longer text is a block alone.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [r.part for r in spark.range(64 * buckets).groupBy(F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket")).agg(F.min("id").alias("part")).orderBy("bucket").collect()]

    def pack(batches):
        task = TaskContext.get().partitionId()
        part, n = parts[task % len(parts)], task << 32
        for rows in _filled(batches, block_bytes):
            held = rows.set_column(rows.schema.get_field_index("text"), "text", rows.column("text").cast(pa.binary())).combine_chunks()
            text = held.column("text")
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as out:
                out.write_table(held)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((part, pa.int64()), (n, pa.int64()), (text.nbytes, pa.int64()), (sink.getvalue().to_pybytes(), pa.binary()))],
                                             names=["part", "block", "n_bytes", "payload"])
            n += 1

    rows = docs.mapInArrow(pack, "part long, block long, n_bytes long, payload binary")
    name = f"vitrine_blocks_{uuid.uuid4().hex}"
    (rows.write.format("parquet").option("path", f"{shared_folder(spark)}/llm/{name}")
         .bucketBy(buckets, "part").sortBy("part").saveAsTable(name))
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame that reads them; only the catalogue forgets the name
    return held


def total_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum("n_bytes")).first()[0] or 0


def opened(payload: bytes) -> pa.Table:
    """The documents of a block, text as bytes."""
    with pa.ipc.open_stream(payload) as stream:
        return stream.read_all().combine_chunks()


def slice_bits(total: int, each: int) -> int:
    """Bits that number the slices, a power of two of them, so that one holds about `each` of `total`."""
    return max(1, (max(1, total // each) - 1).bit_length())


def cuts(slices: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(slice, from, to) of the runs of equal numbers."""
    at = np.append(np.nonzero(np.diff(slices, prepend=slices[:1] + np.uint64(1)))[0], len(slices))
    for a, b in itertools.pairwise(at.tolist()):
        yield int(slices[a]), a, b


def sent(part: int, block: int, slices: np.ndarray, body: Callable[[int, int], bytes]) -> Iterator[pa.RecordBatch]:
    """A row per slice with `body(from, to)` of its entries, which come in order of their slice."""
    rows = [(k, part, block, body(a, b)) for k, a, b in cuts(slices)]
    if rows:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["slice", "part", "block", "body"])


def with_answers(blocks: DataFrame, answers: dict[str, DataFrame], how: str) -> DataFrame:
    """(part, block, payload, name...): blocks with all answers (part, block, ...) to their part, by name."""
    out = blocks
    for name, frame in answers.items():
        own = (frame.groupBy("part").agg(F.collect_list(F.struct(*[c for c in frame.columns if c != "part"])).alias(name))
                    .withColumnRenamed("part", f"part_{name}"))
        out = out.join(own.hint("merge"), out["part"] == own[f"part_{name}"], how)
    return out.select("part", "block", "payload", *answers)


def each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """(part, block, payload, answers...) row by row, of the answers (dicts) those to the block."""
    for batch in batches:
        for row in range(batch.num_rows):
            part, block, payload = (batch.column(c)[row].as_py() for c in ("part", "block", "payload"))
            yield part, block, payload, *([x for x in batch.column(n)[row].as_py() or () if x["block"] == block] for n in names)


def slice_range(slices: np.ndarray, number: int) -> slice:
    """Where the entries of one slice stand among entries in order of their slice."""
    return slice(*np.searchsorted(slices, [np.uint64(number), np.uint64(number + 1)]))


def unpacked(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
