"""Operator 5, token-ID output: canonical length-limited Huffman coding of ids from global counts.

Layout of a token file folder (Parquet as the container, so every part is
written through Spark's commit protocol and read where Spark reads):

* ``ids``: ids of each document as tokenised, the one table that is read more
  than once;
* ``code``: (id, length), the code lengths; codes are canonical, so that is all;
* ``blocks``: (file, block, first, doc_ids, sizes, marks, payload). Files ascend
  by doc_id and so do the blocks in a file and the documents in a block.
  ``first`` is the number of ids before the block in its file.  A block is
  decoded on its own: each document begins at a whole byte, and ``marks`` has
  the bit offset of every `EVERY`-th id of each document, so its segments are
  decoded in step through a table.

Counting, coding and decoding work on record batches; the counts that reach
the driver are at most one per id of the vocabulary, the totals one per file.
Files are ranges of (doc_id, hash of the ids, row), found by Spark's own range
partitioning, so rows that share an id, or are all alike, are cut like any
others.  Documents move once, as ids, and are coded where their file is
written.  There are at most `MAX_FILES` files: beyond that they get larger, in
blocks of the same size, and what the driver holds and broadcasts of them, a
row per file, does not grow.

Defined results: null and empty texts have the end id alone; documents with
equal doc_ids stand in the order of a hash of their ids; null doc_ids come
first; extra columns are ignored; an empty table gives no blocks.  doc_id may
be of any type that Spark sorts.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, shared_folder, sliced, table
from vitrine.llm.huffman import LIMIT, Code, code_lengths
from vitrine.llm.tokens import SLICE, encoder, vocabulary_path

#: Ids to a file and coded bytes to a block, about; ids from one checkpoint to the next.
FILE_IDS, BLOCK_BYTES, EVERY = 16_000_000, 4 << 20, 512
#: Files at most; more ids make larger files.
MAX_FILES = 20_000
#: Bytes of ids that are counted or coded at a time.
CODED = 1 << 20


@dataclass
class TokenFiles:
    folder: str

    def part(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{name}")


def _tokenised(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n, ids (little-endian, 16 bits each if the vocabulary allows)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        ids, sizes = own.batch(batch.column("text"))
        width = 2 if own.tokenizer.get_vocab_size() <= 1 << 16 else 4
        offsets = np.concatenate([[0], np.cumsum(sizes) * width]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(f"<u{width}"))])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), binary], names=["doc_id", "n", "ids"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, ids binary", limit=SLICE)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows in a row, ids of each row), read in place."""
    sizes, column = batch.column("n").to_numpy(), batch.column("ids")
    if not len(column):
        return np.zeros(0, np.uint16), sizes
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    raw = memoryview(column.buffers()[2] or b"")[offsets[0]:offsets[-1]]
    return np.frombuffer(raw, f"<u{max(2, len(raw) // max(1, int(sizes.sum())))}"), sizes


def id_counts(ids: DataFrame) -> DataFrame:
    """(id, count) over a tokenised table, summed in each task before the shuffle."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in sliced(batches, "ids", CODED):
            got = np.bincount(_flat(batch)[0], minlength=len(total))
            got[:len(total)] += total
            total = got
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return ids.select("n", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, file_ids: int = FILE_IDS,
                      block_bytes: int = BLOCK_BYTES, every: int = EVERY, max_files: int = MAX_FILES) -> TokenFiles:
    """Tokenise `docs` (doc_id, text) and write the folder."""
    spark, files = docs.sparkSession, TokenFiles(folder)
    _tokenised(docs, path or vocabulary_path()).write.option("compression", "zstd").parquet(f"{folder}/ids")
    ids = files.part(spark, "ids")
    counts = id_counts(ids).collect()  # no more rows than the vocabulary has
    count = np.zeros(max((r.id for r in counts), default=0) + 1, np.int64)
    count[[r.id for r in counts]] = [r.n for r in counts]
    lengths = code_lengths(count)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.nonzero(lengths)[0]], "id long, length int").coalesce(1).write.parquet(f"{folder}/code")

    n_files = min(max_files, max(1, -(-int(count.sum()) // file_ids)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["file", "block", "first", "doc_ids", "sizes", "marks", "payload"]

    def blocks(batches):
        code, file, block, first = Code(lengths), TaskContext.get().partitionId(), 0, 0
        held, size = [], 0  # (doc_id, ids, marks, coded bytes) of the documents of the open block

        def made(doc_type):
            docs, sizes, marks, payload = zip(*held, strict=True)
            place = np.cumsum([0] + [8 * len(p) for p in payload[:-1]])
            marks = b"".join((m + p).astype("<u8").tobytes() for m, p in zip(marks, place, strict=True))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(doc_type), pa.list_(pa.int64()), pa.binary(), pa.binary())
            row = (file, block, first, docs, sizes, marks, b"".join(payload))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            kept = batch.column("doc_id").type
            for part in sliced([batch], "ids", CODED):
                flat, sizes = _flat(part)
                payload, marks = code.pack(flat, sizes, every)
                for one in zip(part.column("doc_id").to_pylist(), sizes.tolist(), marks, payload, strict=True):
                    if held and size + len(one[3]) > block_bytes:
                        yield made(kept)
                        block, first, held, size = block + 1, first + sum(x[1] for x in held), [], 0
                    held.append(one)
                    size += len(one[3])
        if held:
            yield made(kept)

    # the row number only tells rows that are all alike apart; `ids` is written, so it is the same when a task is run again
    order = ("doc_id", "k", "row")
    (ids.select("doc_id", "n", "ids", F.xxhash64("ids").alias("k"), F.monotonically_increasing_id().alias("row"))
     .repartitionByRange(n_files, *order).sortWithinPartitions(*order).select("doc_id", "n", "ids")
     .mapInArrow(blocks, f"file int, block int, first long, doc_ids array<{kind}>, sizes array<long>, marks binary, payload binary")
     .write.option("compression", "uncompressed").parquet(f"{folder}/blocks"))
    return files


def read_token_files(spark: SparkSession, files: TokenFiles, every: int = EVERY) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the blocks alone."""
    rows = files.part(spark, "code").collect()  # no more than the vocabulary has
    lengths = np.zeros(max((r.id for r in rows), default=0) + 1, np.uint8)
    lengths[[r.id for r in rows]] = [r.length for r in rows]
    blocks = files.part(spark, "blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        code = Code(lengths)
        for batch in batches:
            for k in range(batch.num_rows):
                file, first, docs, sizes, marks, payload = (batch.column(c)[k] for c in ("file", "first", "doc_ids", "sizes", "marks", "payload"))
                n = sizes.values.to_numpy()
                parts = -(-n // every)
                segments = np.full(int(parts.sum()), every)
                segments[np.cumsum(parts) - 1] = n - (parts - 1) * every
                ids = code.unpack(payload.as_py(), np.frombuffer(marks.as_py(), "<u8"), segments).astype("<u4")
                start = np.cumsum(n) - n
                crc = [zlib.crc32(ids[a:a + x]) for a, x in zip(start.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([file.as_py()] * len(n), pa.int32()), docs.values, pa.array(start + first.as_py(), pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                                 names=["file", "doc_id", "start", "n_tokens", "ids_crc32"])

    # a sum per file, of which there are `MAX_FILES` at most; the running total over them is the only thing that needs their order
    totals = blocks.select("file", F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy("file").agg(F.sum("n").alias("n"))
    sums = sorted((r.file, r.n) for r in totals.collect())
    before, offsets = 0, []
    for file, n in sums:
        offsets.append((file, before))
        before += n
    offsets = spark.createDataFrame(offsets, "file int, before long")
    return (blocks.mapInArrow(run, f"file int, doc_id {kind}, start long, n_tokens long, ids_crc32 long")
            .join(F.broadcast(offsets), "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 5 over the whole of `documents`, read back from the files."""
    files = write_token_files(table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/llm/token-files-{uuid.uuid4().hex}")
    return read_token_files(spark, files)
