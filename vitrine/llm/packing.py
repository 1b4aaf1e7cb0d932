"""Operator 10, best-fit packing of token pieces into sequences of a fixed length.

Documents are tokenised in one pass; only those longer than a sequence are
cut, from the end, so that just the first piece may be shorter.  Pieces are
dealt by a hash of their row to packing tasks (so one long document, or one
text that is there a million times, is spread like any other), each of about
`PIECES` pieces, more where that would be over `MAX_TASKS` tasks, and each task
packs online with bounded space: `OPEN` open bins, kept by free space with a bitset over the free
spaces.  A piece goes to the open bin with the least free space that holds it;
if none does, a bin is opened, and when too many are open the fullest closes.
A task takes its pieces longest first, which leaves the short ones to fill
what the long ones left.

A task's memory is its open bins and one record batch; its waste at the end is
less than its last bins, a share that falls with `PIECES`.

Defined results: null and empty texts are a piece of the end id alone; repeated
rows are packed each; null doc_ids are carried; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import free, map_batches, table, written
from vitrine.llm.tokens import SLICE, encoder, vocabulary_path

LENGTH, OPEN, PIECES, MAX_TASKS = 2048, 32_768, 50_000, 20_000


class BestFit:
    """Online best fit with at most `most` open bins, each known by its free space."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most, self.bits, self.open, self.made = length, most, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def _take(self, free: int) -> int:
        bins = self.bins[free]
        got = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return got

    def place(self, n: int) -> tuple[int, int]:
        """(bin, offset) for a piece of `n` tokens."""
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            at = self._take(free)
        else:
            free, at = self.length, self.made
            self.made += 1
            if self.open == self.most and n < self.length:
                self._take((self.bits & -self.bits).bit_length() - 1)
        left = free - n
        if left:
            self.bins[left].append(at)
            self.bits |= 1 << left
            self.open += 1
        return at, self.length - free


def cut(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = total % length or min(total, length)
    return [(0, first), *((s, length) for s in range(first, total, length))]


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document."""
    path = path or vocabulary_path()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes = encoder(path).batch(batch.column("text"))
        raw, rows, out, base = memoryview(ids.tobytes()), [], [[] for _ in range(4)], 0
        for i, total in enumerate(sizes.tolist()):
            for k, (start, n) in enumerate(cut(total, length)):
                rows.append(i)
                for part, x in zip(out, (k, start, n, zlib.crc32(raw[4 * (base + start):4 * (base + start + n)])), strict=True):
                    part.append(x)
            base += total
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))],
                                          names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long", limit=SLICE)


def pack(pieces: DataFrame, length: int = LENGTH, most: int = OPEN, per_task: int = PIECES, max_tasks: int = MAX_TASKS) -> DataFrame:
    """`pieces` with sequence_id and offset; reads its input twice, so hand it a written table."""
    tasks = min(max_tasks, max(1, -(-pieces.count() // per_task)))
    row = free(pieces, "row")
    dealt = (pieces.withColumn(row, F.monotonically_increasing_id()).repartition(tasks, F.xxhash64(row))
             .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").drop(row))

    def run(batches):
        bins, base = BestFit(length, most), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                                             names=[*batch.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, pieces.schema.add("sequence_id", "long").add("offset", "long"))


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, most: int = OPEN, per_task: int = PIECES,
                   max_tasks: int = MAX_TASKS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece of `docs` (doc_id, text)."""
    return pack(written(token_pieces(docs, path, length), "pieces"), length, most, per_task, max_tasks)


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 10 over the whole of `documents`."""
    return pack_documents(table(spark, sf_dir, "documents"))
