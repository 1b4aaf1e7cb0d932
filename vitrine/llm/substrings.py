"""Operator 12, substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

The documents are dealt into blocks of about `BLOCK_BYTES` of text, which ask
slices of the hash space (`blocks`).

1. Each window of `window` words has two rolling hashes of 64 bits.  Every
   block sends its distinct hashes, 32 bits beside the number of the slice
   they fall into, to the slices; a slice answers which of them two blocks
   hold.  A slice's length bounds the share of false answers (about 1 in 1,000).
2. The windows answered for send both hashes, 128 bits, with the first place
   of the block, once per block and hash; a slice answers which blocks do not
   hold the first place of all.
3. A block then knows each of its windows that starts earlier elsewhere or in
   itself; words under such windows merge into maximal spans and go.

A hash that stands in a third of all documents is one entry per block in its
slice.  Answers are a bit per entry.  Memory is a block, or a slice of about
`SLICE_BYTES` of text; one longer text is a block of its own.

Places are ordered by doc_id, then by start.  Defined results: null text has
no words; a null doc_id comes after all others; rows that repeat a doc_id are
one document whose windows at equal starts are neither earlier than the other,
so repeated rows each give the same row; documents shorter than a window keep
all; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.blocks import SENT, blocks_of, each, opened, sent, slice_bits, slice_range, total_bytes, unpacked, with_answers
from vitrine.llm.common import table, written

WINDOW = 20
BLOCK_BYTES, SLICE_BYTES, SLICE_ENTRIES = 8 << 20, 24 << 20, 1 << 20
#: Odd multipliers of the two rolling hashes, and the mixing between them.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4B)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_ENTRY = 28  # bytes: two hashes, doc_id, start with a bit for a null doc_id
_NULL = np.uint32(1 << 31)


def _powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rolling(words: np.ndarray, window: int, base: int) -> np.ndarray:
    """The Rabin-Karp hash of each window of `words` (64-bit numbers), in one pass by prefix sums."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(pow(base, -1, 1 << 64), len(words)), out=sums[1:])
    h = (sums[window:] - sums[:-window]) * _powers(base, len(words))[window - 1:]
    h ^= h >> np.uint64(33)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


class Block:
    """The words of some documents, and the hashes of their windows."""

    def __init__(self, payload: bytes, window: int):
        docs = opened(payload)
        self.window, self.ids = window, docs.column("doc_id").combine_chunks()
        self.words: list[bytes] = []
        self.ends = np.zeros(len(docs) + 1, np.int64)
        for i, text in enumerate(docs.column("text").to_pylist()):
            self.words += (text or b"").split()
            self.ends[i + 1] = len(self.words)
        word = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        sizes = np.diff(self.ends)
        kept = np.maximum(sizes - window + 1, 0)
        #: For each window its document and its first word in the block.
        self.doc = np.repeat(np.arange(len(sizes)), kept)
        self.at = np.arange(len(self.doc)) - np.repeat(np.cumsum(kept) - kept, kept) + np.repeat(self.ends[:-1], kept)
        other = (word ^ (word >> np.uint64(31))) * _MIX
        self.h1, self.h2 = (rolling(w, window, b)[self.at] if len(self.at) else np.zeros(0, np.uint64) for w, b in zip((word, other), _BASES, strict=True))

    def order(self, places: np.ndarray) -> np.ndarray:
        """Numbers that sort windows of the block by doc_id, null last, then by start."""
        null = self.ids.is_null().to_numpy(zero_copy_only=False)
        known = self.ids.fill_null(0).to_numpy()
        rank = np.where(null, len(known), np.unique(known, return_inverse=True)[1])
        return (rank[self.doc[places]] << 32) | self.start(places)

    def start(self, places: np.ndarray) -> np.ndarray:
        return self.at[places] - self.ends[self.doc[places]]

    def keys(self, bits: int) -> np.ndarray:
        """For each window the number of its slice and 32 bits more."""
        return self.h1 >> np.uint64(32 - bits)

    def shared(self, bits: int, answers: list[dict]) -> np.ndarray:
        """Whether each window's key was found in another block too."""
        keys = self.keys(bits)
        own, at = np.unique(keys, return_inverse=True)
        return _flags(own >> np.uint64(32), answers)[at] if len(own) else np.zeros(0, bool)

    def groups(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`places` by hash and order, the first of each hash among them, and each one's order."""
        order = self.order(places)
        by = np.lexsort((order, self.h2[places], self.h1[places]))
        places, order = places[by], order[by]
        new = np.ones(len(places), bool)
        new[1:] = (self.h1[places[1:]] != self.h1[places[:-1]]) | (self.h2[places[1:]] != self.h2[places[:-1]])
        return places, np.nonzero(new)[0], order


def _flags(slices: np.ndarray, answers: list[dict]) -> np.ndarray:
    """The answers of the slices, for entries in order of their slice."""
    out = np.zeros(len(slices), bool)
    for x in answers:
        at = slice_range(slices, x["slice"])
        out[at] = unpacked(x["flags"], at.stop - at.start)
    return out


# ---------------------------------------------------------------- the two counts
_ANSWER = "part long, block long, slice long, flags binary, n long"


def _answered(group: pa.Table, flagged: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """For each body the bits of its entries, if any is set."""
    ends = np.cumsum(sizes)
    rows = [(p, k, s, np.packbits(f).tobytes(), int(f.sum())) for p, k, s, f in zip(*(group.column(c).to_pylist() for c in ("part", "block", "slice")), np.split(flagged, ends[:-1]), strict=True) if f.any()]
    kinds = [("part", pa.int64()), ("block", pa.int64()), ("slice", pa.int64()), ("flags", pa.binary()), ("n", pa.int64())]
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(kinds)})


def shared_keys(blocks: DataFrame, window: int, bits: int) -> DataFrame:
    """Answers to the blocks: which of their keys, in order, another block holds too."""
    def send(batches):
        for part, number, payload in each(batches):
            keys = np.unique(Block(payload, window).keys(bits))
            yield from sent(part, number, keys >> np.uint64(32), lambda a, b: (keys[a:b] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())  # noqa: B023

    def count(group: pa.Table) -> pa.Table:
        bodies = group.column("body").to_pylist()
        keys = np.frombuffer(b"".join(bodies), "<u4")
        by = np.argsort(keys, kind="stable")
        same = keys[by[1:]] == keys[by[:-1]]
        flagged = np.zeros(len(keys), bool)
        flagged[by[1:][same]] = flagged[by[:-1][same]] = True
        return _answered(group, flagged, np.array([len(b) // 4 for b in bodies]))

    return blocks.mapInArrow(send, SENT).groupBy("slice").applyInArrow(count, _ANSWER)


def later_windows(blocks: DataFrame, shared: DataFrame, window: int, bits: int, entry_bits: int) -> DataFrame:
    """Answers to the blocks: which of the windows they share start earlier in another block."""
    def send(batches):
        for part, number, payload, answers in each(batches, "shared"):
            block = Block(payload, window)
            places = np.nonzero(block.shared(bits, answers))[0]
            places, first, _ = block.groups(places)
            places = places[first]
            ids = block.ids.take(pa.array(block.doc[places]))
            start = block.start(places).astype("<u4") | np.where(ids.is_null().to_numpy(zero_copy_only=False), _NULL, np.uint32(0))
            parts = [block.h1[places], block.h2[places], ids.fill_null(0).to_numpy(), start.astype("<u4")]
            yield from sent(part, number, block.h1[places] >> np.uint64(64 - entry_bits), lambda a, b: b"".join(x[a:b].tobytes() for x in parts))  # noqa: B023

    def count(group: pa.Table) -> pa.Table:
        bodies = group.column("body").to_pylist()
        sizes = np.array([len(b) // _ENTRY for b in bodies])
        cut = lambda kind, skip: np.concatenate([np.frombuffer(b, kind, n, skip * n) for b, n in zip(bodies, sizes.tolist(), strict=True)])
        h1, h2, doc, start = cut("<u8", 0), cut("<u8", 8), cut("<i8", 16), cut("<u4", 24)
        null, start = start & _NULL, start & ~_NULL
        by = np.lexsort((start, doc, null, h2, h1))
        new = np.ones(len(by), bool)
        new[1:] = (h1[by[1:]] != h1[by[:-1]]) | (h2[by[1:]] != h2[by[:-1]])
        first = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
        flagged = np.zeros(len(by), bool)
        flagged[by] = (null[by] != null[first]) | (doc[by] != doc[first]) | (start[by] != start[first])
        return _answered(group, flagged, sizes)

    return with_answers(blocks, {"shared": shared}, "inner").mapInArrow(send, SENT).groupBy("slice").applyInArrow(count, _ANSWER)


# ---------------------------------------------------------------- removal
def covered(block: Block, shared: np.ndarray, later: list[dict], entry_bits: int) -> np.ndarray:
    """Whether each word of the block goes."""
    by = np.argsort(block.h1, kind="stable")
    same = block.h1[by[1:]] == block.h1[by[:-1]]
    asked = shared.copy()
    asked[by[1:][same]] = asked[by[:-1][same]] = True
    places, first, order = block.groups(np.nonzero(asked)[0])
    gone = np.zeros(len(block.words) + 1, np.int64)
    if len(places):
        sizes = np.diff(np.append(first, len(places)))
        elsewhere, heads = np.zeros(len(first), bool), places[first]
        sent = shared[heads]
        elsewhere[sent] = _flags(block.h1[heads[sent]] >> np.uint64(64 - entry_bits), later)
        at = block.at[places[np.repeat(elsewhere, sizes) | (order > np.repeat(order[first], sizes))]]
        np.add.at(gone, at, 1)
        np.subtract.at(gone, at + block.window, 1)
    return np.cumsum(gone)[:-1] > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans, kept: a row per row of docs (doc_id, text).

    `spans` are the maximal runs of removed words (start, end exclusive), `kept`
    is the text of the others, joined by single spaces.
    """
    blocks = blocks_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), block_bytes)
    bits = slice_bits(total_bytes(blocks), slice_bytes)
    shared = written(shared_keys(blocks, window, bits), "shared-windows")
    entry_bits = slice_bits(shared.agg(F.sum("n")).first()[0] or 0, SLICE_ENTRIES)
    later = later_windows(blocks, shared, window, bits, entry_bits)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def remove(batches):
        for _, _, payload, answers, further in each(batches, "shared", "later"):
            block = Block(payload, window)
            gone = covered(block, block.shared(bits, answers), further, entry_bits)
            spans, kept, removed = [], [], []
            for a, b in itertools.pairwise(block.ends.tolist()):
                own = gone[a:b]
                edges = np.nonzero(np.diff(own, prepend=False, append=False))[0].tolist()
                spans.append([{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2], strict=True)])
                removed.append(int(own.sum()))
                kept.append(b" ".join(itertools.compress(block.words[a:b], (~own).tolist()) if edges else block.words[a:b]))
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(np.diff(block.ends)), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return with_answers(blocks, {"shared": shared, "later": later}, "left").mapInArrow(remove, "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 12 over the whole of `documents`."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
