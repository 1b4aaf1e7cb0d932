"""Operator 7, benchmark decontamination: size-partitioned MinHash containment search.

Containment of a test item in a document is the share of the item's distinct
five-word shingles that the document has.  A short item in a long document has
a Jaccard similarity near 0, so the two sides are not sketched alike: an item
of n shingles is kept as its MinHash sketch, the k smallest shingle hashes,
and a document is probed with all of its shingles.  k depends on the item's
size class (powers of two): with n - ceil(t n) + need hashes in the sketch, a
document that holds a share t of the item holds at least `need` of them, so
the search has no false negatives, and larger classes ask for more hits.
Documents with fewer shingles than the item needs are skipped by size.  What
remains is verified by exact containment over the shingles themselves.

The documents are read once, in place: no shuffle, and memory for one batch.
The sketches go to the tasks in blocks of at most `BLOCK_BYTES` as an index; a
larger benchmark takes more blocks, each a pass over the documents.

Words are runs of letters and digits (and of anything beyond ASCII) of the
lower-cased text.  An item of one to four words has its whole sequence as its
only shingle, and documents are probed with shingles of each such length that
items have; an item without words is never found.

Defined results: null text has no words; repeated documents and items each
give their rows; null ids are carried; extra columns are ignored by
`find_contained` and kept by `drop_contaminated`; an empty side gives nothing
found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vitrine.llm.common import free, map_batches, table

WIDTH, SHARE = 5, 0.8
#: Bytes of a block of items as an index, and those of an item besides twice its text.
BLOCK_BYTES, ITEM_BYTES = 64 << 20, 100
_NOT_WORD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_NOT_WORD).split()


def shingle_keys(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """A 64-bit key for each place of a shingle, in text order."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.zeros(len(words) - width + 1 if words else 0, np.uint64)
    for i in range(width):
        out = (out ^ h[i:i + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def shingle_texts(words: list[bytes], places, width: int = WIDTH) -> set[bytes]:
    return {b" ".join(words[p:p + width]) for p in places}


class ItemIndex:
    """Sketches of a block of items, by size class, with a bit table in front of the sorted hashes.

    Flat arrays all through: of an item of n shingles about n / 5 hashes, its
    words as text, and some numbers; its shingles are taken from the words again
    when a document is verified.
    """

    def __init__(self, items: list[tuple[object, str | None]], share: float = SHARE):
        words, sketch, owner, sizes = [], [], [], []
        for key, text in items:
            own = words_of(text)
            if not own:
                continue
            width = min(WIDTH, len(own))
            n = len(shingle_texts(own, range(len(own) - width + 1), width))
            least = math.ceil(share * n - 1e-9)
            need = min(1 << max(0, n.bit_length() - 5), least)
            keys = np.unique(shingle_keys(own, width))[:n - least + need]
            sketch.append(keys)
            owner.append(np.full(len(keys), len(words), np.int32))
            sizes.append((width, n, least, need))
            words.append((key, b" ".join(own)))
        self.ids, texts = [w[0] for w in words], [w[1] for w in words]
        self.ends, self.text = np.cumsum([0, *map(len, texts)]), b"".join(texts)
        self.width, self.size, self.least, self.need = np.array(sizes, np.int32).reshape(-1, 4).T
        self.widths = np.unique(self.width).tolist()
        flat, own = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((sketch, np.uint64), (owner, np.int32)))
        order = np.argsort(flat, kind="stable")
        self.sketch, self.owner = flat[order], own[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.sketch >> np.uint64(44)).astype(np.int64)] = True

    @classmethod
    def of(cls, state: dict) -> ItemIndex:
        """The index whose attributes were broadcast."""
        index = cls.__new__(cls)
        index.__dict__ = state
        return index

    def contained(self, text: str | None) -> list[tuple[int, int]]:
        """(item, shared shingles) of every item of which `text` holds the share."""
        words = words_of(text)
        probes = {w: shingle_keys(words, w) for w in self.widths if w <= len(words)}  # short items have shingles of their own length
        hits = []
        for keys in probes.values():
            near = np.unique(keys[self.bits[(keys >> np.uint64(44)).astype(np.int64)]])
            low, high = np.searchsorted(self.sketch, near, "left"), np.searchsorted(self.sketch, near, "right")
            hits += [self.owner[a:b] for a, b in zip(low, high, strict=True) if b > a]
        if not hits:
            return []
        found = []
        for q, count in zip(*(x.tolist() for x in np.unique(np.concatenate(hits), return_counts=True)), strict=True):
            width = int(self.width[q])
            if count < self.need[q] or len(words) - width + 1 < self.least[q]:
                continue
            own = self.text[self.ends[q]:self.ends[q + 1]].split()
            places = np.nonzero(np.isin(probes[width], shingle_keys(own, width)))[0]
            shared = len(shingle_texts(words, places, width) & shingle_texts(own, range(len(own) - width + 1), width))
            if shared >= self.least[q]:
                found.append((q, shared))
        return found


def item_blocks(benchmark: DataFrame, share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> Iterator[ItemIndex]:
    """The benchmark in blocks whose size as an index was checked before they are brought to the driver."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text") * 2 + ITEM_BYTES).alias("n")).first().n or 0
    blocks = max(1, -(-total // block_bytes))
    for i in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield ItemIndex([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()], share)


def find_contained(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment: a row per document and item at or above `share`."""
    spark, out, item_type = docs.sparkSession, None, to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = docs.select("doc_id").schema.add(benchmark.schema["item_id"]).add("n_shared", "long").add("n_shingles", "long").add("containment", "double")
    for index in item_blocks(benchmark, share, block_bytes):
        sent = spark.sparkContext.broadcast(vars(index))

        def run(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            index, rows = ItemIndex.of(sent.value), []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows += [(d, index.ids[q], n, int(index.size[q]), n / int(index.size[q])) for q, n in index.contained(t)]
            kinds = [batch.column("doc_id").type, None, pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k] or item_type) for k in range(5)], names=schema.names)

        part = map_batches(docs.select("doc_id", "text"), run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs` that hold no item at or above `share`, with all their columns.

    One block of items filters the documents where they lie.  Of several, each
    is a pass of its own, so that no task holds two; what they find (doc_id and
    a hash of the text) is taken from the documents by one anti-join.
    """
    spark, found = docs.sparkSession, None
    blocks = list(item_blocks(benchmark, share, block_bytes))
    doc, text = free(docs, "found_doc"), free(docs, "found_text")
    for index in blocks:
        sent = spark.sparkContext.broadcast(vars(index))

        def kept(batch: pa.RecordBatch, sent=sent, want=len(blocks) == 1) -> pa.RecordBatch:
            index = ItemIndex.of(sent.value)
            return batch.filter(pa.array([(not index.contained(t)) == want for t in batch.column("text").to_pylist()], pa.bool_()))

        if len(blocks) == 1:
            return map_batches(docs, kept, docs.schema)
        part = map_batches(docs.select("doc_id", "text"), kept, docs.select("doc_id", "text").schema)
        part = part.select(F.col("doc_id").alias(doc), F.xxhash64("text").alias(text)).distinct()
        found = part if found is None else found.unionByName(part)
    return docs.join(found.distinct(), docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(text)), "left_anti")


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair at containment 0.8 or more, over the whole tables."""
    return find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+')"
_WINDOWS = "DISTINCT rid, width, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS s"

#: The same by joining all shingles: an item's are of five words, or all of its words if it has fewer, and a document's of every length that items have.
ORACLE = f"""
WITH i AS (SELECT row_number() OVER () AS rid, item_id, w, least(len(w), {WIDTH}) AS width FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i_s AS (SELECT {_WINDOWS} FROM i),
d_s AS (SELECT {_WINDOWS} FROM d, (SELECT DISTINCT width FROM i) WHERE len(w) >= width),
n AS (SELECT rid, count(*) AS n FROM i_s GROUP BY rid),
p AS (SELECT d_s.rid AS drid, i_s.rid AS irid, count(*) AS n_shared FROM d_s JOIN i_s USING (width, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n AS n_shingles, n_shared / n::DOUBLE AS containment
FROM p JOIN n ON n.rid = irid JOIN d ON d.rid = drid JOIN i ON i.rid = irid WHERE n_shared >= ceil({SHARE} * n - 1e-9)"""
