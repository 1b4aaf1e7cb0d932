"""Operator 4, SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

Fingerprints are taken per document in one pass over record batches.  The
distinct ones are laid out in cells by their population counts: one count for
each 16-bit quarter.  Two fingerprints within the radius differ by at most the
radius over all four counts, so a pair of tiles whose counts lie further apart
is skipped, and nothing else is.  Cells are cut into tiles of about `TILE`
fingerprints by a hash; the pairs of tiles that remain are compared exactly
with numpy: exclusive-or, bit count.  Inside a pair of tiles the links found
are reduced to stars (no more edges than fingerprints) before they leave the
task.  Components are then found over the edges of distinct fingerprints, so
exact copies never meet in a group.

Pairs are made of tiles' numbers first, so that a full cell costs the task it is
in a short row per pair; the fingerprints are fetched by two joins on tiles, and
the pairs are dealt by a hash to as many tasks as their comparisons need
(`TASK_WORK` each, `MAX_TASKS` at most), however few bytes they are.

The table of cells has at most 17^4 rows and is the only thing broadcast by a
hint.  Comparisons grow with the square of the distinct fingerprints in a cell, about
1/2,000 of all pairs for even counts.

Defined results: null text and text without words have fingerprint 0; null
doc_ids get a fingerprint and the smallest other id of their component (null
if there is none); repeated rows each give a row; extra columns are ignored by
`near_duplicates` and kept by `drop_near_duplicates`; empty tables give empty
results.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import free, map_batches, table, written
from vitrine.llm.graph import connected_components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints to a tile, shingle hashes to a bit count, elements to an exclusive-or.
TILE, CHUNK, BLOCK = 2048, 1 << 17, 1 << 20
#: Comparisons to a task, about; what a pair of tiles costs besides, in comparisons; tasks at most.
TASK_WORK, PAIR_WORK, MAX_TASKS = 1 << 29, 1 << 14, 20_000
_QUARTERS, _STEP = 4, 5  # a count of 0 to 16, plus the radius on either side, in five bits


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text: bit set if set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(width, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, end, digest = (end - size)[:len(words) - width + 1].tolist(), end[width - 1:].tolist(), xxhash.xxh64_intdigest
    n, ones = len(start), np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(start[k:k + CHUNK], end[k:k + CHUNK], strict=True)), ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """`docs` without text, with `fp` (the fingerprint as a signed long)."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, width, seed) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(fp)], names=[*rest, "fp"])

    return map_batches(docs.select(*rest, "text"), run, docs.select(*rest).schema.add("fp", "long"))


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) of one pair of tiles as stars around the smallest node of each component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[rest], nodes[label[rest]]


def tile_links(one: np.ndarray, two: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact comparison of two tiles; the links as stars."""
    found_a, found_b, rows = [], [], max(1, BLOCK // max(1, len(two)))
    for k in range(0, len(one), rows):
        i, j = np.nonzero(np.bitwise_count(one[k:k + rows, None] ^ two[None, :]) <= radius)
        a, b = one[k + i], two[j]
        other = a != b
        if other.any():
            a, b = _stars(a[other].view(np.int64), b[other].view(np.int64))
            found_a.append(a)
            found_b.append(b)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _stars(np.concatenate(found_a), np.concatenate(found_b))


def _offsets(radius: int) -> list[int]:
    """Differences of cell codes within the radius, each pair of cells once (0: the cell itself)."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, d)) <= radius]
    codes = sorted(sum(x << (_STEP * k) for k, x in enumerate(d)) for d in steps)
    return [c for c in codes if c >= 0]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """distinct (fp) -> edges (a, b) that connect just the fingerprints that links connect."""
    if not 0 <= radius <= 6:
        raise ValueError("radius: 0 to 6")
    quarter = lambda k: F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("long")
    cells = distinct.select("fp", sum(F.shiftleft(quarter(k) + radius, _STEP * k) for k in range(_QUARTERS)).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(tile)).alias("tiles"))  # 17^4 rows at most
    tiles = written(cells.join(F.broadcast(sizes), "cell")
                    .groupBy("cell", F.pmod(F.xxhash64("fp"), "tiles").alias("tile"))
                    .agg(F.sort_array(F.collect_list("fp")).alias("fps")), "tiles")
    name = tiles.select("cell", "tile", F.size("fps").cast("long").alias("n"))
    near = name.select(F.col("cell").alias("c"), F.col("tile").alias("t"), F.col("n").alias("m"))
    pairs = written(name.withColumn("c", F.explode(F.array(*(F.lit(o).cast("long") for o in _offsets(radius))))).withColumn("c", F.col("cell") + F.col("c"))
                    .join(near, "c").where("cell <> c OR tile <= t"), "tile-pairs")
    work = pairs.agg(F.sum(F.col("n") * F.col("m") + PAIR_WORK)).first()[0] or 0
    other = tiles.select(F.col("cell").alias("c"), F.col("tile").alias("t"), F.col("fps").alias("other"))
    key = ["cell", "tile", "c", "t"]
    dealt = (pairs.select(*key).join(tiles, ["cell", "tile"]).join(other, ["c", "t"])
             .repartition(max(1, min(MAX_TASKS, -(-work // TASK_WORK))), *key).select("fps", "other"))

    def run(batches):
        for batch in batches:
            found = []
            for one, two in zip(batch.column("fps"), batch.column("other"), strict=True):
                found.append(tile_links(*(x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (one, two)), radius))
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _components(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root) for the distinct fingerprints of `prints`; root: the smallest fingerprint reachable."""
    distinct = prints.select("fp").distinct()
    found = connected_components(fingerprint_links(distinct, radius))
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """doc_id, fp, component_id for each row of `docs` (doc_id, text)."""
    prints = written(fingerprints(docs.select("doc_id", "text"), width, seed), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    rooted = _components(prints, radius).join(least, "fp")
    ids = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row of each component: the one with the smallest doc_id (nulls last, then the smallest hash of the whole row)."""
    whole, row, doc = F.xxhash64(*docs.columns), free(docs, "__row"), free(docs, "__doc")
    prints = written(fingerprints(docs.select("doc_id", whole.alias("k"), "text"), width, seed), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), "k")
    least = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = written(_components(prints, radius).join(least, "fp").groupBy("root").agg(F.min("first").alias("first"))
                   .select(F.col("first.d").alias(doc), F.col("first.k").alias(row)), "kept")
    keyed = docs.withColumn(row, whole)
    return (keyed.join(kept, (keyed[row] == kept[row]) & keyed["doc_id"].eqNullSafe(kept[doc]), "left_semi")
            .dropDuplicates([row]).drop(row))


def op4_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 4 over the whole of `documents`."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
