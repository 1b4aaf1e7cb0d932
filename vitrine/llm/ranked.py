"""Operator 11, ranked lexical search: accumulator-limited, a term at a time.

One pass over the documents keeps, for each record batch (a shard), the
postings of the terms that the items ask for: its row of the written index
holds them sorted by term, with the lengths of the documents they stand in.
Counts of documents, terms and document frequencies are summed over the shards
in Spark; the driver sees one row per asked term.

A shard then ranks its documents for one item after the other.  Terms are
taken rarest first.  A document gets an accumulator when one of its terms is
taken, until what the terms that are left can add at most lies below the kth
partial score; from then on only documents that have an accumulator are
updated, so the survivors' scores are exact.  The kth partial score is the
shard's own or, if larger, the one over all documents after the item's rarest
terms (as many as stand in k documents), which a first round over the index
finds.  At most k rows for each item leave a shard, none below that score.

Items are taken in blocks of at most `BLOCK_CHARS` characters, whose terms are
sent to all tasks; more items take more blocks, each a pass over the documents.
Memory is one record batch and a number per document of it.

Defined results: null text has no terms, and neither counts nor is found;
repeated documents and items each give their rows; of equal scores the smaller
doc_id comes first, null last; an item without terms, or with none that a
document holds, gives no rows; empty tables give none; extra columns are
ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vitrine.llm.common import sliced, table, written

TOP = 50
BLOCK_CHARS = 2 << 20
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


# ---------------------------------------------------------------- index
_POSTINGS = np.dtype([("term", "<i4"), ("doc", "<i4"), ("tf", "<i8")])
_DOCS = np.dtype([("id", "<i8"), ("null", "<i8"), ("n", "<i8")])


def index_shards(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(n_docs, n_terms, terms, dfs, docs, postings): a row per record batch of docs (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches):
        asked = sent.value
        for batch in itertools.chain.from_iterable(sliced([b]) for b in batches):
            codes, sizes = [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text)
                sizes[i] = len(words)
                own = np.fromiter(map(asked.get, words, itertools.repeat(-1)), np.int64, len(words))
                codes.append((own[own >= 0] << 32) | i)
            codes, tf = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64),) * 2
            posted = np.empty(len(codes), _POSTINGS)
            held, posted["doc"] = np.unique(codes & 0xFFFFFFFF, return_inverse=True)
            posted["term"], posted["tf"] = codes >> 32, tf
            terms, dfs = np.unique(posted["term"], return_counts=True)
            own = np.empty(len(held), _DOCS)
            ids = batch.column("doc_id").take(pa.array(held))
            own["id"], own["null"], own["n"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), sizes[held]
            row = ((int((sizes > 0).sum()), pa.int64()), (int(sizes.sum()), pa.int64()), (terms, pa.list_(pa.int32())), (dfs, pa.list_(pa.int64())), (own.tobytes(), pa.binary()), (posted.tobytes(), pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in row], names=["n_docs", "n_terms", "terms", "dfs", "docs", "postings"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(index, "n_docs long, n_terms long, terms array<int>, dfs array<long>, docs binary, postings binary")


# ---------------------------------------------------------------- ranking
class Shard:
    """The postings of one shard, with what each adds to a score per unit of weight."""

    def __init__(self, docs: bytes, postings: bytes, n_docs: int, n_terms: int):
        own, posted = np.frombuffer(docs, _DOCS), np.frombuffer(postings, _POSTINGS)
        self.id, self.null, self.size = own["id"], own["null"], len(own)
        sizes, at = np.unique(own["n"], return_inverse=True)
        norm = np.array([50 + 50 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)[at] if len(own) else np.zeros(0, np.int64)
        self.doc, self.term, tf = posted["doc"], posted["term"], posted["tf"]
        self.gain = 1_000_000_000 * tf // (1000 * tf + 20 * norm[self.doc])

    def ranked(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best at or above `floor`; terms come rarest first."""
        low, high = np.searchsorted(self.term, terms, "left"), np.searchsorted(self.term, terms, "right")
        lists = [(self.doc[a:b], w * self.gain[a:b]) for a, b, w in zip(low.tolist(), high.tolist(), weights.tolist(), strict=True) if b > a and w]
        left = np.cumsum([0, *(int(c.max()) for _, c in reversed(lists))])[::-1]
        score, live, creating = np.zeros(self.size, np.int64), np.zeros(self.size, bool), True
        for (doc, add), most in zip(lists, left, strict=False):
            if creating:
                partial = score[live]
                kth = int(np.partition(partial, -k)[-k]) if len(partial) >= k else 0
                creating = int(most) >= max(kth, floor)
            if creating:
                live[doc] = True
            else:
                doc, add = doc[kept := live[doc]], add[kept]
            score[doc] += add
        found = np.nonzero(live & (score >= max(floor, 1)))[0]
        if len(found) > k:
            found = found[score[found] >= np.partition(score[found], -k)[-k]]
        found = found[np.lexsort((self.id[found], self.null[found], -score[found]))][:k]
        return found, score[found]


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items in blocks whose size was checked before they are brought to the driver."""
    total = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = max(1, -(-total // block_chars))
    for i in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield [(r.item_id, sorted(set(terms_of(r.text)))) for r in part.orderBy("item_id", "text").collect()]


def _scored(shards: DataFrame, queries: list, n_docs: int, n_terms: int, k: int, floors: dict[int, int]) -> DataFrame:
    """(item, doc_id, score): the best of each shard for each query (number, terms, weights)."""
    sent = shards.sparkSession.sparkContext.broadcast((queries, floors))

    def rank(batches):
        queries, floors = sent.value
        for batch in batches:
            for docs, postings in zip(batch.column("docs").to_pylist(), batch.column("postings").to_pylist(), strict=True):
                shard, rows = Shard(docs, postings, n_docs, n_terms), []
                for number, terms, weights in queries:
                    found, score = shard.ranked(terms, weights, k, floors.get(number, 0))
                    rows.append((np.full(len(found), number), found, score))
                number, found, score = (np.concatenate(x) if rows else np.zeros(0, np.int64) for x in (zip(*rows, strict=True) if rows else ((),) * 3))
                ids = pa.array(shard.id[found], mask=shard.null[found].astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), ids, pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return shards.select("docs", "postings").mapInArrow(rank, "item long, doc_id long, score long")


def _best(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _head(terms: list, dfs: dict[int, int], k: int) -> int:
    """How many of the terms, rarest first, stand in k documents together."""
    held = list(itertools.accumulate(dfs[t] for t in terms))
    return next((i + 1 for i, n in enumerate(held) if n >= k), len(held))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of docs (doc_id, text) for each row of items (item_id, text)."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    schema = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(items.select("item_id", F.col("text").cast("string").alias("text")), block_chars):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
        if not vocabulary:
            continue
        shards = written(index_shards(docs, vocabulary), "ranked-index")
        n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        held = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("e")).groupBy("e.terms").agg(F.sum("e.dfs").alias("df"))
        dfs = {r.terms: r.df for r in held.collect()}  # a row per asked term at most
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in dfs.items()}
        queries = [(i, sorted((t for x in terms if (t := vocabulary[x]) in dfs), key=lambda t: (dfs[t], t))) for i, (_, terms) in enumerate(block)]
        cut = lambda i, own: (i, np.array(own, np.int32), np.array([weight[t] for t in own], np.int64))
        heads = _scored(shards, [cut(i, own[:_head(own, dfs, k)]) for i, own in queries if own], n_docs, n_terms, k, {})
        floors = {r.item: r.floor for r in _best(heads, k).groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k).collect()}
        best = _best(_scored(shards, [cut(i, own) for i, own in queries if own], n_docs, n_terms, k, floors), k)
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(block)), pa.int64()), "item_id": pa.array([x for x, _ in block], to_arrow_type(kind))}))
        out = out.unionByName(best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for each benchmark item, over the whole tables."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x{{00}}-\x{{2F}}\x{{3A}}-\x{{40}}\x{{5B}}-\x{{60}}\x{{7B}}-\x{{7F}}]+')"

#: The same by scoring every document that holds a term of the item.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, w FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
z AS (SELECT count(*)::BIGINT AS big_n, sum(len(w))::BIGINT AS big_l FROM d),
m AS (SELECT rid, doc_id, 100 - 50 + ((50 * len(w)::BIGINT * big_n) // big_l) AS m FROM d, z),
f AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY ALL),
g AS (SELECT term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, z GROUP BY term, big_n),
q AS (SELECT DISTINCT iid, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS w FROM benchmark)),
s AS (SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN g USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {TOP}"""
