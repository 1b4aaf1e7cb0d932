"""Operator 11 against scoring everything, and the cases its docstring defines."""

import math
import random
import re
from collections import Counter

import edge
import numpy as np
import pytest

from vitrine.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    """docs: (doc_id, text); items: text; per item (rank, doc_id, score)."""
    terms = lambda t: TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    own = [(d, Counter(w), len(w)) for d, t in docs if (w := terms(t))]
    big_n, big_l = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for text in items:
        asked, rows = set(terms(text)) & set(df), []
        for d, c, n in own:
            m = 50 + 50 * n * big_n // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out.append([(i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows, key=lambda r: r[:3])[:k])])
    return out


def got(spark, docs, items, k, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    rows = ranked.rank_documents(d, q, k, **more).collect()
    out = [[] for _ in items]
    for r in rows:
        out[r.item_id].append((r.rank, r.doc_id, r.score))
    return [sorted(x) for x in out]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(r.choices(words, weights, k=r.choice([3, 20, 60, 200])))) for i in range(700)]
    docs += [(700 + i, docs[5][1]) for i in range(80)] + [(3, docs[9][1]), (None, docs[5][1]), (9000, None), (9001, " .,; "), (9002, "ÉCOLE école W1 w1")]
    items = [" ".join(r.choices(words, weights, k=k)) for k in (1, 3, 8, 20, 40)] + ["w0", "w399 W398 w0", docs[5][1], "", None, "absent", "École w7"]
    return docs, items


@pytest.mark.parametrize("k", [1, 10, 50, 2000])
def test_against_scoring_everything(spark, corpus, k):
    docs, items = corpus
    want = brute(docs, items, k)
    key = lambda rows: [(rank, -1 if d is None else d, s) for rank, d, s in rows]
    assert [key(x) for x in got(spark, docs, items, k)] == [key(x) for x in want]
    assert sum(map(len, want)) > 8 and want[9] == want[10] == []


def test_items_in_blocks(spark, corpus):
    docs, items = corpus
    assert got(spark, docs, items, 10, block_chars=150) == got(spark, docs, items, 10)


def test_accumulators_stop(spark):
    """A common term makes no accumulator once it cannot lift a document among the best, and survivors stay exact."""
    n = 5000
    own = np.zeros(n, ranked._DOCS)
    own["id"], own["n"] = np.arange(n), 10
    posted = np.array([(0, d, 3) for d in range(0, 40)] + [(1, d, 1) for d in range(n)], ranked._POSTINGS)
    shard = ranked.Shard(own.tobytes(), posted.tobytes(), n, 10 * n)
    terms, weights = np.array([0, 1], np.int32), np.array([5000, 3], np.int64)
    found, score = shard.ranked(terms, weights, 10)
    assert found.tolist() == list(range(10)) and (score == 5000 * shard.gain[0] + 3 * shard.gain[-1]).all()
    found, score = shard.ranked(terms, weights, 60)   # fewer rare documents than asked for: the common ones come in
    assert found.tolist() == list(range(60)) and score[59] == 3 * shard.gain[-1]
    found, _ = shard.ranked(terms, weights, 60, floor=int(5000 * shard.gain[0]))
    assert found.tolist() == list(range(40))          # a floor from elsewhere keeps them out


def test_edges(spark):
    docs = edge.documents(spark)
    items = docs.selectExpr("doc_id AS item_id", "text", "text AS doc_id", "lang AS rank")
    rows = ranked.rank_documents(docs, items, 5).collect()
    assert {r.item_id for r in rows if r["rank"] == 1} >= {3, 5, 8, 12, 13, None} and all(1 <= r["rank"] <= 5 for r in rows)
    assert [r.doc_id for r in sorted((r for r in rows if r.item_id == 3), key=lambda r: r["rank"])] == [3]
    assert ranked.rank_documents(edge.empty(spark), items).count() == 0
    assert ranked.rank_documents(docs, items.limit(0)).count() == 0
