"""Operator 12 against a dictionary of all windows, and the cases its docstring defines."""

import hashlib
import random
import re

import edge
import numpy as np
import pandas as pd
import pytest

from vitrine.llm import substrings
from vitrine.llm.blocks import blocks_of, with_answers
from vitrine.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF01 = "/root/testdata/sf0.01"


def brute(docs, window):
    """(doc_id, text) -> per row (doc_id, words, removed, kept)."""
    words, first = [WORD.findall(t or "") for _, t in docs], {}
    place = lambda d, i: (d is None, d or 0, i)
    for (d, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (2,)), place(d, i))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < place(d, i):
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def rows(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    say = lambda n: " ".join(r.choice("ab cd ef gh ij kl mn op".split()) + str(r.randint(0, 300)) for _ in range(n))
    passages = [say(n) for n in (25, 60, 21, 20)]
    docs = [(i, " \n".join(x for _ in range(r.randint(0, 3)) for x in (say(r.randint(0, 60)), r.choice(passages)))) for i in range(300)]
    docs += [(300 + i, docs[7][1]) for i in range(40)]
    docs += [(1000, "loop again " * 60), (1001, "x " * 45), (1002, say(30_000)), (1003, passages[1] + " " + passages[1]), (5, docs[6][1]), (5, docs[6][1]), (None, docs[3][1]), (None, passages[0]), (-4, passages[1]), (2000, None), (2001, ""), (2002, "few words")]
    return docs


@pytest.mark.parametrize("window,block,slices", [(20, 1 << 23, 24 << 20), (20, 4000, 20_000), (5, 3000, 10_000), (1, 2000, 1 << 20)])
def test_against_all_windows(spark, corpus, window, block, slices):
    d = spark.createDataFrame(corpus, "doc_id long, text string").repartition(7)
    got = substrings.remove_repeats(d, window, block, slices)
    assert rows(got) == sorted(brute(corpus, window), key=repr)


def test_query_against_all_windows(spark):
    docs = pd.read_parquet(f"{SF01}/documents.parquet")
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(list(zip(docs.doc_id, docs.text, strict=True)), 20)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op12_substring_dedup"](spark, SF01).collect()}
    assert got == want and sum(k > 0 for _, k, _ in want.values()) > 50


def test_spans_are_maximal(spark):
    say = lambda a, n: " ".join(f"w{i}" for i in range(a, a + n))
    docs = [(1, say(0, 60)), (2, say(500, 7) + " " + say(0, 30) + " " + say(600, 3) + " " + say(35, 22))]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [(7, 37), (40, 62)]}


def test_rolling_hash_of_equal_windows():
    r = np.random.default_rng(1)
    words = r.integers(0, 1 << 63, 500).astype(np.uint64)
    words[300:340] = words[100:140]
    h = substrings.rolling(words, 20, substrings._BASES[0])
    same = {(i, j) for i in range(len(h)) for j in range(i) if h[i] == h[j]}
    assert same == {(300 + i, 100 + i) for i in range(21)}


def test_text_is_read_where_it_lies(spark, corpus):
    """Answers meet the blocks without a shuffle of the blocks."""
    blocks = blocks_of(spark.createDataFrame(corpus, "doc_id long, text string"), substrings.BLOCK_BYTES)
    answers = spark.createDataFrame([(0, 0, 0, b"x", 1)], substrings._ANSWER)
    plan = with_answers(blocks, {"shared": answers, "later": answers}, "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and not any("payload" in x for x in plan.splitlines() if "Exchange" in x)


def test_edges(spark):
    docs = edge.documents(spark)
    got = substrings.remove_repeats(docs)
    own = rows(got)
    texts = [(i, t) for i, t in enumerate(edge.TEXTS)] + [(5, edge.TEXTS[5]), (None, edge.prose(6, 70)), (None, None)]
    assert own == sorted(brute(texts, 20), key=repr)
    assert substrings.remove_repeats(edge.empty(spark)).count() == 0
