"""Registered queries over the given tables: DuckDB where SQL can say it, brute force elsewhere."""

import itertools
import re
import zlib
from collections import Counter

import harness
import numpy as np
import pandas as pd
import pytest
import xxhash
from tokenizers import Tokenizer

from vitrine.llm import decontaminate, html_text
from vitrine.llm.queries import ORACLE, QUERIES
from vitrine.llm.tokens import vocabulary_path

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF001}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def result(spark, name, key="doc_id"):
    return QUERIES[name](spark, SF001).toPandas().sort_values(key).reset_index(drop=True)


@pytest.fixture(scope="module")
def ids(documents):
    t = Tokenizer.from_file(vocabulary_path())
    return [np.array([*e.ids, 0], "<u4") for e in t.encode_batch(documents.text.tolist(), add_special_tokens=False)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    problems, n = harness.compare(QUERIES[name](spark, SF01), harness.duck(SF01), ORACLE[name])
    assert not problems and n


def test_thirteen_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_quality_counts(spark, documents):
    def counts(text):
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        again = [False] * len(words)
        for i in range(len(words) - 2):
            if windows[tuple(words[i:i + 3])] > 1:
                again[i:i + 3] = [True] * 3
        return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(again)]

    got = result(spark, "op2_quality_rules")
    want = np.array([counts(t) for t in documents.text])
    assert (got[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]].to_numpy() == want).all()
    failed = (want[:, 0] < 50) | (100 * want[:, 4] > 50 * want[:, 0])
    assert (got.base_failed == failed).all() and not (got.kept & failed).any()


def test_quality_held_out(spark):
    """Trees fitted on half of the labels tell the other half apart."""
    from vitrine.llm import quality
    from vitrine.llm.common import table
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    model = quality.fit_quality(docs, labels.where("doc_id % 2 = 0"))
    got = quality.score_quality(docs, model).toPandas().merge(labels.where("doc_id % 2 = 1").toPandas(), on="doc_id")
    good = got[(got.quality == 1) & ~got.base_failed]
    assert good.kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.1


def test_simhash_brute_force(spark, documents):
    def fingerprint(text):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    got, prints = result(spark, "op4_simhash_near_dedup"), [fingerprint(t) for t in documents.text]
    assert got.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    root = list(range(len(prints)))
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2 and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
    assert got.component_id.tolist() == documents.doc_id.iloc[root].tolist()


def test_decontamination_brute_force(spark):
    docs, items = (pd.read_parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))

    def shingles(text):
        words = decontaminate.words_of(text)
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    have, want = [shingles(t) for t in docs.text], {}
    for item, text in zip(items.item_id, items.text, strict=True):
        asked = shingles(text)
        for doc, own in zip(docs.doc_id, have, strict=True):
            if (n := len(asked & own)) and n >= 0.8 * len(asked):
                want[doc, item] = n
    got = QUERIES["op7_benchmark_decontamination"](spark, SF01).toPandas()
    assert {(r.doc_id, r.item_id): r.n_shared for r in got.itertuples()} == want and want


def test_token_files_round_trip(spark, documents, ids):
    got, n = result(spark, "op5_token_files"), np.array([len(x) for x in ids])
    assert got.n_tokens.tolist() == n.tolist() and got.start.tolist() == (np.cumsum(n) - n).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(x.tobytes()) for x in ids]


def test_packing(spark, documents, ids):
    got, own = QUERIES["op10_best_fit_packing"](spark, SF001).toPandas(), dict(zip(documents.doc_id, ids, strict=True))
    for r in got.itertuples():
        assert zlib.crc32(own[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32 and 0 < r.length <= 2048
    for doc, g in got.sort_values("piece").groupby("doc_id"):
        assert g.piece.tolist() == list(range(len(g))) and (g.length[1:] == 2048).all()
        assert g.start.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() == len(own[doc])
    g = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id").length
    assert ((g.cumsum() - got.length).sort_index() == got.offset).all() and g.sum().max() <= 2048
    total = sum(map(len, ids))
    assert g.ngroups <= 1.02 * total / 2048 + 1


def test_html_against_plain_cutting(spark):
    """The pages' articles are marked, so cutting them out by their marks has to give the same."""
    import html
    pages = pd.read_parquet(f"{SF01}/pages.parquet").sort_values("page_id")
    got = QUERIES["op6_html_extraction"](spark, SF01).toPandas().sort_values("page_id")

    def cut(page):
        own = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1])
        own = html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1)>", "\x01", own.replace("<br>", " "))))
        return "\n".join(x for x in (" ".join(b.split()) for b in own.split("\x01")) if x)

    assert got.text.tolist() == [cut(p) for p in pages.html] and got.n_chars.tolist() == [len(t) for t in got.text]
    assert html_text.main_text(None) == ""


def test_classifier_separates(spark):
    got = QUERIES["op9_quality_classifier"](spark, SF01).toPandas()
    labels = pd.read_parquet(f"{SF01}/labels.parquet")
    got = got.merge(labels, on="doc_id")
    assert got[(got.quality == 1) & (got.toxic == 0)].kept.mean() > 0.98 and got[got.quality == 0].kept.mean() < 0.2
