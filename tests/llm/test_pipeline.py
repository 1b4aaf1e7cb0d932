"""The pipeline's stages against brute force on the smallest tables."""

import re
import zlib
from collections import Counter

import edge
import numpy as np
import pandas as pd

import corpus_pipeline
from vitrine.llm import decontaminate, quality, secrets, simhash, tokens
from vitrine.llm.common import written

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf=SF):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "stage")
        out.append((name, docs))
    return out


def test_stages_against_brute_force(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(stages(spark, given))
    left = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    assert all(steps[n].columns == given.columns for n, _ in corpus_pipeline.STAGES[:-1])

    model = quality.fit_quality(given, spark.read.parquet(f"{SF}/labels.parquet"))

    def passes(text):
        (n, _, _, _, again), x = quality.text_counts(text)
        return n >= 50 and 100 * again <= 50 * n and model.probability(np.array([x]))[0] >= model.cut

    left = left[[passes(t) for t in left.text]]
    assert sorted(r.doc_id for r in steps["quality rules"].select("doc_id").collect()) == left.doc_id.tolist()

    prints, group = [simhash.fingerprint(t) for t in left.text], list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    left = left[[g == i for i, g in enumerate(group)]]
    assert sorted(r.doc_id for r in steps["SimHash near-dedup"].select("doc_id").collect()) == left.doc_id.tolist()

    def shingles(text):
        words = decontaminate.words_of(text)
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    items = [shingles(t) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    left = left[[not any(len(q & shingles(t)) >= 0.8 * len(q) for q in items) for t in left.text]]
    assert sorted(r.doc_id for r in steps["benchmark decontamination"].select("doc_id").collect()) == left.doc_id.tolist()

    def clean(text):
        cover = np.zeros(len(text), bool)
        spans = sorted(m.span() for r in secrets.RULES for m in re.finditer(r.pattern, text) if len(m[r.group]) >= r.least)
        out, at = [], 0
        for a, b in spans:
            if b > at:
                if a >= at:
                    out += text[at:a], secrets.MARK
                at = b
        del cover
        return "".join(out) + text[at:]

    left = left.assign(text=[clean(t) for t in left.text])
    got = {r.doc_id: r for r in steps["secret scans"].collect()}
    assert {d: r.text for d, r in got.items()} == dict(zip(left.doc_id, left.text, strict=True))

    encode, want = tokens.Encoder(tokens.vocabulary_path()), Counter()
    for doc, text in zip(left.doc_id, left.text, strict=True):
        ids = encode(text)
        n = len(ids) // 4
        first = n % 2048 or min(n, 2048)
        for k, (a, b) in enumerate([(0, first), *((s, s + 2048) for s in range(first, n, 2048))]):
            want[doc, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])] += 1
    packed = steps["best-fit packing"].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    assert sorted(r.asDict().items() for r in corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()) == sorted(r.asDict().items() for r in steps["best-fit packing"].drop("sequence_id", "offset").collect())


def test_stage_edges(spark):
    """Each stage alone, over rows that no other stage has removed: null ids and texts, repeated rows, clashing columns, an empty table."""
    docs, out = edge.documents(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, edge.empty(spark), SF).count() == 0
        frame = stage(spark, docs, SF)
        assert name == "best-fit packing" or frame.columns == docs.columns
        out[name] = frame.collect()
    ids = lambda name: Counter(r.doc_id for r in out[name])
    whole = Counter(r.doc_id for r in docs.collect())
    words = {i: len((t or "").split()) for i, t in enumerate(edge.TEXTS)} | {None: 70}
    kept = ids("quality rules")
    assert all(n == whole[d] or d is None and n == 1 for d, n in kept.items()) and all(words[d] >= 50 for d in kept) and not {0, 1, 2, 3, 4} & set(kept)
    assert {5, 6} <= set(kept) and kept[5] == 2
    once = ids("SimHash near-dedup")
    assert max(once.values()) == 1 and {0, 3, 4, 5, 7, 8} <= set(once) and not {1, 2, 6} & set(once)  # 1, 2 and a null row are as empty as 0
    assert sum(r.doc_id is None and r.text is None for r in out["SimHash near-dedup"]) == 0 and once[None] == 1
    assert ids("benchmark decontamination") == whole
    clean = out["secret scans"]
    assert ids("secret scans") == whole and all((r.text is None) == (r.doc_id == 0 or r.doc_id is None and r.n_chars is None) for r in clean)
    assert "[SECRET]" in next(r.text for r in clean if r.doc_id == 13) and {r.doc_id: r.text for r in clean}[5] == edge.TEXTS[5]
    packed = out["best-fit packing"]
    first = Counter(r.doc_id for r in packed if r.piece == 0)
    assert first == whole and all(r.length == 1 for r in packed if r.doc_id in (0, 1))


def test_short_items_go_with_their_documents(spark):
    """The decontamination stage drops documents that hold an item of fewer words than a shingle."""
    import tempfile

    from vitrine.llm.common import table
    sf = tempfile.mkdtemp(prefix="vitrine-items-")
    table(spark, SF, "documents").limit(0).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "to be or not"), (2, "xyzzy")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = edge.documents(spark, ["we say to be or not today my friend", "clean words here", "it is XYZZY!", "be or not to", None])
    left = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, sf)
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]
