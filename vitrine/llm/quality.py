"""Operator 2, quality rules: boosted trees over document statistics, with monotone constraints.

The statistics of each whole text are taken in one pass over record batches.
The trees are fitted on at most `sample` labelled documents (a documented
bound; those with the smallest hash of their id), flattened to numpy arrays
and scored a batch at a time; a document fails if a base rule fails or its
probability of good quality is below the model's cut.  The cut is 0.5, or lower
so that at most `lose` of the good documents would go, by probabilities that
each part of the sample gets from trees fitted on the other parts.  `lose` is
above the share of wrong labels to expect, as these come first in that order.

No shuffle over the texts: the sample's ids are the only thing broadcast, and
their number is the bound.  The features of equal rows are one row before the
driver takes them; ids with several texts give at most `4 * sample` rows, those
with the smallest hashes.  State per document is its words.

Defined results: null text has no words, so its base rule fails; without labels
(or with one class only) the base rules alone decide; several labels of an id
count as what most of them say (a tie: bad); repeated rows count once; null doc_ids are scored like any other; extra columns are kept by
`filter_quality` and ignored by `score_quality`; empty tables give empty
results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.boosting import Trees, train
from vitrine.llm.common import map_batches, table

#: Labelled documents that the trees are fitted on, at most.
SAMPLE = 20_000
#: The share of good documents below the cut, and the good documents below it, that may be no more than wrong labels.
LOSE, FEW = 0.05, 5
#: Parts of the sample for held-out probabilities.
FOLDS = 3

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>"

#: Feature and the direction in which the score may move with it.
FEATURES = (("log_words", 0), ("mean_word", 0), ("symbols", -1), ("dup_lines", -1), ("repeat_words", -1), ("upper", -1),
            ("digits", 0), ("shouts", -1), ("distinct", 0), ("line_words", 0), ("top_word", -1))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The contract's counts (words are runs without ASCII white space, which is what bytes.split gives) and the features."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    marks = len(raw) - len(raw.translate(None, b"\t\n\v\f\r "))
    chars = len(text or "") - marks
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeat = 0
    if len(set(windows)) < len(windows):
        again: set = set()
        fresh: set = set()
        for w in windows:
            (again if w in fresh else fresh).add(w)
        end = 0
        for i, w in enumerate(windows):
            if w in again:
                repeat += i + 3 - max(end, i)
                end = i + 3
    count: dict[bytes, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    d, c = max(n, 1), max(chars, 1)
    features = (np.log1p(n), chars / d, symbols / c, dup_lines / max(len(lines), 1), repeat / d, (len(raw) - len(raw.translate(None, UPPER))) / c,
                (len(raw) - len(raw.translate(None, DIGITS))) / c, raw.count(b"!") / c, len(count) / d, n / max(len(lines), 1), max(count.values(), default=0) / d)
    return (n, chars, symbols, dup_lines, repeat), features


@dataclass
class QualityModel:
    trees: Trees | None
    cut: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.trees.probability(x) if self.trees else np.ones(len(x))


def _described(texts) -> tuple[np.ndarray, np.ndarray]:
    both = [text_counts(t) for t in texts]
    return (np.array([c for c, _ in both], dtype=np.int64).reshape(len(both), len(COUNTS)),
            np.array([f for _, f in both]).reshape(len(both), len(FEATURES)))


def sample_features(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text_hash, quality and the features: a row per labelled doc_id and text, the same for any order or number of equal rows."""
    chosen = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg(F.col("quality").cast("int")) > 0.5).cast("int").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(chosen), "doc_id")
    same, names = ["doc_id", "text_hash", "quality"], [n for n, _ in FEATURES]

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, x = _described(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in same), *(pa.array(x[:, j]) for j in range(x.shape[1]))], names=[*same, *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = map_batches(rows, features, f"doc_id {kind}, text_hash long, quality int, " + ", ".join(f"{n} double" for n in names))
    return (got.groupBy(*same).agg(*(F.min(n).alias(n) for n in names))
            .orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").limit(4 * sample).drop("doc_id"))


def held_out(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Each row's probability by trees fitted on the other folds; NaN if these have one class only."""
    out = np.full(len(y), np.nan)
    for k in np.unique(fold):
        rest = fold != k
        if 0 < y[rest].sum() < rest.sum():
            out[~rest] = train(x[rest], y[rest], np.array([d for _, d in FEATURES])).probability(x[~rest])
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lose: float = LOSE) -> QualityModel:
    """Trees from at most `sample` labelled documents; their features are all that the driver gets."""
    got = sample_features(docs, labels, sample).toPandas()
    got = got.sort_values(list(got.columns), kind="stable")  # the order in which tasks end must not matter
    y, x = got["quality"].to_numpy(float), got.drop(columns=["text_hash", "quality"]).to_numpy(float)
    if not 0 < y.sum() < len(y):
        return QualityModel(None, 0.0)
    good = held_out(x, y, got["text_hash"].to_numpy() % FOLDS)[y == 1]
    good = good[~np.isnan(good)]
    cut = min(0.5, np.quantile(good, min(0.5, max(lose, FEW / len(good))))) if len(good) else 0.5
    return QualityModel(train(x, y, np.array([d for _, d in FEATURES])), float(cut))


def _verdict(model: QualityModel, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    counts, x = _described(texts)
    failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
    p = model.probability(x)
    return counts, failed, p, ~failed & (p >= model.cut)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, the five counts, base_failed, probability, kept; a row per row of `docs`."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, failed, p, kept = _verdict(model, batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(counts[:, j]) for j in range(len(COUNTS))), pa.array(failed), pa.array(p), pa.array(kept)],
                                          names=["doc_id", *COUNTS, "base_failed", "probability", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, probability double, kept boolean")


def filter_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_verdict(model, batch.column("text").to_pylist())[3]))

    return map_batches(docs, run, docs.schema)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 2 over the whole of `documents`, fitted on `labels`."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
