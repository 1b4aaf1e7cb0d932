"""Operator 9, quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is of characters, as they are (lower case, runs of white space one
blank): n-grams of up to `ORDER` of them, all of Unicode, so that what is
counted grows with the trusted text.  A document is kept if its perplexity lies
within quantiles of the trusted documents of its language.

Texts are dealt into two folds by hash, and a fold's tables count the trusted
text of the other one: no document is scored by tables that hold its own text,
and trusted and other documents have perplexities of one kind.  A fold without
trusted text of a language takes the other fold's tables, a language without
any the pooled ones, under the name `POOLED`.

Counts, continuation counts, discounts and back-off weights are Spark
aggregates and joins over tables sharded by (language, n-gram).  To score, the
documents are dealt into blocks (`blocks`).  A block sends the distinct n-grams
of its documents to slices, which hold the tables' entries of the same hash
range and answer with the two numbers of each n-gram they know; the block then
adds up its documents.  Log probabilities are whole numbers, so that their order
does not matter.  An n-gram that every document holds is one entry per block.
Memory is a block of `BLOCK_BYTES` of text, looked at in pieces, or a slice.

Defined results: text that is null, empty or blank has no perplexity and isn't kept;
without trusted text there is no perplexity and no threshold and everything else is
kept; null languages use the pooled model; several labels of a document trust it if one
does; null doc_ids are scored; repeated rows each give a row; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.blocks import SENT, batches_of, blocks_of, each, opened, sent, slice_bits, slice_range, total_bytes, unpacked, with_answers
from vitrine.llm.common import table, written

ORDER = 4
#: Any character may come next, seen or not.
OPEN = 0x110000
POOLED, FOLDS = "*", 2  # gram_counts exchanges the two
#: Quantiles of a language's trusted perplexities.
LOW, HIGH = 0.005, 0.995
#: Log probabilities are kept as whole numbers of this part.
UNIT = 1e9
BLOCK_BYTES, SLICE_BYTES, PIECE, LEVEL = 8 << 20, 32 << 20, 1 << 18, 6
#: Bytes of a record batch between Spark and Python.
BATCH_BYTES = 1 << 20
#: n-grams of pieces that wait, at least, before equal ones are brought together.
WAITING = 1 << 17
#: Stands before a text's first characters; not a character of any text.
PAD = "\x02"
_MIX, _SPREAD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- n-grams of texts
def characters(text: str | bytes | None) -> str:
    """What is scored of a text."""
    text = text.decode("utf-8", "replace") if isinstance(text, bytes) else text or ""
    return " ".join(text.lower().replace("\x00", " ").replace(PAD, " ").split())


def _step(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Keys of n-grams one character longer to the left."""
    keys = (keys ^ (codes.astype(np.uint64) * _SPREAD)) * _MIX
    return keys ^ (keys >> np.uint64(29))


def _pieces(texts: list[str], piece: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, places, documents): texts in pieces of about `piece` characters, the places those that are predicted.

    A long text is cut; each cut begins with the characters before it.
    """
    def flush():
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(x) for x in parts])
        kept = sizes - (ORDER - 1)
        places = np.arange(int(kept.sum())) + np.repeat((np.arange(len(parts)) + 1) * (ORDER - 1), kept)
        return codes, places, np.repeat(np.array(owners), kept)

    parts, owners, held = [], [], 0
    for i, text in enumerate(texts):
        padded = PAD * (ORDER - 1) + text
        for at in range(0, len(text), piece):
            parts.append(padded[at:at + piece + ORDER - 1])
            owners.append(i)
            held += len(parts[-1])
            if held >= piece:
                yield flush()
                parts, owners, held = [], [], 0
    if parts:
        yield flush()


def _numbered(codes: np.ndarray, places: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the n-gram at each place, keys of the distinct ones by number), by hashing, without a sort."""
    for j in range(ORDER):
        seeds = _step(seeds, codes[places - j])
    number, keys = pd.factorize(seeds.view(np.int64))
    return number, keys.view(np.uint64)


def _firsts(number: np.ndarray, n: int) -> np.ndarray:
    """Where each of `n` numbers stands first."""
    first = np.empty(n, np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    return first


def _merged(found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal n-grams of several pieces as one, with the sum of their counts."""
    keys, codes, kind, n = (np.concatenate(x) for x in zip(*found, strict=True))
    found.clear()
    number, keys = pd.factorize(keys.view(np.int64))
    first = _firsts(number, len(keys))
    return keys.view(np.uint64), codes[first], kind[first], np.bincount(number, n, len(keys)).astype(np.int64)


def top_grams(texts: list[str], kinds: np.ndarray, seeds: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, codes, kinds, counts) of the distinct n-grams of `ORDER` characters, in order of key.

    `kinds` number the tables that texts belong to, `seeds` are the tables' hashes.
    Pieces are brought together as they come, so that what is held grows with
    the distinct n-grams and not with the text.
    """
    found, waiting = [], 0
    for codes, places, owner in _pieces(texts, piece):
        kind = kinds[owner]
        number, keys = _numbered(codes, places, seeds[kind])
        first = _firsts(number, len(keys))
        at = places[first]
        found.append((keys, np.stack([codes[at - j] for j in reversed(range(ORDER))], axis=1), kind[first], np.bincount(number)))
        waiting += len(keys)
        if waiting > max(WAITING, len(found[0][0])):
            found, waiting = [_merged(found)], 0
    if not found:
        return np.zeros(0, np.uint64), np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, codes, kind, n = _merged(found)
    order = np.argsort(keys)
    return keys[order], codes[order], kind[order], n[order]


def _suffix_keys(codes: np.ndarray, seeds: np.ndarray, skip: int) -> list[np.ndarray]:
    """Keys of the n-grams of 0, 1, 2, ... characters that end `skip` characters before the last."""
    out = [seeds]
    for j in range(ORDER - skip):
        out.append(_step(out[-1], codes[:, ORDER - 1 - skip - j]))
    return out


def table_seed(lang: str, fold: int) -> int:
    return xxhash.xxh64_intdigest(f"{fold} {lang}".encode("utf-8", "surrogatepass"))


# ---------------------------------------------------------------- training
def _kinds(names: list) -> tuple[np.ndarray, list]:
    """Numbers of the distinct names (null: -1) and the names."""
    kinds = list(dict.fromkeys(x for x in names if x is not None))
    number = {x: i for i, x in enumerate(kinds)} | {None: -1}
    return np.array([number[x] for x in names], np.int64), kinds


def gram_counts(blocks: DataFrame, trusted: DataFrame, pooled: bool) -> DataFrame:
    """(lang, fold, gram, n), written: n-grams of `ORDER` characters of the trusted documents; the fold is that of the tables.

    trusted (part, block, at) names documents by their place in a block.  Also
    under POOLED if asked for.
    """
    def count(batches):
        for _, _, payload, marks in each(batches, "trusted"):
            docs = opened(payload).take(pa.array(sorted(x["at"] for x in marks), pa.int64()))
            if not docs.num_rows:
                continue
            names = list(zip(docs.column("lang").to_pylist(), docs.column("fold").to_pylist(), strict=True))
            number, kinds = _kinds(names)
            seeds = np.array([table_seed(str(lang), fold) for lang, fold in kinds], np.uint64)
            _, codes, kind, n = top_grams([characters(t) for t in docs.column("text").to_pylist()], number, seeds)
            grams = np.ascontiguousarray(codes, np.uint32).view(f"<U{ORDER}").ravel()
            of = pa.array(kind)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kinds], pa.string()).take(of), pa.array([1 - k[1] for k in kinds], pa.int32()).take(of),
                                              pa.array(grams.tolist(), pa.string()), pa.array(n)], names=["lang", "fold", "gram", "n"])

    seen = with_answers(blocks, {"trusted": trusted}, "inner").mapInArrow(count, "lang string, fold int, gram string, n long")
    seen = written(seen.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    own = seen.where("lang IS NOT NULL")
    if not pooled:
        return own
    return written(own.unionByName(seen.groupBy("fold", "gram").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(POOLED))), "gram-counts")


def discounts(grams: DataFrame, *by: str) -> DataFrame:
    """(by, d1, d2, d3): what is taken from n-grams seen once, twice, and more often."""
    of = [F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.0)
    taken = [F.when(F.col(f"n{i}") > 0, i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")).otherwise(F.lit(i / 2)) for i in (1, 2, 3)]
    return grams.groupBy(*by).agg(*of).select(*by, *(F.least(F.lit(i - 0.05), F.greatest(F.lit(0.05), d)).alias(f"d{i}") for i, d in enumerate(taken, 1)))


def model_entries(counts: DataFrame) -> DataFrame:
    """(lang, fold, gram, alpha, gamma) from counts of the longest n-grams.

    `alpha` is an n-gram's own share after its context, what is left of its
    count over the context's; `gamma` the share that the n-gram, as a context,
    leaves to shorter ones.  Shorter n-grams count the characters seen before them.
    """
    by, level, out = ["lang", "fold"], counts, []
    for k in range(ORDER, 0, -1):
        taken = level.join(F.broadcast(discounts(level, *by)), by)  # a row per table
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        taken = taken.select(*by, "gram", "n", d.alias("d"), F.substring("gram", 1, k - 1).alias("context"))
        contexts = taken.groupBy(*by, "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma"))
        alpha = taken.join(contexts.select(*by, "context", "total"), [*by, "context"]).select(*by, "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("alpha"), F.lit(None).cast("double").alias("gamma"))
        out += [alpha, contexts.select(*by, F.col("context").alias("gram"), F.lit(None).cast("double").alias("alpha"), "gamma")]
        if k > 1:
            level = written(level.groupBy(*by, F.substring("gram", 2, k - 1).alias("gram")).agg(F.count("*").alias("n")), "gram-counts")
    both = out[0]
    for x in out[1:]:
        both = both.unionByName(x)
    return both.groupBy(*by, "gram").agg(F.max("alpha").alias("alpha"), F.max("gamma").alias("gamma"))


# ---------------------------------------------------------------- scoring
_ENTRY = 16  # bytes of a table's entry in a slice: key, alpha, gamma
_ANSWER = "part long, block long, slice long, flags binary, found binary"


def _entries_sent(entries: DataFrame, bits: int) -> DataFrame:
    """The tables as rows to the slices, from no block (part -1)."""
    def send(batches):
        for batch in batches:
            number, kinds = _kinds(list(zip(batch.column("lang").to_pylist(), batch.column("fold").to_pylist(), strict=True)))
            keys = np.array([table_seed(*k) for k in kinds], np.uint64)[number]
            grams = batch.column("gram").to_pylist()
            size = np.array([len(g) for g in grams])
            codes = np.frombuffer("".join(g.rjust(ORDER, PAD) for g in grams).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, ORDER)
            for j in range(ORDER):
                keys = np.where(j < size, _step(keys, codes[:, ORDER - 1 - j]), keys)
            order = np.argsort(keys, kind="stable")
            alpha, gamma = (batch.column(c).fill_null(0).to_numpy().astype("<f4")[order] for c in ("alpha", "gamma"))
            keys = keys[order]
            yield from sent(-1, 0, keys >> np.uint64(64 - bits), lambda a, b: keys[a:b].tobytes() + alpha[a:b].tobytes() + gamma[a:b].tobytes())  # noqa: B023

    return entries.select("lang", "fold", "gram", "alpha", "gamma").mapInArrow(send, SENT)


def _answer(group: pa.Table) -> pa.Table:
    """For each block in a slice: which of its keys the tables hold, and the numbers of those."""
    rows = list(zip(*(group.column(c).to_pylist() for c in ("part", "block", "slice")), (x.as_buffer() for x in group.column("body")), strict=True))
    tables = [(b, b.size // _ENTRY) for p, _, _, b in rows if p == -1]
    cut = lambda kind, skip: np.concatenate([np.frombuffer(b, kind, n, skip * n) for b, n in tables] or [np.zeros(0, kind)])
    keys, alpha, gamma = cut("<u8", 0), cut("<f4", 8), cut("<f4", 12)
    order = np.argsort(keys, kind="stable")
    keys, alpha, gamma, out = keys[order], alpha[order], gamma[order], []
    for part, block, number, body in rows:
        if part == -1 or not len(keys):
            continue
        asked = np.frombuffer(body, "<u8")
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        known = keys[at] == asked
        at = at[known]
        out.append((part, block, number, np.packbits(known).tobytes(), alpha[at].tobytes() + gamma[at].tobytes()))
    kinds = [("part", pa.int64()), ("block", pa.int64()), ("slice", pa.int64()), ("flags", pa.binary()), ("found", pa.binary())]
    return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(kinds)})


class Scored:
    """The documents of a block, the tables they are scored by, and the n-grams they ask for."""

    def __init__(self, payload: bytes, tables: frozenset):
        docs = opened(payload)
        self.ids, self.langs = (docs.column(c).combine_chunks() for c in ("doc_id", "lang"))
        names = [_table(*x, tables) for x in zip(self.langs.to_pylist(), docs.column("fold").to_pylist(), strict=True)]
        self.models = [n and n[0] for n in names]
        self.kinds, kinds = _kinds(names)
        self.seeds = np.array([table_seed(*k) for k in kinds], np.uint64)
        self.texts = [characters(t.as_py()) for t in docs.column("text")]
        del docs
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.asked = [t if k >= 0 else "" for t, k in zip(self.texts, self.kinds.tolist(), strict=True)]
        self.keys, codes, kind, _ = top_grams(self.asked, self.kinds, self.seeds)
        seeds = self.seeds[kind]
        #: Of each n-gram the keys of its suffixes, and of its contexts, by length.
        self.grams, self.contexts = _suffix_keys(codes, seeds, 0), _suffix_keys(codes, seeds, 1)
        self.all_keys = np.unique(np.concatenate([pd.unique(x) for x in (*self.grams[1:], *self.contexts)]))

    def logs(self, bits: int, answers: list[dict]) -> np.ndarray:
        """The log probability of each n-gram's last character after the others, in UNITs."""
        alpha, gamma = np.zeros(len(self.all_keys)), np.zeros(len(self.all_keys))
        slices = self.all_keys >> np.uint64(64 - bits)
        for x in answers:
            at = slice_range(slices, x["slice"])
            held = unpacked(x["flags"], at.stop - at.start)
            found = np.frombuffer(x["found"], "<f4").reshape(2, -1)
            places = np.nonzero(held)[0] + at.start
            alpha[places], gamma[places] = found
        p = np.full(len(self.keys), 1 / OPEN)
        for k in range(1, ORDER + 1):
            gram, context = np.searchsorted(self.all_keys, self.grams[k]), np.searchsorted(self.all_keys, self.contexts[k - 1])
            p = np.where(gamma[context] > 0, alpha[gram] + gamma[context] * p, p)  # a context that was never seen leaves all to shorter ones
        return np.round(np.log(p) * UNIT).astype(np.int64)

    def totals(self, logs: np.ndarray) -> np.ndarray:
        """The sum of the log probabilities of each document's characters."""
        out = np.zeros(len(self.texts), np.int64)
        for codes, places, owner in _pieces(self.asked, PIECE):
            number, keys = _numbered(codes, places, self.seeds[self.kinds[owner]])
            each_one = logs[np.searchsorted(self.keys, keys)][number]
            first = np.append(0, np.nonzero(np.diff(owner))[0] + 1)
            out[owner[first]] += np.add.reduceat(each_one, first)
        return out


def _table(lang: str | None, fold: int, tables: frozenset) -> tuple[str, int] | None:
    return next((t for name in (lang, POOLED) for t in [(name, (fold + i) % FOLDS) for i in range(FOLDS)] if t in tables), None)


def score_documents(blocks: DataFrame, counts: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, lang, model (the language of the tables used), n_symbols (characters), perplexity for each document of the blocks."""
    tables = frozenset((r.lang, r.fold) for r in counts.select("lang", "fold").distinct().collect())  # FOLDS rows per language
    bits = slice_bits(total_bytes(blocks), slice_bytes)

    def ask(batches):
        for part, number, payload in each(batches):
            keys = Scored(payload, tables).all_keys
            yield from sent(part, number, keys >> np.uint64(64 - bits), lambda a, b: keys[a:b].tobytes())  # noqa: B023

    asked = blocks.select("part", "block", "payload").mapInArrow(ask, SENT)
    answers = asked.unionByName(_entries_sent(model_entries(counts), bits)).groupBy("slice").applyInArrow(_answer, _ANSWER)

    def score(batches):
        for _, _, payload, own in each(batches, "answers"):
            docs = Scored(payload, tables)
            total = docs.totals(docs.logs(bits, own))
            given = np.array([m is not None for m in docs.models], bool) & (docs.sizes > 0)
            perplexity = np.round(np.exp(-total / UNIT / np.maximum(docs.sizes, 1)), 6)
            yield pa.RecordBatch.from_arrays([docs.ids, docs.langs, pa.array(docs.models, pa.string()), pa.array(docs.sizes), pa.array(perplexity, mask=~given)],
                                             names=["doc_id", "lang", "model", "n_symbols", "perplexity"])

    return with_answers(blocks, {"answers": answers}, "left").mapInArrow(score, "doc_id long, lang string, model string, n_symbols long, perplexity double")


# ---------------------------------------------------------------- verdict
def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids that a label calls good and none calls toxic."""
    return (labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic"), F.lit(0)).cast("int")).alias("toxic"))
            .where("good = 1 AND toxic = 0").select("doc_id"))


def trusted_places(blocks: DataFrame, trusted: DataFrame) -> DataFrame:
    """(part, block, at): where documents with a trusted id stand; ids meet ids, no text moves."""
    def places(batches):
        for part, block, payload in each(batches):
            ids = opened(payload).column("doc_id").combine_chunks()
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part)), pa.array(np.full(n, block)), pa.array(np.arange(n)), ids], names=["part", "block", "at", "doc_id"])

    held = blocks.select("part", "block", "payload").mapInArrow(places, "part long, block long, at long, doc_id long")
    return held.join(trusted.hint("merge"), "doc_id", "left_semi").select("part", "block", "at")  # both grow with the documents


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, low, high, kept for each row of docs (doc_id, lang, text)."""
    trusted = trusted_ids(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    held = docs.join(trusted.hint("merge"), "doc_id", "left_semi").where("lang IS NOT NULL").select("lang").distinct()
    pooled = not docs.select("lang").distinct().join(held, "lang", "left_anti").isEmpty()
    with batches_of(docs.sparkSession, BATCH_BYTES):
        blocks = blocks_of(docs.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")), block_bytes, LEVEL)
        places = written(trusted_places(blocks, trusted), "trusted-places")
        scored = written(score_documents(blocks, gram_counts(blocks, places, pooled)), "perplexities")
    known = scored.where("perplexity IS NOT NULL AND model IS NOT NULL").join(trusted.hint("merge"), "doc_id", "left_semi")
    bounds = lambda rows: rows.groupBy("model").agg(F.percentile_approx("perplexity", F.array(F.lit(low), F.lit(high)), 100_000).alias("q"))
    both = bounds(known).where(F.col("model") != POOLED).unionByName(bounds(known.withColumn("model", F.lit(POOLED))))
    limits = both.select("model", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    kept = F.when(F.col("n_symbols") == 0, False).otherwise(F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True)))
    return scored.join(F.broadcast(limits), "model", "left").select("doc_id", "lang", "n_symbols", "perplexity", "low", "high", kept.alias("kept"))  # limits: a row per language


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Perplexity and verdict for the whole of `documents`, trained on what `labels` trusts."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
