"""Operator 8, secret scans: a trigram index in front of the rules, DataFrame functions only.

Each rule is a regular expression.  From its literal parts a Boolean query over
trigrams is derived (a disjunction of clauses, each a conjunction of
trigrams) that every match must satisfy.  The index holds postings
(trigram, doc_id) for the trigrams the rules ask for; a clause's postings are
intersected by grouping on doc_id with a bit per trigram, a rule's clauses are
united, and the resulting candidates are joined back to the texts, where the
rule itself runs.  A rule without mandatory trigrams (here: long hex strings)
runs over every text.

The index is case-folded, so it only ever has too many candidates.  Postings
are at most (trigrams of the rules) rows per document and are combined per
document before the shuffle; the rule set is the only thing broadcast.

Defined results: null or empty text has no spans; repeated doc_ids share the
candidates of all their rows, which verification makes exact again; null
doc_ids match each other; extra columns are kept by `redacted` and ignored by
`secret_spans`; empty tables give empty results.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import free, table

MARK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """`pattern` finds; a match whose `group` has fewer than `least` characters is dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# A private key spans from its BEGIN line to its END line.  Between them stand header fields and base64, which may be
# indented, quoted, commented, escaped or folded into one line.  Without an END line the span goes on to the last run of
# 40 base64 characters and a short line after it; lines narrower than that have to follow at once.  No group repeats
# without bound: Java recurses for each turn, and a long text would end the task.
_FIELDS = r"""(?:[\x20\t\r\n\\]*[A-Za-z]+-[A-Za-z]+:\x20[^\n\\]*){0,9}"""
_INSIDE, _BETWEEN, _DIGIT = r"""[A-Za-z0-9+/=\x20\t\r\n\\"',;>#*|]*""", r"""[\x20\t\r\n\\"',;>#*|]*""", "[A-Za-z0-9+/]"
_CLOSED = _INSIDE + "-----END (?:[A-Z]+ )?PRIVATE KEY-----"
_SHORT = rf"""[\x20\t\r]*\n[\x20\t]*{_DIGIT}+={{0,2}}[\x20\t\r]*(?:\n|$)|{_BETWEEN}{_DIGIT}+(?:={{1,2}}|$)"""
_OPEN = rf"""{_BETWEEN}{_DIGIT}{{40}}(?:{_INSIDE}{_DIGIT}{{40}})?[A-Za-z0-9+/=]*(?:{_SHORT})?|[\x20\t\r]*\n{_DIGIT}[A-Za-z0-9+/=\r\n]*(?:\n|$)|(?:{_SHORT})?"""

# The three kinds of the contract, then common credential formats.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----" + f"{_FIELDS}(?:{_CLOSED}|{_OPEN})"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)

#: More strings than this from one literal run are not spelt out; the run is cut there.
MOST_STRINGS = 64


def _strings(node) -> set[str] | None:
    """All strings one parsed item can match, lower-cased; None if they aren't few and plain."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        out = set()
        for o, a in arg:
            if o is sre.LITERAL:
                out.add(chr(a).lower())
            elif o is sre.RANGE and a[1] - a[0] < 4:
                out |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 2:
        one = _sequence_strings(arg[2])
        return None if one is None else {"".join(x) for n in range(arg[0], arg[1] + 1) for x in itertools.product(one, repeat=n)}
    return None


def _sequence_strings(items) -> set[str] | None:
    out = {""}
    for node in items:
        s = _strings(node)
        if s is None or len(out) * len(s) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Clauses of trigrams of which each match satisfies one; None: every text must be scanned.

    Literal runs of the pattern become string sets; a run whose every string has a
    trigram gives a condition, and the conditions of all runs are conjoined.
    """
    runs, now = [], {""}
    for node in [*parser.parse(pattern), None]:
        s = _strings(node) if node else None
        if s is not None and len(now) * len(s) <= MOST_STRINGS:
            now = {a + b for a in now for b in s}
            continue
        runs.append(now)
        now = s if s is not None else {""}
    conditions = []
    for run in runs:
        clauses = {frozenset(x[i:i + 3] for i in range(len(x) - 2)) for x in run}
        if frozenset() not in clauses:
            conditions.append([c for c in clauses if not any(d < c for d in clauses)])
    if not conditions:
        return None
    clauses = {frozenset().union(*x) for x in itertools.islice(itertools.product(*conditions), MOST_STRINGS + 1)}
    if len(clauses) > MOST_STRINGS:
        clauses = set(min(conditions, key=len))
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id), a row for each of `trigrams` that stands in the case-folded text."""
    text = F.lower("text")
    return (docs.select("doc_id", text.alias("text"))
            .select("doc_id", F.explode(F.filter(F.array(*map(F.lit, trigrams)), lambda g: F.contains(F.col("text"), g))).alias("trigram")))


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, rules): a bit for each rule whose trigram query the document's postings satisfy."""
    clauses = [(k, c) for k, r in enumerate(rules) for c in trigram_query(r.pattern) or ()]
    if not clauses:
        return docs.select("doc_id", F.lit(0).cast("long").alias("rules")).limit(0)
    grams = sorted(set().union(*(c for _, c in clauses)))
    bits = [(n, g, 1 << i) for n, (_, c) in enumerate(clauses) for i, g in enumerate(sorted(c)[:62])]
    of_gram: dict[str, list] = {}
    for n, g, b in bits:
        of_gram.setdefault(g, []).append(F.struct(F.lit(n).alias("clause"), F.lit(b).cast("long").alias("bit")))
    asked = F.create_map(*(x for g in grams if g in of_gram for x in (F.lit(g), F.array(*of_gram[g]))))
    full = F.array(*(F.lit((1 << min(62, len(c))) - 1).cast("long") for _, c in clauses))
    rule = F.array(*(F.lit(1 << k).cast("long") for k, _ in clauses))
    return (trigram_postings(docs, grams)
            .select("doc_id", F.explode(F.element_at(asked, F.col("trigram"))).alias("a"))
            .groupBy("doc_id", "a.clause").agg(F.bit_or("a.bit").alias("bits"))
            .where(F.col("bits") == F.get(full, F.col("clause")))
            .groupBy("doc_id").agg(F.bit_or(F.get(rule, F.col("clause"))).alias("rules")))


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) in code points: matches are measured between the gaps that the same pattern splits."""
    pattern = F.lit(rule.pattern)
    n = lambda c: F.length(c)
    piece = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
                         F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    step = lambda acc, p: F.struct(
        (acc["at"] + n(p["gap"]) + F.coalesce(n(p["whole"]), F.lit(0))).alias("at"),
        F.when(n(p["part"]) >= rule.least, F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + n(p["gap"])).alias("start"), (acc["at"] + n(p["gap"]) + n(p["whole"])).alias("end")))))
        .otherwise(acc["out"]).alias("out"))
    found = F.aggregate(piece, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(empty)


def with_spans(docs: DataFrame, rules=RULES, name: str = "spans") -> DataFrame:
    """`docs` with `name`: array of (start, kind number, end), in text order, then as the rules are listed."""
    scanned = [trigram_query(r.pattern) is None for r in rules]
    key, asked = free(docs, "__id"), free(docs, "__rules")
    # Texts meet their candidates by id and text: no id, or none, is a hot key, and rows that share a hash at worst have more rules verified.
    row = F.xxhash64(docs["doc_id"], docs["text"])
    found = candidates(docs.select(row.alias("doc_id"), "text"), rules).select(F.col("doc_id").alias(key), F.col("rules").alias(asked))
    joined = docs.join(found, row == found[key], "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = []
    for k, r in enumerate(rules):
        kind = F.lit(k).alias("kind")
        own = F.transform(_spans(text, r), lambda s: F.struct(s["start"].alias("start"), kind, s["end"].alias("end")))  # noqa: B023
        parts.append(own if scanned[k] else F.when(F.coalesce(F.col(asked).bitwiseAND(F.lit(1 << k)) != 0, F.lit(False)), own).otherwise(empty))
    return joined.withColumn(name, F.array_sort(F.concat(*parts))).drop(key, asked)


def redacted(docs: DataFrame, rules=RULES, mark: str = MARK) -> DataFrame:
    """`docs` with every span replaced by `mark` (overlapping spans by one) and n_chars set anew; other columns as they are."""
    text, name = F.col("text"), free(docs, "spans")
    step = lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
        s["end"].alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))).alias("out")))
    cut = F.aggregate(name, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step,
                      lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    found = F.size(name) > 0
    out = with_spans(docs, rules, name).withColumn("text", F.when(found, cut).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(found, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _joined(spans: Column, rules) -> Column:
    kind = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"], s["end"])), ",")


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 8 over the whole of `documents`."""
    n_base = sum(r.base for r in RULES)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return (with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", *(count(k).alias(f"n_{RULES[k].kind}") for k in range(n_base)),
                    F.sha2(_joined(F.filter("spans", lambda s: s["kind"] < n_base), RULES), 256).alias("base_sha256"),
                    _joined(F.col("spans"), RULES).alias("spans")))


def _oracle(rules=RULES) -> str:
    """The same without an index: every rule over every text, positions from the split pieces."""
    quote = lambda s: s.replace("'", "''")
    kinds = []
    for k, r in enumerate(rules):
        p = quote(r.pattern)
        kinds.append(f"""SELECT rid, {k} AS k, '{r.kind}' AS kind, sum(g + m) OVER w - m AS s, sum(g + m) OVER w AS e, part FROM (
 SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(list_transform(gaps[1:len(ms)], lambda x: length(x))) AS g, unnest(list_transform(ms, lambda x: length(x))) AS m, unnest(list_transform(ps, lambda x: length(x))) AS part
 FROM (SELECT rid, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {r.group}) AS ps FROM d WHERE regexp_matches(text, '{p}')))
 WINDOW w AS (PARTITION BY rid ORDER BY i) QUALIFY part >= {r.least}""")
    base = sum(r.base for r in rules)
    counts = ", ".join(f"count(*) FILTER (WHERE k = {k}) AS n_{rules[k].kind}" for k in range(base))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
p AS ({" UNION ALL ".join(f"({x})" for x in kinds)}),
t AS (SELECT *, kind || ':' || s::BIGINT || ':' || e::BIGINT AS span FROM p),
g AS (SELECT rid, {counts}, string_agg(span, ',' ORDER BY s, k) FILTER (WHERE k < {base}) AS b, string_agg(span, ',' ORDER BY s, k) AS spans FROM t GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{rules[k].kind}, 0) AS n_{rules[k].kind}" for k in range(base))}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""


ORACLE = _oracle()
