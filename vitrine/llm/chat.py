r"""Operator 3, chat formatting: rendered turns, a deterministic parser, escapes until the round trip is identical.

Grammar of a formatted conversation (turns in a row, nothing between):

    turn = "### " role "\n" body "\n</turn>\n"

In a body, ``###`` and ``</turn>`` count as control strings unless a backslash
precedes them; one backslash of the run before a control string is the escape
and is taken away by the parser.  A role is one line, with ``\\`` for a
backslash and ``\n`` for a line feed.  A turn is rendered as it is, parsed, and compared to its
source; if they differ, its control strings are escaped and it is rendered
again.  The line feed before the end mark keeps a body's last backslashes away
from it, so turns can be joined, and parsing a conversation is parsing its
turns one by one.

Rendering and parsing are local to a row.  Only the digests of a conversation
need its turns in order: they are sorted by Spark within the conversation's
partition and streamed through running hashes, so memory is a record batch
however long a conversation is (a digest chain itself can't be split).

Defined results: null role and text are empty; turns with equal numbers (and
repeated rows) stay, ordered by role and text, null numbers first; null
conv_ids are one conversation; extra columns are ignored; an empty table has no
conversations.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, table, written

HEAD, STOP = "### ", "\n</turn>\n"
CONTROL = re.compile(r"(\\*)(###|</turn>)")
ASSISTANT = "assistant"


def _role_line(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def _role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, body start, body end) of each turn; ValueError if the text is not of the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        if not formatted.startswith(HEAD, at) or line < 0:
            raise ValueError(f"no turn begins at {at}")
        role, start = formatted[at + len(HEAD):line], line + 1
        pieces, done = [], start
        for m in CONTROL.finditer(formatted, start):
            if m[1]:
                pieces += formatted[done:m.start()], m[0][1:]
                done = m.end()
            elif m[2] == "</turn>" and formatted.startswith(STOP, m.start() - 1) and m.start() > start:
                break
            else:
                raise ValueError(f"a control string at {m.start()}")
        else:
            raise ValueError("a turn without an end")
        end = m.start() - 1
        turns.append((_role(role), "".join([*pieces, formatted[done:end]]), start, end))
        at = end + len(STOP)
    return turns


def render(role: str | None, text: str | None) -> tuple[str, int, int]:
    """(formatted turn, body start, body end) that parses back to exactly this role and text."""
    source = (role or "", text or "")
    head, body = f"{HEAD}{_role_line(source[0])}\n", source[1]
    for _ in range(2):
        formatted = head + body + STOP
        try:
            if [t[:2] for t in parse(formatted)] == [source]:
                return formatted, len(head), len(head) + len(body)
        except ValueError:
            pass
        body = CONTROL.sub(lambda m: "\\" + m[0], source[1])
    raise AssertionError("escaped text has to round-trip")


def unescape(body: str) -> str:
    return CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], body)


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, source order (role, text as they came), formatted, loss_start, loss_end.

    A conversation's formatted text is its turns' `formatted` in the order of
    (turn, role, text); loss_start and loss_end bound the part under the loss
    mask, in code points of `formatted` (null: none).
    """
    kinds = conversations.schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(*render(r, t), r == ASSISTANT) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), pa.array([r[0] for r in rows], pa.string()),
                                           *(pa.array([r[k] if r[3] else None for r in rows], pa.int64()) for k in (1, 2))],
                                          names=["conv_id", "turn", "formatted", "loss_start", "loss_end"])

    return map_batches(conversations.select("conv_id", "turn", "role", "text"), run,
                       f"conv_id {kinds['conv_id'].dataType.simpleString()}, turn {kinds['turn'].dataType.simpleString()}, formatted string, loss_start long, loss_end long")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted turns alone."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, a, b in zip(*(batch.column(c).to_pylist() for c in ("formatted", "loss_start", "loss_end")), strict=True):
            for role, body, _, _ in parse(text):
                out.append((role, body, unescape(text[a:b]) if a is not None else None, len(text)))
        return pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64())))],
                                          names=["conv_id", "turn", "role", "text", "loss", "chars"])

    def digest(batches):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        schema = None
        now, state = None, None

        def row():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(schema)], names=names)

        for batch in batches:
            schema = (batch.column("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            rows = []
            for conv, role, text, loss, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss", "chars")), strict=True):
                if now != (conv,):
                    if now:
                        rows.append(row())
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[4] += chars
                if loss is not None:
                    state[2] += len(loss)
                    state[3].update(loss.encode("utf-8", "surrogatepass"))
            if rows:
                yield made(rows)
        if now:
            yield made([row()])

    turns = map_batches(formatted, read, f"conv_id {kind}, turn {formatted.schema['turn'].dataType.simpleString()}, role string, text string, loss string, chars long", "formatted")
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


#: The contract's conversation -7: its texts hold control strings, one of them escaped already.
ADVERSE = r"\### Assistant: </turn> ok"


def op3_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 3 over the whole of `conversations` and conversation -7, read back from the written output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    adverse = spark.createDataFrame([(-7, 0, "user", ADVERSE), (-7, 1, ASSISTANT, ADVERSE)], given.schema)
    return conversation_digests(written(format_turns(given.unionByName(adverse)), "formatted"))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, CASE WHEN role = 'assistant' THEN text END AS loss,
  15 + length(replace(replace(role, '\', '\\'), chr(10), '\n')) + length(regexp_replace(text, '(###|</turn>)', '\\\1', 'g')) - 1 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(loss)), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(loss, '' ORDER BY turn, role, text), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
