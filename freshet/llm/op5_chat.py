"""Chat formatting with a grammar round trip.

A conversation is the concatenation of its turns, each rendered as

    turn = "### " role ": " body "</turn>\\n"

Control strings are ``### ``, ``</turn>`` and, in a role, ``: ``. A backslash
before ``\\``, ``#``, ``<`` or ``:`` makes that character plain; before anything
else it is itself. The parser is deterministic, needs no look-ahead beyond a turn
and refuses a control string that is neither escaped nor in its place, so a text
can neither end its turn nor open another one.

Each turn is rendered, parsed again and compared with its source. If they differ
(or the parser refuses), the conflicting content is escaped and the turn tried
again: first nothing is escaped, then control strings, then backslashes as well;
the last form always comes back identical. As the parser needs nothing of the
neighbours, identical turns make an identical conversation, and turns are rendered
wherever their rows are: there is no shuffle until someone reads conversations in
order.

Reading back sorts the rendered turns within partitions of whole conversations
and streams through them: a conversation of any length costs one open digest, not
its text. (SHA-256 is sequential, so one conversation is read by one task.)

The loss mask is the span of an assistant's body in its rendered turn.

Defined cases: null texts and roles are empty; a null conv_id is a conversation
of its own; turns are ordered by turn (null first), then by their rendered form;
repeated rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table

OPEN, COLON, CLOSE, AFTER = "### ", ": ", "</turn>", "\n"
LOSS_ROLE = "assistant"
LEVELS = 3
_CONTROL = re.compile(r"(### |</turn>)")
_ROLE_CONTROL = re.compile(r"(### |</turn>|: )")
_ESCAPED = re.compile(r"\\([\\#<:])")
_ROLE_END = re.compile(r"\\[\\#<:]|(: )|(### |</turn>)")
_BODY_END = re.compile(r"\\[\\#<:]|(</turn>)|(### )")

#: A conversation whose texts imitate the template, added by the query.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def _escape(text: str, control: re.Pattern, level: int) -> str:
    if level >= 2:
        text = text.replace("\\", "\\\\")
    if level >= 1:
        text = control.sub(r"\\\1", text)
    return text


def plain(text: str) -> str:
    """Escaped text as it was."""
    return _ESCAPED.sub(r"\1", text)


def _until(text: str, at: int, ends: re.Pattern) -> re.Match:
    for m in ends.finditer(text, at):
        if m[1]:
            return m
        if m[2]:
            break
    raise ValueError("no end, or a control string out of its place")


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Turns of a rendered conversation: role, body, and the body's span;
    ValueError if the text is not one."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError("a turn is missing")
        role = _until(text, at + len(OPEN), _ROLE_END)
        body = _until(text, role.end(), _BODY_END)
        if not text.startswith(AFTER, body.end()):
            raise ValueError("text after a turn")
        turns.append((plain(text[at + len(OPEN):role.start()]), plain(text[role.end():body.start()]), role.end(), body.start()))
        at = body.end() + len(AFTER)
    return turns


def render(role: str, body: str) -> tuple[str, int, int, int]:
    """A turn that comes back identical, its body's span and the escape level
    it took."""
    for level in range(LEVELS):
        head = OPEN + _escape(role, _ROLE_CONTROL, level) + COLON
        shown = _escape(body, _CONTROL, level)
        out = head + shown + CLOSE + AFTER
        try:
            back = parse(out)
        except ValueError:
            continue
        if back == [(role, body, len(head), len(head) + len(shown))]:
            return out, len(head), len(head) + len(shown), level
    raise AssertionError("the last escape level always comes back identical")


_TURNS = "conv_id long, turn long, rendered string, loss_start int, loss_end int, level int"


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, rendered, loss_start, loss_end, level) per row; the loss
    span is null for turns that are not the assistant's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles = b.column("role").to_pylist()
            made = [render(r or "", t or "") for r, t in zip(roles, b.column("text").to_pylist())]
            mine = [r == LOSS_ROLE for r in roles]
            yield pa.RecordBatch.from_arrays([
                b.column("conv_id"), b.column("turn"), pa.array([m[0] for m in made], pa.string()),
                pa.array([m[1] if k else None for m, k in zip(made, mine)], pa.int32()),
                pa.array([m[2] if k else None for m, k in zip(made, mine)], pa.int32()),
                pa.array([m[3] for m in made], pa.int32()),
            ], names=["conv_id", "turn", "rendered", "loss_start", "loss_end", "level"])

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _TURNS)


class _Reader:
    """Digests of the conversation at hand."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, loss_start: int | None, loss_end: int | None) -> None:
        for role, body, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
        self.chars += len(rendered)
        if loss_start is not None:
            body = plain(rendered[loss_start:loss_end])
            self.loss_chars += len(body)
            self.loss.update(body.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_BACK = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered turns alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for b in batches:
            done = []
            for conv_id, rendered, lo, hi in zip(*(b.column(c).to_pylist() for c in ("conv_id", "rendered", "loss_start", "loss_end"))):
                if reader is None or reader.conv_id != conv_id:
                    if reader:
                        done.append(reader.row())
                    reader = _Reader(conv_id)
                reader.add(rendered, lo, hi)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], f.type) for i, f in enumerate(_BACK)], schema=_BACK)
        if reader:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(reader.row(), _BACK)], schema=_BACK)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "rendered")
    return ordered.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(run, schema)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, LOSS_ROLE, PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(rows.unionByName(probe)))


def _sql() -> str:
    probe = PROBE_TEXT.replace("'", "''")
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({PROBE_ID}, 0, 'user', '{probe}'), ({PROBE_ID}, 1, '{LOSS_ROLE}', '{probe}')),
-- The least escaping that comes back: none, control strings, or backslashes too.
body AS (
  SELECT *, regexp_matches(text, '### |</turn>') AS control, regexp_matches(text, '\\\\[\\\\#<:]|\\\\$') OR regexp_matches(text, '\\\\(### |</turn>)') AS slash FROM rows),
shown AS (
  SELECT *, CASE WHEN slash THEN regexp_replace(replace(text, '\\', '\\\\'), '(### |</turn>)', '\\\\\\1', 'g')
                 WHEN control THEN regexp_replace(text, '(### |</turn>)', '\\\\\\1', 'g') ELSE text END AS escaped
  FROM body)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum({len(OPEN + COLON + CLOSE + AFTER)} + length(role) + length(escaped)) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""


QUERIES = {"op5_chat": op5_chat}
ORACLE = {"op5_chat": _sql()}
