"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation's role initials fit ``(s?(ua)+)?``. Reading such a
sequence passes four states: nothing yet, after the system turn, after a user
turn, after an assistant turn; the first and the last may end it. A row can be
kept, given the role its place asks for (Rerole), or deleted, and an empty turn of
that role can be inserted before it. From a state every edit leads to one state,
so a state before each row and the edits' letters say the same.

A *passage* is a 4 x 4 matrix: the cost of the cheapest edits of some rows from
each state to each state, and the rank of their letters (the audit) among those
from the same state. Passages chain: a passage over two stretches is the cheapest
meeting state, ties to the lower rank of the first stretch. (That decides the
audit as a whole. A stretch's letters end with a row's own letter, as insertions
belong to the row after them, so no audit of a stretch begins another one.)

Reconstruction is Hirschberg's: a forward vector over the first half and a
backward vector over the second meet in the middle, the cheapest crossing (ties to
the least audit) is fixed, and both halves are solved the same way between known
states. No table of all rows' states is kept. Halves of halves run in tasks:

1. Rows are numbered over ranges of (conversation, turn, role, text) and cut into
   blocks of ``BLOCK``. Conversations inside a block are solved there.
2. The stretches at a block's borders give their passages; ``FANOUT`` neighbours
   chain to the passage of their node, level by level, up to the conversation.
3. From there down, each node with known ends fixes its children's crossings, and
   last the stretches are solved between theirs. A conversation with a third of
   all rows is many stretches.
4. Rows, edits and one marker per conversation meet sorted by conversation and row
   and are streamed once: a conversation of any length costs one open digest and
   its audit. (SHA-256 is sequential, so one conversation is read by one task.)

Costs: Keep 0, Rerole 3, Delete 4, Insert 3; a truncated row that stays 3 more.
Blank and duplicate rows must go. A row's first fault counts.

Defined cases: a null turn comes first; rows of equal turn are ordered by role and
text; null roles and texts are one space, so a null text is blank; in the key of
the damage nulls are one space; a null conv_id is a conversation of its own; a
conversation that lost all rows has zeros, an empty audit and the digest of the
empty text; repeated rows are duplicates; an empty table gives an empty result;
other columns never enter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize
from freshet.operators.ordinal import global_row_number

BLOCK = 4096
FANOUT = 64
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STATES = range(4)
NOTHING, SYSTEM, USER, ASSISTANT = STATES
# Where a turn of the role that a state asks for leads, and that role.
ASKED = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
INITIALS = "sua?"  # the last stands for any other
# What is inserted at the end, by state.
ENDING = ("", "II", "I", "")
END_COST = tuple(INSERT * len(e) for e in ENDING)
FAULTS = ("", "blank", "duplicate", "truncated")


def kind_of(initial: int, fault: int) -> int:
    """A row as a number: place in ``INITIALS`` and in ``FAULTS``."""
    return 4 * fault + initial


@lru_cache(None)
def row_edits(kind: int) -> tuple:
    """[from][to]: None or (cost, letters) of the cheapest, then least edits."""
    fault, initial = FAULTS[kind // 4], INITIALS[kind % 4]
    stays = TRUNCATED if fault == "truncated" else 0
    found = [[None] * 4 for _ in STATES]
    for start in STATES:
        at, paid, letters = start, 0, ""
        for _ in range(3):  # more insertions only lead round
            ends = [(at, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                ends.append((ASKED[at], REROLE + stays, "R"))
                if (at, initial) in KEPT:
                    ends.append((KEPT[at, initial], stays, "K"))
            for to, cost, letter in ends:
                new = (paid + cost, letters + letter)
                found[start][to] = min(found[start][to] or new, new)
            at, paid, letters = ASKED[at], paid + INSERT, letters + "I"
    return tuple(map(tuple, found))


@lru_cache(None)
def row_passage(kind: int) -> tuple:
    """The row as a passage: [from][to] None or (cost, rank)."""
    edits = row_edits(kind)
    order = [sorted(e[1] for e in line if e) for line in edits]
    return tuple(tuple(e and (e[0], order[s].index(e[1])) for e in line) for s, line in enumerate(edits))


@lru_cache(1 << 16)
def _advance(vector: tuple, passage: tuple) -> tuple[int, tuple]:
    """A forward vector (by state None or (cost, rank), the least cost 0) behind
    ``passage``: what its least cost was, and the new vector."""
    best = []
    for to in STATES:
        ways = [(vector[s][0] + passage[s][to][0], vector[s][1], passage[s][to][1]) for s in STATES if vector[s] and passage[s][to]]
        best.append(min(ways, default=None))
    order = sorted(b[1:] for b in best if b)
    least = min(b[0] for b in best if b)
    return least, tuple(b and (b[0] - least, order.index(b[1:])) for b in best)


@lru_cache(1 << 16)
def _retreat(vector: tuple, passage: tuple) -> tuple:
    """A backward vector (cost by state or None, the least 0) before ``passage``."""
    best = [min((p[0] + v for p, v in zip(passage[s], vector) if p and v is not None), default=None) for s in STATES]
    least = min(b for b in best if b is not None)
    return tuple(None if b is None else b - least for b in best)


def _at(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in STATES)


def _forward(vector: tuple, passages: list, lo: int, hi: int) -> tuple[int, tuple]:
    paid = 0
    for i in range(lo, hi):
        cost, vector = _advance(vector, passages[i])
        paid += cost
    return paid, vector


def _crossing(ahead: tuple, behind: tuple) -> int:
    """The cheapest state where the vectors meet, ties to the least audit."""
    return min((f[0] + b, f[1], s) for s, (f, b) in enumerate(zip(ahead, behind)) if f and b is not None)[2]


def crossings(passages: list, first: int, last: int) -> list[int]:
    """States at all borders of ``passages`` from ``first`` to ``last``."""
    found = [first, *[None] * (len(passages) - 1), last]
    open_ = [(0, len(passages))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        ahead = _forward(_at(found[lo]), passages, lo, mid)[1]
        behind = tuple(0 if s == found[hi] else None for s in STATES)
        for i in range(hi - 1, mid - 1, -1):
            behind = _retreat(behind, passages[i])
        found[mid] = _crossing(ahead, behind)
        open_ += [(lo, mid), (mid, hi)]
    return found if passages else [first]


def chained(passages: list) -> tuple:
    """The passage over all ``passages``."""
    lines = []
    for s in STATES:
        paid, vector = _forward(_at(s), passages, 0, len(passages))
        lines.append(tuple(v and (paid + v[0], v[1]) for v in vector))
    return tuple(lines)


def end_state(passage: tuple) -> int:
    """Where the cheapest edits of a whole conversation leave its last row."""
    return _crossing(passage[NOTHING], END_COST)


@lru_cache(1 << 14)
def solve(kinds: bytes) -> bytes:
    """States before, between and after the rows of a whole conversation."""
    passages = list(map(row_passage, kinds))
    return bytes(crossings(passages, NOTHING, _crossing(_forward(_at(NOTHING), passages, 0, len(passages))[1], END_COST)))


# A passage in a column: cost, rank of each from and to, -1 for none.
def _packed(passage: tuple) -> list[int]:
    return [x for line in passage for e in line for x in (e or (-1, -1))]


def _unpacked(numbers: list[int]) -> tuple:
    pairs = [None if c < 0 else (c, r) for c, r in zip(numbers[::2], numbers[1::2])]
    return tuple(tuple(pairs[4 * s:4 * s + 4]) for s in STATES)


# ------------------------------------------------------------------- rows --

_WHITE = r"[\x20\x09-\x0D]"
_ENDS = ".!?"


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults; nulls are one space."""
    hit = F.crc32(F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn")))) % 20
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", _ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    marked = rows.select("conv_id", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"), hit.alias("hit"))
    kept = marked.where("hit != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "hit")
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1)))).drop("hit", "copy")


def with_kinds(numbered: DataFrame) -> DataFrame:
    """(cid, rnum, kind) of numbered rows (cid, rnum, role, text)."""
    solid = F.rlike("text", F.lit(rf"[^\x20\x09-\x0D]"))
    cut = ~F.rlike("text", F.lit(rf"[.!?]{_WHITE}*\z"))
    initial = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    # Role and text as one value: the role's length keeps them apart.
    said = F.sha2(F.encode(F.concat_ws(":", "cid", F.char_length("role").cast("string"), "role", "text"), "UTF-8"), 256)
    rows = numbered.select("cid", "rnum", said.alias("said"), initial.alias("initial"), solid.alias("solid"), cut.alias("cut"))
    first = rows.groupBy("said").agg(F.min("rnum").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    known = rows.join(first, "said", "left")
    fault = F.when(~F.col("solid"), 1).when(F.col("rnum") > F.col("first"), 2).when(F.col("cut"), 3).otherwise(0)
    return known.select("cid", "rnum", kind_of(F.col("initial"), fault).cast("int").alias("kind"))


_STRETCH = "cid string, rnum long, block long, kinds binary, states binary, passage array<int>"


def stretches(kinds: DataFrame) -> DataFrame:
    """The rows of each conversation in each block: solved (states), or, at the
    block's borders, as a passage."""
    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("rnum")
        cid, rnum, kind = part["cid"].to_pylist(), part["rnum"].to_pylist(), bytes(part["kind"].to_pylist())
        cuts = [0, *(i for i in range(1, len(cid)) if cid[i] != cid[i - 1]), len(cid)]
        out = {k: [] for k in ("cid", "rnum", "kinds", "states", "passage")}
        for a, b in zip(cuts, cuts[1:]):
            border = a == 0 or b == len(cid)
            out["cid"].append(cid[a])
            out["rnum"].append(rnum[a])
            out["kinds"].append(kind[a:b])
            out["states"].append(None if border else solve(kind[a:b]))
            out["passage"].append(_packed(chained(list(map(row_passage, kind[a:b])))) if border else None)
        block = [part["block"][0].as_py()] * len(out["cid"])
        columns = {"cid": out["cid"], "rnum": out["rnum"], "block": block, "kinds": pa.array(out["kinds"], pa.binary()),
                   "states": pa.array(out["states"], pa.binary()), "passage": pa.array(out["passage"], pa.list_(pa.int32()))}
        return pa.table(columns)

    rows = kinds.withColumn("block", F.floor(F.col("rnum") / BLOCK))
    return materialize(rows.groupBy("block").applyInArrow(run, _STRETCH), "stretches")


def _joined_up(nodes: DataFrame) -> DataFrame:
    """(cid, node, passage) one level up."""
    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        whole = chained([_unpacked(p) for p in part["passage"].to_pylist()])
        return pa.table({"cid": part["cid"][:1], "node": part["up"][:1], "passage": pa.array([_packed(whole)], pa.list_(pa.int32()))})

    up = nodes.withColumn("up", F.floor(F.col("node") / FANOUT))
    return up.groupBy("cid", "up").applyInArrow(run, "cid string, node long, passage array<int>")


def _handed_down(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """(cid, node, enter, leave) of the children, whose parents' ends are known."""
    def run(part: pa.Table, parent: pa.Table) -> pa.Table:
        part, (known,) = part.sort_by("node"), parent.to_pylist()
        found = crossings([_unpacked(p) for p in part["passage"].to_pylist()], known["enter"], known["leave"])
        return pa.table({"cid": part["cid"], "node": part["node"], "enter": pa.array(found[:-1], pa.int32()), "leave": pa.array(found[1:], pa.int32())})

    up = nodes.withColumn("up", F.floor(F.col("node") / FANOUT))
    return up.groupBy("cid", "up").cogroup(ends.groupBy("cid", "node")).applyInArrow(run, "cid string, node long, enter int, leave int")


def solved(parts: DataFrame) -> DataFrame:
    """(cid, rnum, kinds, states) of all stretches."""
    done = parts.where("passage is null").select("cid", "rnum", "kinds", "states")
    open_ = parts.where("passage is not null")
    level = open_.select("cid", F.col("block").alias("node"), "passage")
    levels, last = [level], open_.agg(F.max("block")).first()[0] or 0
    while last:
        levels.append(materialize(_joined_up(levels[-1]), "passages"))
        last //= FANOUT

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leave = [end_state(_unpacked(p)) for p in b["passage"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"cid": b["cid"], "node": b["node"], "enter": pa.array([NOTHING] * len(leave), pa.int32()), "leave": pa.array(leave, pa.int32())})

    ends = levels[-1].mapInArrow(top, "cid string, node long, enter int, leave int")
    for level in levels[-2::-1]:
        ends = _handed_down(level, ends)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            states = [bytes(crossings(list(map(row_passage, r["kinds"])), r["enter"], r["leave"])) for r in rows]
            yield pa.RecordBatch.from_pydict({"cid": b["cid"], "rnum": b["rnum"], "kinds": b["kinds"], "states": pa.array(states, pa.binary())})

    known = open_.select("cid", "block", "rnum", "kinds").join(ends.withColumnRenamed("node", "block"), ["cid", "block"])
    return done.unionByName(known.drop("block").mapInArrow(within, "cid string, rnum long, kinds binary, states binary"))


# ----------------------------------------------------------------- result --

class _Reader:
    """One conversation: marker, then stretches and rows in order."""

    def __init__(self, conv_id):
        self.conv_id, self.digest, self.lines = conv_id, hashlib.sha256(), 0
        self.audit, self.cost, self.faults, self.illegal = [], 0, [0, 0, 0, 0], 0
        self.before, self.turns, self.low, self.high, self.state = None, 0, None, None, NOTHING

    def stretch(self, kinds: bytes, states: bytes) -> None:
        self.kinds, self.states, self.i = kinds, states, 0

    def _line(self, line: str) -> None:
        self.digest.update((("\n" if self.lines else "") + line).encode())
        self.lines += 1

    def _insert(self, many: int) -> None:
        for _ in range(many):
            self._line(ROLE[self.state] + ":")
            self.state = ASKED[self.state]

    def row(self, turn, role: str, text: str) -> None:
        kind, self.state, after = self.kinds[self.i], self.states[self.i], self.states[self.i + 1]
        self.i += 1
        cost, letters = row_edits(kind)[self.state][after]
        self.cost += cost
        self.audit.append(letters)
        self._insert(len(letters) - 1)
        if letters[-1] != "D":
            self._line(f"{role if letters[-1] == 'K' else ROLE[self.state]}:{text}")
        self.state = after
        self.faults[kind // 4] += 1
        initial = INITIALS[kind % 4]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def result(self) -> tuple:
        ending = ENDING[self.state]
        self._insert(len(ending))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost + INSERT * len(ending),
                "".join(self.audit) + ending, self.digest.hexdigest())


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 7 + [pa.string()] * 2
    give = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=_NAMES)
    now = None
    for b in batches:
        out = []
        for conv_id, turn, role, text, kinds, states, is_row in zip(*(b[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "kinds", "states", "place"))):
            if is_row == 0:
                out += [now.result()] if now else []
                now = _Reader(conv_id)
            elif is_row == 1:
                now.stretch(kinds, states)
            else:
                now.row(turn, role, text)
        if out:
            yield give(out)
    if now:
        yield give([now.result()])


def repair(rows: DataFrame, all_ids: DataFrame) -> DataFrame:
    """One row for every conv_id of ``all_ids``: the faults of its ``rows``
    (conv_id, turn, role, text; no nulls in role and text), the cheapest repair,
    its cost and audit, and the digest of what it leaves."""
    cid = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("cid")
    numbered = materialize(
        global_row_number(rows.select(cid, "turn", "role", "text"), ["cid", "turn", "role", "text"]), "conversation-rows")
    edits = solved(stretches(with_kinds(numbered)))
    none = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]
    texts, steps, conv = [("turn", "long"), ("role", "string"), ("text", "string")], [("kinds", "binary"), ("states", "binary")], [("conv_id", "long")]
    ids = all_ids.select("conv_id").distinct()
    both = ids.select(cid, F.lit(0).cast("long").alias("rnum"), F.lit(0).alias("place"), "conv_id", *none(*texts, *steps)) \
        .unionByName(edits.select("cid", "rnum", F.lit(1).alias("place"), *none(*conv, *texts), "kinds", "states")) \
        .unionByName(numbered.select("cid", "rnum", F.lit(2).alias("place"), *none(*conv), F.col("turn").cast("long").alias("turn"), "role", "text", *none(*steps)))
    return both.repartition("cid").sortWithinPartitions("cid", "rnum", "place").mapInArrow(_read, _RESULT)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair(damaged(rows), rows)


QUERIES = {"op11_repair": op11_repair}
