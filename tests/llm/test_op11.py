"""Conversation repair against a search over all edits."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from freshet.llm import op11_repair as op
from freshet.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, cid string, kind int"


def _cheapest(rows):
    """(cost, audit, lines) by trying every edit; rows: (role, text, fault)."""
    @lru_cache(None)
    def go(i, s, inserted):
        ways = []
        ask = ("user", "user", "assistant", "user")[s]
        nxt = {"user": 2, "assistant": 3}[ask]

        def add(cost, letter, rest, *line):
            if rest:
                ways.append((cost + rest[0], letter + rest[1], (*line, *rest[2])))
        if i == len(rows) and s in (0, 3):
            ways.append((0, "", ()))
        if inserted < 2:
            add(3, "I", go(i, nxt, inserted + 1), ask + ":")
        if i < len(rows):
            role, text, fault = rows[i]
            add(4, "D", go(i + 1, s, 0))
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                add(3 + more, "R", go(i + 1, nxt, 0), f"{ask}:{text}")
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, role[:1]))
                if to:
                    add(more, "K", go(i + 1, to, 0), f"{role}:{text}")
        return min(ways) if ways else None
    return go(0, 0, 0)


def _plain(rows):
    """The whole operator over rows (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        left = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            show = lambda v: " " if v is None else str(v)
            hit = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            left += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faulty = set(), []
        for _, role, text in left:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = {r[0] for r in left} - {None}
        cost, audit, lines = _cheapest(tuple(faulty))
        many = lambda f: sum(r[2] == f for r in faulty)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(faulty))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, many("blank"), many("duplicate"), many("truncated"), illegal,
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def _run(spark, tmp_path, rows):
    folder = str(tmp_path / "sf")
    spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return [tuple(r) for r in op.op11_repair(spark, folder).collect()]


def _key(r):
    return tuple(map(str, r))


def _conversation(rng, conv, n):
    roles = ["user", "assistant"] * n
    rows = []
    for i in range(n):
        role = rng.choice([roles[i]] * 6 + ["system", "user", "assistant", "tool", "", None, "usher"])
        text = rng.choice(["Aa.", "Bé! \n", "no end", "Who?", "", " \t", None, f"T{rng.randrange(99)}."])
        rows.append((conv, rng.choice([i, i, i, i, i + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("block, fanout", [(4096, 64), (4, 2), (3, 64)])
def test_like_a_search_over_all_edits(spark, tmp_path, monkeypatch, block, fanout):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "FANOUT", fanout)
    rng = random.Random(block)
    rows = [r for c in [*range(60), -7, None, 2**62] for r in _conversation(rng, c, rng.randrange(1, 12))]
    rows += _conversation(rng, 900, 70) + _conversation(rng, 901, 23)
    rows += rows[:5] + [(950, None, None, None), (951, None, "system", "S.")]
    got = _run(spark, tmp_path, rows)
    assert sorted(got, key=_key) == sorted(_plain(rows), key=_key)


def test_lost_conversation_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert _run(spark, tmp_path, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert _run(spark, tmp_path / "none", []) == []


def test_ties_take_the_least_audit():
    # A lone assistant turn: delete it (4) or put a user before it (3).
    kinds = [op.kind_of(2, 0)]
    assert op.row_edits(kinds[0])[op.NOTHING][op.ASSISTANT] == (3, "IK")
    assert list(op.solve(bytes(kinds))) == [op.NOTHING, op.ASSISTANT]
    # Three user turns: KIKR and KRKI cost 6 each; the least audit wins.
    u = op.kind_of(1, 0)
    rows = tuple(("user", f"{x}.", "") for x in "abc")
    assert _cheapest(rows)[:2] == (6, "KIKR")
    states = op.solve(bytes([u] * 3))
    assert "".join(op.row_edits(u)[a][b][1] for a, b in zip(states, states[1:])) + op.ENDING[states[-1]] == "KIKR"


def test_every_short_sequence():
    cases = [k for n in range(4) for k in itertools.product(range(16), repeat=n)]
    rng = random.Random(11)
    cases += [tuple(rng.choices(range(16), k=rng.randrange(4, 30))) for _ in range(500)]
    for kinds in cases:
        rows = tuple((("system", "user", "assistant", "tool")[k % 4], str(i), op.FAULTS[k // 4]) for i, k in enumerate(kinds))
        states = op.solve(bytes(kinds))
        steps = [op.row_edits(k)[a][b] for k, a, b in zip(kinds, states, states[1:])]
        ending = op.ENDING[states[-1]]
        cost, audit, _ = _cheapest(rows)
        assert (sum(c for c, _ in steps) + 3 * len(ending), "".join(x for _, x in steps) + ending) == (cost, audit)


def test_a_long_conversation_is_many_stretches(spark, tmp_path):
    """One conversation of many blocks: no task solves it whole."""
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"T{i}.") for i in range(3 * op.BLOCK)]
    path = str(tmp_path / "conv")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    damaged = op.damaged(table(spark, path, "conversations", "conv_id", "turn", "role", "text"))
    named = damaged.selectExpr("CAST(conv_id AS STRING) AS cid", "turn", "role", "text")
    numbered = op.global_row_number(named, ["cid", "turn", "role", "text"])
    parts = op.stretches(op.with_kinds(numbered))
    assert parts.count() >= 3 and parts.where("length(kinds) > 4096").count() == 0
    states = b"".join(r["states"][:-1] for r in op.solved(parts).orderBy("rnum").collect())
    kinds = b"".join(r["kinds"] for r in parts.orderBy("rnum").collect())
    assert states == op.solve(kinds)[:-1]
