"""Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf. The leaves of a group (here: a language), in the order of
their keys, make a tree of fan-out ``FANOUT``; the groups' roots, in the order of
the groups, make the tree above them. A row's proof is what it needs besides its
own leaf to compute the root again.

1. The rows are numbered over ranges of (group, key, leaf); ``BLOCK`` consecutive
   leaves of a group are a block, the unit a task holds. No group is ever in one
   task: a group with a third of all rows is many blocks.
2. Each block hashes its lower levels and has one subtree root.
3. Round by round, blocks at the same place of up to ``FANOUT`` neighbouring
   subtrees meet and swap the subtrees' roots. Each of them keeps the others'
   roots as the next part of its proof and hashes the parent itself, so every
   block of a subtree computes the same ancestors and nothing has to come down
   again. A block meets at most ``FANOUT - 1`` others in a round; a subtree with
   fewer blocks than its neighbours (the last of its level, a small group)
   sends its root to all their places in turn. When the groups' roots are there,
   the rounds go on over the groups.
4. The rows of a block and what the block has learned make the rows' proofs.

H is the SHA-256 of the concatenated inputs, in hexadecimal; digests enter as
hexadecimal text. While a level has several nodes, each run of ``FANOUT``
consecutive ones (the last may be shorter, even one) becomes its H.

Defined cases: null fields are ``-``, which no value can be, as a value has its
length before it; a null key or group comes first; repeated rows are leaves of
their own, next to each other; a lone leaf is its group's root, a lone group's
root is the root; a null key is never tampered with; an empty table gives an empty
result; other columns never enter.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize
from freshet.operators.ordinal import global_row_number, running_total

FANOUT = 8
BLOCK_LEVELS = 4
BLOCK = FANOUT**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<place:int,others:array<string>>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.encode(F.concat(*map(_field, fields)), "UTF-8"), 256)


def _digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(leaves: list[str], whole: bool) -> list[list[str]]:
    """The levels of a block; one that is the ``whole`` group ends at its root,
    any other after ``BLOCK_LEVELS``."""
    found = [leaves]
    while len(found[-1]) > 1 if whole else len(found) <= BLOCK_LEVELS:
        last = found[-1]
        found.append([_digest(last[i:i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return found


def _dealt(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered leaves by block, and the groups: (group_no, n, blocks,
    before: blocks of the groups before it)."""
    numbered = materialize(global_row_number(leaves, ["group", "key", "leaf"], out="rnum"), "manifest-leaves")
    sizes = numbered.groupBy("group").agg(F.count("*").alias("n"), F.min("rnum").alias("first"))
    sizes = materialize(sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK)), "manifest-groups")
    groups = global_row_number(sizes, ["group"], out="group_no").withColumn("group_no", F.col("group_no") - 1)
    groups = materialize(running_total(groups, ["group"], F.col("blocks"), "before", inclusive=False), "manifest-groups")
    at = F.col("rnum") - F.col("first")
    rows = numbered.join(groups.withColumnRenamed("group", "its"), F.col("group").eqNullSafe(F.col("its")))
    return rows.select("group_no", F.floor(at / BLOCK).alias("block"), at.alias("at"), "blocks", "key", "leaf", "shown"), groups


def _block_roots(rows: DataFrame) -> DataFrame:
    def root(part: pa.Table) -> pa.Table:
        part = part.sort_by("at")
        top = _levels(part["leaf"].to_pylist(), part["blocks"][0].as_py() == 1)[-1]
        return pa.table({"group_no": part["group_no"][:1], "block": part["block"][:1], "h": top})

    blocks = rows.select("group_no", "block", "at", "blocks", "leaf").groupBy("group_no", "block")
    return blocks.applyInArrow(root, "group_no long, block long, h string")


def _swap(state: DataFrame, scope: Column, node: Column, first: Column, width: Column, most: Column, alone: Column) -> DataFrame:
    """One round. A block is ``slot - first`` in its subtree ``node`` of ``width``
    blocks; the widest of the subtrees that meet has ``most``. In a scope with
    one subtree left (``alone``) nothing is hashed."""
    place = F.col("slot") - first
    sent = state.select(
        scope.alias("scope"), node.alias("node"), alone.alias("alone"), "h", place.alias("own"),
        F.struct("group_no", "block", "slot", "blocks", "before", "subroot", "path").alias("member"),
        F.explode(F.sequence(place, most - 1, width)).alias("to"))
    met = sent.groupBy("scope", F.floor(F.col("node") / FANOUT).alias("run"), "to").agg(
        F.first("alone").alias("alone"),
        F.sort_array(F.collect_list(F.struct("node", "h", F.when(F.col("to") == F.col("own"), F.col("member")).alias("member")))).alias("met"))
    hashes = F.transform("met", lambda m: m["h"])
    joined = F.when(F.col("alone"), F.element_at(hashes, 1)).otherwise(F.sha2(F.array_join(hashes, ""), 256))
    each = met.select("alone", hashes.alias("hashes"), joined.alias("parent"), F.posexplode("met").alias("place", "m")).where("m.member is not null")
    others = F.concat(F.slice("hashes", F.lit(1), F.col("place")), F.slice("hashes", F.col("place") + 2, F.size("hashes")))
    step = F.array(F.struct(F.col("place").cast("int").alias("place"), others.alias("others")))
    return each.select(
        "m.member.group_no", "m.member.block", "m.member.slot", "m.member.blocks", "m.member.before", "m.member.subroot", F.col("parent").alias("h"),
        F.when(F.col("alone"), F.col("m.member.path")).otherwise(F.concat("m.member.path", step)).alias("path"))


def _exchange(roots: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_no, block, subroot, root, path) of every block."""
    state = roots.join(groups.select("group_no", "blocks", "before"), "group_no").select(
        "group_no", "block", (F.col("before") + F.col("block")).alias("slot"), "blocks", "before",
        F.lit(None).cast("string").alias("subroot"), "h", F.array().cast(_PATH).alias("path"))
    # Bounded: two numbers for the whole table.
    largest, many = groups.agg(F.max("blocks"), F.count("*")).first()
    span = 1
    while span < (largest or 0):
        node = F.floor(F.col("block") / span)
        left = lambda at: F.least(F.lit(span), F.col("blocks") - at)  # noqa: E731, B023
        state = _swap(state, F.col("group_no"), node, F.col("before") + node * span, left(node * span),
                      left(F.floor(node / FANOUT) * (FANOUT * span)), F.col("blocks") <= span)
        span *= FANOUT
    state = state.withColumn("subroot", F.col("h"))
    span = 1
    while span < many:
        nodes = groups.groupBy(F.floor(F.col("group_no") / span).alias("node")).agg(F.min("before").alias("first"), F.sum("blocks").alias("width"))
        widest = nodes.groupBy(F.floor(F.col("node") / FANOUT).alias("run")).agg(F.max("width").alias("most"))
        shape = nodes.join(widest, F.floor(F.col("node") / FANOUT) == F.col("run")).drop("run")
        state = _swap(state.join(shape, F.floor(F.col("group_no") / span) == F.col("node")),
                      F.lit(0), F.col("node"), F.col("first"), F.col("width"), F.col("most"), F.lit(False))
        span *= FANOUT
    return materialize(state.select("group_no", "block", "subroot", F.col("h").alias("root"), "path"), "manifest-blocks")


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that ``leaf`` has with the siblings of ``path`` (its place and the
    others of its run, level by level)."""
    for place, others in path:
        leaf = _digest([*others[:place], leaf, *others[place:]])
    return leaf


_PROOFS = "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(rows: pa.Table, learned: pa.Table) -> pa.Table:
    rows = rows.sort_by("at")
    leaves, (known,) = rows["leaf"].to_pylist(), learned.to_pylist()
    levels = _levels(leaves, rows["blocks"][0].as_py() == 1)[:-1]
    above = [(p["place"], p["others"]) for p in known["path"]]
    rest = "".join(x for _, others in above for x in others)
    proof, folded = [], []
    for i, shown in enumerate(rows["shown"].to_pylist()):
        path, at = [], i
        for level in levels:
            start = at - at % FANOUT
            path.append((at - start, level[start:at] + level[at + 1:start + FANOUT]))
            at //= FANOUT
        proof.append(_digest(["".join(others) for _, others in path] + [rest]))
        folded.append(fold(shown, path + above))
    return pa.table({
        "key": rows["key"], "leaf": leaves, "subroot": [known["subroot"]] * len(leaves), "root": [known["root"]] * len(leaves),
        "proof_sha256": proof, "folded_root": folded, "verified": [x == known["root"] for x in folded],
    })


def proofs(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, key, leaf, shown): ``shown`` is the leaf a reader finds
    and checks against the manifest of ``leaf``. One row per leaf."""
    rows, groups = _dealt(leaves)
    rows = materialize(rows, "manifest-dealt")
    learned = _exchange(_block_roots(rows), groups)
    by = ("group_no", "block")
    return rows.groupBy(*by).cogroup(learned.groupBy(*by)).applyInArrow(_prove, _PROOFS)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *FIELDS)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    leaves = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").alias("key"), leaf_of(*map(F.col, FIELDS)).alias("leaf"),
        leaf_of(*map(F.col, FIELDS[:-1]), found).alias("shown"))
    return proofs(leaves).withColumnRenamed("key", "doc_id")


# Levels of both trees by recursion; the constant is CRC-32's reversed polynomial.
_SQL = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS tab
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
docs AS (
  SELECT d.*, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
                    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS tampered
  FROM documents d, crc),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN tampered THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM docs)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_no FROM leaves),
low(lang_no, lvl, i, h) AS (
  SELECT lang_no, 0, pos, leaf FROM numbered
  UNION ALL
  SELECT lang_no, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang_no) AS n FROM low) WHERE n > 1 GROUP BY lang_no, lvl, i // 8),
subroots AS (SELECT lang_no, arg_max(h, lvl) AS subroot, max(lvl) AS height FROM low GROUP BY lang_no),
high(lvl, i, h) AS (
  SELECT 0, lang_no, subroot FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY lvl, i // 8),
top AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS height FROM high),
around AS (
  SELECT a.lang_no, a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM low a JOIN low b ON a.lang_no = b.lang_no AND a.lvl = b.lvl AND a.i // 8 = b.i // 8 GROUP BY ALL),
above AS (
  SELECT a.lvl, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM high a JOIN high b ON a.lvl = b.lvl AND a.i // 8 = b.i // 8 GROUP BY ALL),
up(lang_no, pos, lvl, h, proof) AS (
  SELECT lang_no, pos, 0, shown, '' FROM numbered
  UNION ALL
  SELECT u.lang_no, pos, u.lvl + 1, sha256(coalesce(a.l, b.l) || h || coalesce(a.r, b.r)), proof || coalesce(a.l, b.l) || coalesce(a.r, b.r)
  FROM up u JOIN subroots s ON s.lang_no = u.lang_no CROSS JOIN top t
  LEFT JOIN around a ON u.lvl < s.height AND a.lang_no = u.lang_no AND a.lvl = u.lvl AND a.i = pos >> (3 * u.lvl)
  LEFT JOIN above b ON u.lvl >= s.height AND b.lvl = u.lvl - s.height AND b.i = u.lang_no >> (3 * greatest(u.lvl - s.height, 0))
  WHERE u.lvl < s.height + t.height)
SELECT n.doc_id, n.leaf, s.subroot, t.root, sha256(proof) AS proof_sha256, h AS folded_root, h = t.root AS verified
FROM numbered n JOIN up u ON u.lang_no = n.lang_no AND u.pos = n.pos JOIN subroots s ON s.lang_no = n.lang_no CROSS JOIN top t
WHERE u.lvl = s.height + t.height"""

QUERIES = {"op13_manifest": op13_manifest}
ORACLE = {"op13_manifest": _SQL}
