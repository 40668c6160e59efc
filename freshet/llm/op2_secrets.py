"""Secret scans with an incremental blob ledger.

A version of a file (here: a document row) is addressed by the SHA-256 of its
text. The ledger is an append-only table of the pairs already scanned: blob,
rule with its version, and the spans found. A scan

1. hashes every version where it is read and asks the ledger, by hashes alone,
   which blobs lack which rule versions; what that finds is written,
2. fetches one text of each such blob (copies combine before the shuffle): few
   blobs, by a size that is checked, go to the texts, so texts that are known
   stay where they are; many blobs meet the combined texts in a join. A first
   scan has no ledger to ask and takes every blob,
3. scans these and appends them to the ledger,
4. joins the blobs' findings back to every path that has the blob.

A second scan reads only new texts; a rule with a new version rescans all blobs
with that rule alone. A part is appended as one write, so a scan that dies
leaves either all or nothing of it, and the next scan makes up for it.

Spans count code points, the end is exclusive. Of the base kinds (assign,
access, hex) matches are leftmost and do not overlap within a kind; matches
that are too short are dropped after they have matched. Further kinds (private
key blocks, JSON web tokens, GitHub tokens) add spans.

Defined cases: a null text is the empty text; equal texts share a blob; repeated
rows are reported each; null keys are kept; very long texts are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize
from freshet.session import work_path


@dataclass(frozen=True)
class Rule:
    """``version`` changes whenever pattern or minimum do."""

    kind: str
    version: int
    pattern: str
    least: int  # code points that ``group`` needs
    group: int = 0
    hints: tuple[str, ...] = ()  # lower-case; without any of them there is no match


RULES = (
    Rule("assign", 1, r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 20, 0, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 24),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, ("private key-----",)),
    Rule("web_token", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0, ("eyj",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 1, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
BASE = ("assign", "access", "hex")
_SPANS = "array<struct<kind:string,start:int,end:int>>"
# So many (blob, seen) rows of some 200 bytes are sent to every task; more are joined.
FEW_BLOBS = 100_000
_LEDGER = f"blob string, rules array<string>, spans {_SPANS}"


def rule_name(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def scanner(rules: tuple[Rule, ...]) -> Callable[[str, set], list[tuple[str, int, int]]]:
    """Spans of a text, by start, then in the order of ``rules``; skips the
    rules named in the second argument."""
    ready = [(rule_name(r), r, re.compile(r.pattern, re.ASCII)) for r in rules]
    place = {r.kind: i for i, r in enumerate(rules)}

    def scan(text: str, seen: set) -> list[tuple[str, int, int]]:
        lower, found = text.lower(), []
        for name, r, pattern in ready:
            if name not in seen and (not r.hints or any(h in lower for h in r.hints)):
                found += [(r.kind, m.start(), m.end()) for m in pattern.finditer(text) if len(m.group(r.group)) >= r.least]
        return sorted(found, key=lambda s: (s[1], place[s[0]]))

    return scan


def address(text) -> F.Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; the folder has one part per scan."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def unscanned(versions: DataFrame, held: DataFrame, names: list[str]) -> DataFrame:
    """(blob, seen) of the blobs that lack a rule version in the ledger's rows
    ``held``, with the rules they have; only hashes are shuffled."""
    hashes = versions.select(address(F.col("text")).alias("blob")).distinct()
    known = held.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    return (
        hashes.join(known, "blob", "left")
        .withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        .where(F.size(F.array_except(F.array(*map(F.lit, names)), "seen")) > 0)
    )


def _distinct_texts(versions: DataFrame, *also: str) -> DataFrame:
    firsts = [F.first(F.coalesce("text", F.lit(""))).alias("text"), *(F.first(c).alias(c) for c in also)]
    return versions.groupBy(address(F.col("text")).alias("blob")).agg(*firsts)


def _texts_of(versions: DataFrame, todo: DataFrame, few: bool) -> DataFrame:
    """One text of each blob of ``todo`` (blob, seen)."""
    if not few:
        return _distinct_texts(versions).join(todo, "blob")
    wanted = F.broadcast(todo.withColumnRenamed("blob", "__blob"))
    return _distinct_texts(versions.join(wanted, address(F.col("text")) == F.col("__blob")), "seen")


def scan_versions(spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger lacks of ``versions`` (text) and append it; the
    number of blobs scanned."""
    names = [rule_name(r) for r in rules]
    versions = versions.select("text")
    held = _ledger(spark, ledger)
    before = held.count()
    if before:
        todo = materialize(unscanned(versions, held, names), "unscanned")
        n = todo.count()
        if not n:
            return 0
        unseen = _texts_of(versions, todo, few=n <= FEW_BLOBS)
    else:
        unseen = _distinct_texts(versions).withColumn("seen", F.array().cast("array<string>"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = scanner(rules)
        for pdf in batches:
            seen = [set(s) for s in pdf["seen"]]
            yield pd.DataFrame({
                "blob": pdf["blob"],
                "rules": [[n for n in names if n not in s] for s in seen],
                "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t, s)] for t, s in zip(pdf["text"], seen)],
            })

    unseen.select("blob", "text", "seen").mapInPandas(run, _LEDGER).write.mode("append").parquet(ledger)
    return _ledger(spark, ledger).count() - before


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the given rule versions, for blobs with a finding.
    Spans of a pair that was appended twice count once."""
    current = F.array(*[F.lit(rule_name(r)) for r in rules])
    rank = {r.kind: i for i, r in enumerate(rules)}
    order = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    rows = _ledger(spark, ledger).where((F.size("spans") > 0) & F.arrays_overlap("rules", current))
    kinds = F.transform(F.array_intersect("rules", current), lambda r: F.element_at(F.split(r, "@"), 1))
    spans = rows.select("blob", F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])).alias("spans"))
    keyed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    merged = spans.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(keyed)))).alias("spans"))
    return merged.where(F.size("spans") > 0)


def scan_paths(spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Scan what is new and return every version's keys, blob and spans."""
    scan_versions(spark, versions.select("text"), ledger, rules)
    paths = versions.select(*keys, address(F.col("text")).alias("blob"))
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    return paths.join(findings(spark, ledger, rules), "blob", "left").withColumn("spans", F.coalesce("spans", none))


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan_paths(spark, docs, work_path(spark, "ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def masked(text, spans) -> F.Column:
    """``text`` with a placeholder for every run of overlapping ``spans``
    (sorted by start); JVM functions, counted in code points."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        gap = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("[SECRET]"))
        return F.struct(F.when(s["start"] >= acc["at"], gap).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are replaced by a placeholder, ``n_chars`` follows;
    documents without a secret stay as they are."""
    ledger = work_path(spark, "ledger")
    scan_versions(spark, docs.select("text"), ledger)
    found = findings(spark, ledger).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    held = docs.withColumn("__blob", address(F.col("text"))).join(found, "__blob", "left")
    hit = F.col("__spans").isNotNull()
    out = held.withColumn("text", F.when(hit, masked(F.col("text"), F.col("__spans"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


QUERIES = {"op2_secrets": op2_secrets}
