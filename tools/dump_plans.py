"""Write PLANS.md: the physical plan tree of every registered query.

    python tools/dump_plans.py [sf_dir] [shuffle_partitions]

For each query: the operator tree of ``explain("formatted")`` and the scan
lines (``ReadSchema``, ``PushedFilters``), so pruning, pushdown and the
placement of every exchange can be read without running anything. What a
query writes on its way (staged tables, snapshots, landed files, the writes
of a stream's batches) is listed before its last plan, equal plans once.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> str:
    tree, scans = [], []
    in_tree = True
    for line in text.splitlines():
        if in_tree:
            if line.startswith("== Physical Plan =="):
                continue
            if not line.strip():
                if tree:
                    in_tree = False
                continue
            tree.append(line)
        elif re.match(r"^(ReadSchema|PushedFilters):", line):
            scans.append(line)
    out = "\n".join(tree)
    if scans:
        out += "\n\n" + "\n".join(dict.fromkeys(scans))
    return out


_KINDS = [
    ("shuffles", r"\bExchange \("), ("broadcasts", r"BroadcastExchange"),
    ("smj", r"SortMergeJoin"), ("bhj", r"BroadcastHashJoin"), ("windows", r"\bWindow \("),
    ("hash_agg", r"\bHashAggregate"), ("sort_agg", r"SortAggregate"),
    ("object_agg", r"ObjectHashAggregate"), ("scans", r"Scan "),
]


def counts(tree: str) -> dict[str, int]:
    return {k: len(re.findall(p, tree)) for k, p in _KINDS}


@contextlib.contextmanager
def recorded(found: list[str]):
    """Collects the plan of every file write made meanwhile."""
    from pyspark.sql.readwriter import DataFrameWriter

    real = {n: getattr(DataFrameWriter, n) for n in ("parquet", "text", "json")}

    def patched(name):
        def write(self, *args, **kw):
            found.append(summarize(plan_text(self._df)))
            return real[name](self, *args, **kw)
        return write

    for n in real:
        setattr(DataFrameWriter, n, patched(n))
    try:
        yield
    finally:
        for n, f in real.items():
            setattr(DataFrameWriter, n, f)


def distinct(plans: list[str]) -> list[str]:
    """Plans that differ in more than ids and file names, in order."""
    return list({re.sub(r"#\d+L?|\d+|\[[^\]]*\]", "", p.split("\n\n")[0]): p for p in reversed(plans)}.values())[::-1]


def main(argv) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    parts = int(argv[2]) if len(argv) > 2 else 16
    from freshet.plans import catalog
    from freshet.session import build_session

    spark = build_session(shuffle_partitions=parts)
    lines = [
        "# Physical plans",
        "",
        f"Generated by `tools/dump_plans.py` on `{sf_dir}` with "
        f"`spark.sql.shuffle.partitions={parts}`; initial AQE plans (AQE may turn a "
        "sort-merge join into a broadcast join at runtime).",
        "",
    ]
    sections, table = [], []
    for name, fn in catalog.queries().items():
        written: list[str] = []
        with recorded(written):
            df = fn(spark, sf_dir)
        plans = [*distinct(written), summarize(plan_text(df))]
        c = [counts(p.split("\n\n")[0]) for p in plans]
        table.append(f"| {name} | {len(plans) - 1} | " + " | ".join(str(sum(x[k] for x in c)) for k, _ in _KINDS) + " |")
        sections += [f"## {name}", ""]
        for i, p in enumerate(plans):
            sections += [f"Written on the way, {i + 1}:" if i < len(plans) - 1 else "Result:", "", "```", p, "```", ""]
    lines += [
        "Operator counts per query over all its plans (initial plans; shuffles exclude broadcasts).",
        "",
        "| query | written | " + " | ".join(k for k, _ in _KINDS) + " |",
        "|---|---|" + "---|" * len(_KINDS),
        *table,
        "",
        *sections,
    ]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
