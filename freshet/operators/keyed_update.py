"""Keyed partial update without insert (``update({key}, {$set: ...})``).

The state table keeps exactly its rows: keys that appear only in the
updates are dropped (a left join from the state side), columns not being
set keep their value, and a column is set only where its flag is true.
Updates must hold at most one row per key (reduce them first with
``operators.latest``); the join then never multiplies state rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _later(new: Sequence[Column], old: Sequence[Column]) -> Column:
    """``new`` > ``old``, field by field; an ``old`` never set is earlier."""
    return old[0].isNull() | (F.struct(*[c.alias(f"c{i}") for i, c in enumerate(new)])
                              > F.struct(*[c.alias(f"c{i}") for i, c in enumerate(old)]))


def update_no_insert(
    state: DataFrame,
    updates: DataFrame,
    key: str,
    assignments: Mapping[str, tuple[str, str]],
    orders: Mapping[str, tuple[Sequence[str], Sequence[str]]] | None = None,
) -> DataFrame:
    """New state: ``target = value`` where ``flag`` holds, for each
    ``target -> (flag_col, value_col)`` of ``assignments`` (both columns of
    ``updates``, whose key column is ``key``). ``orders`` maps a flag to
    (columns of ``updates``, columns of ``state``): the flag then only holds
    where the former are later. Output columns, order and types are those of
    ``state``.
    """
    u = updates.select(*[F.col(c).alias(f"_upd_{c}") for c in updates.columns])
    upd = lambda c: F.col(f"_upd_{c}")
    j = state.join(u, state[key] == u["_upd_key"], "left")
    out = []
    for f in state.schema.fields:
        if f.name not in assignments:
            out.append(state[f.name])
            continue
        flag, value = assignments[f.name]
        on = F.coalesce(upd(flag), F.lit(False))
        if orders and flag in orders:
            new, old = orders[flag]
            on = on & _later([upd(c) for c in new], [state[c] for c in old])
        out.append(F.when(on, upd(value).cast(f.dataType)).otherwise(state[f.name]).alias(f.name))
    return j.select(*out)
