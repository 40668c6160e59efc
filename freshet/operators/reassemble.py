"""Join the chunks of one response, in arrival order, into its body text.

Two levels, so a key holding a third of all chunks is not sorted and
merged by one task: first the chunks of each ``(key, block of seq)`` are
joined (these groups spread over all tasks), then the block parts of each
key are joined in block order. Only the final string, which is the
output value itself, is built in one task; it holds
``ceil(chunks / block)`` parts instead of every chunk.

``listagg ... WITHIN GROUP (ORDER BY ...)`` skips NULL chunks, and a body
made only of NULL chunks is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_CHUNKS = 256


def _ordered_concat(text: str, order: str) -> Column:
    return F.expr(f"listagg(`{text}`, '') WITHIN GROUP (ORDER BY `{order}`)")


def reassemble(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    text_col: str,
    out: str = "body",
    extra: Mapping[str, tuple[Column, Callable[[Column], Column]]] | None = None,
    block: int | None = BLOCK_CHUNKS,
) -> DataFrame:
    """One row per key with the chunks joined in ``order_col`` order.

    ``block=None`` takes the single-exchange form: the text crosses the
    network once, and all chunks of one key meet in one task. It suits keys
    that are small by nature, like the chunks of one response.

    ``extra`` maps an output name to ``(partial aggregate, combiner)``; the
    partial runs per block and the combiner over the blocks of a key, e.g.
    ``{"n": (F.count(F.lit(1)), F.sum)}`` or ``{"t": (F.max("t"), F.max)}``.
    """
    extra = dict(extra or {})
    if block is None:
        return df.groupBy(*keys).agg(
            _ordered_concat(text_col, order_col).alias(out),
            *[partial.alias(name) for name, (partial, _) in extra.items()],
        )
    blocks = df.groupBy(
        *keys, F.floor(F.col(order_col) / F.lit(block)).alias("_blk")
    ).agg(
        _ordered_concat(text_col, order_col).alias("_part"),
        *[partial.alias(name) for name, (partial, _) in extra.items()],
    )
    return blocks.groupBy(*keys).agg(
        _ordered_concat("_part", "_blk").alias(out),
        *[combine(F.col(name)).alias(name) for name, (_, combine) in extra.items()],
    )
