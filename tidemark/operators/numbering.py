"""A dense row number over a whole frame without moving it to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import materialise

# monotonically_increasing_id() holds the partition above these bits and the position in it below.
_POSITION_BITS = 33


def global_row_number(
    df: DataFrame,
    order_by: Sequence[str | Column],
    out_col: str,
    *,
    tie_break: Sequence[str] | None = None,
    distinct_rows: bool = False,
) -> DataFrame:
    """Number the rows 1..n in ascending order of `order_by`, NULL first.

    Ties are settled by `tie_break`, or else by all other columns. `distinct_rows` says that no two rows
    agree in all of these, which spares a sort key (see `placed_rows`). The range sort samples its keys to
    the driver (a hundred per partition), so wide rows deserve a `tie_break`.

    `row_number()` over an unpartitioned window sends every row to one task. Here the rows are sorted
    globally and written once with their place, and the number is a row's position in its sort partition
    plus the rows of all earlier ones. The write runs when this is called; the rest is lazy, and
    `workspace.intermediates` removes the files after the consumer's own write. The frame's columns are
    kept under numbers, then in a struct meanwhile, so it may have columns of any name.
    """
    placed = placed_rows(df, order_by, tie_break=tie_break, distinct_rows=distinct_rows)
    part = F.shiftright("place", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("of")).agg(F.count(F.lit(1)).alias("rows"))
    # One row per sort partition, a few thousand at most: small enough for one task and to broadcast.
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("of", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))

    position = F.col("place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), part == F.col("of"))
    return numbered.select(
        (F.col("offset") + position + 1).alias(out_col), *[F.col("row").getField(c).alias(c) for c in df.columns])


def placed_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    *,
    tie_break: Sequence[str] | None = None,
    distinct_rows: bool = False,
) -> DataFrame:
    """`row`, a struct of the frame's columns, in global order and written once with `place`: sort partition and position.

    Writing fixes the boundaries; a sampled range sort computed anew could move rows between passes.
    Since ties are ordered too, a value of `order_by` that a third of the rows share is spread over
    several partitions. Copies of one row are spread by a last sort key, the row's place in the input. It need not be
    the same when a task is run again: it only tells rows apart that are equal in every other column, and Spark runs
    whatever depends on such a column again as a whole.
    """
    # A key that is a column of the frame is moved and sorted as that column; only computed ones are moved besides.
    ties = list(tie_break) if tie_break is not None else [c for c in df.columns if c not in {k for k in order_by if isinstance(k, str)}]
    moved = [F.col(f"`{c}`").alias(f"col{i}") for i, c in enumerate(df.columns)]
    order: list[Column] = []
    for key in [*order_by, *ties]:
        if isinstance(key, str) and key in df.columns:
            order.append(F.col(f"col{df.columns.index(key)}"))
        else:
            name = f"key{len(order)}"
            moved.append((F.col(key) if isinstance(key, str) else key).alias(name))
            order.append(F.col(name))
    if not distinct_rows:
        moved.append(F.monotonically_increasing_id().alias("copy"))
        order.append(F.col("copy"))
    row = F.struct(*[F.col(f"col{i}").alias(c) for i, c in enumerate(df.columns)]).alias("row")
    ordered = df.select(*moved).orderBy(*[key.asc_nulls_first() for key in order]).select(row, F.monotonically_increasing_id().alias("place"))
    return materialise(ordered, "row-number")
