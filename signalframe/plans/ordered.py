"""Row-order work without a one-task window.

A window without partition keys pulls the table into one task.  The helpers
here cut the time axis into blocks, run the window inside each block, and pass
what must cross a block border through a table with one row per block:

* ``number_rows``      block = calendar day, carries row counts
* ``nearest_values``   block = calendar day, carries the last / next value
* ``trailing_windows`` block = fixed number of rows, carries the last n rows
                       of a block as copies into the next one

Input contract: at most one row per key and time, so a day holds at most
(day / grain) rows however much raw data lies behind the series.  The
one-row-per-block tables grow with the calendar, not with the data.  Rows
without a time are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DAY = "_day"
BLOCK_ROWS = 4096


def number_rows(df: DataFrame, time: str, keys: Sequence[str] = (), name: str = "row_no") -> DataFrame:
    """Add the 0-based position of each row in time order, per key."""
    marked = df.withColumn(DAY, F.to_date(time))
    earlier = Window.partitionBy(*keys).orderBy(DAY).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        marked.groupBy(*keys, DAY).agg(F.count("*").alias("_rows"))
        .select(*keys, DAY, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(*keys, DAY).orderBy(time)
    return (
        marked.join(before, [*keys, DAY])
        .withColumn(name, F.col("_before") + F.row_number().over(within) - 1)
        .select(*df.columns, name)
    )


def trailing_windows(
    df: DataFrame,
    position: str,
    rows: int,
    build: Callable[[WindowSpec], Mapping[str, Column]],
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add columns whose frames look back at most ``rows`` rows.

    The last ``rows`` rows of every block are copied into the next block, so
    each window partition has at most ``block_rows + rows`` rows.
    """
    if rows > block_rows:
        raise ValueError("block_rows must be at least rows")
    home = F.floor(F.col(position) / block_rows)
    near_end = F.col(position) % block_rows >= block_rows - rows
    spread = df.withColumn(
        "_block", F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    window = Window.partitionBy(*keys, "_block").orderBy(position)
    return spread.withColumns(dict(build(window))).where(F.col("_block") == home).drop("_block")


def nearest_values(
    df: DataFrame,
    time: str,
    previous: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    keys: Sequence[str] = (),
    head: bool = False,
) -> DataFrame:
    """Add the nearest non-null value at or before (after) each row in time order.

    ``previous`` and ``following`` map new column names to the looked-up
    expressions.  With ``head`` rows before the first value of a ``previous``
    column take that first value.  All columns share one table with a row per
    day and one join.
    """
    previous, following = dict(previous or {}), dict(following or {})
    back, ahead = ([f"_{side}{i}" for i in range(len(m))] for side, m in (("p", previous), ("f", following)))
    marked = df.withColumns({
        DAY: F.to_date(time), **dict(zip(back, previous.values())), **dict(zip(ahead, following.values()))})

    def edge(pick: str, v: str, name: str) -> Column:
        return F.expr(f"{pick}({v}, CASE WHEN {v} IS NOT NULL THEN `{time}` END) AS {name}")

    per_day = marked.groupBy(*keys, DAY).agg(
        *[edge("max_by", v, f"_last{v}") for v in back],
        *[edge("min_by", v, f"_first{v}") for v in ([*back, *ahead] if head else ahead)],
    )
    series = f"PARTITION BY {', '.join(keys)} " if keys else ""

    def days(direction: str, frame: str) -> str:
        return f"OVER ({series}ORDER BY {DAY} {direction} ROWS BETWEEN UNBOUNDED PRECEDING AND {frame})"

    far = per_day.selectExpr(
        *keys, DAY,
        *[f"last(_last{v}) IGNORE NULLS {days('ASC', '1 PRECEDING')} AS _far{v}" for v in back],
        *[f"last(_first{v}) IGNORE NULLS {days('DESC', '1 PRECEDING')} AS _far{v}" for v in ahead],
        *[f"first(_first{v}) IGNORE NULLS {days('ASC', 'UNBOUNDED FOLLOWING')} AS _head{v}" for v in back if head],
    )

    def rows(direction: str) -> str:
        return (f"OVER (PARTITION BY {', '.join([*keys, DAY])} ORDER BY `{time}` {direction} "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")

    return marked.join(far, [*keys, DAY]).selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"coalesce(last({v}) IGNORE NULLS {rows('ASC')}, _far{v}{f', _head{v}' if head else ''}) AS `{name}`"
          for v, name in zip(back, previous)],
        *[f"coalesce(last({v}) IGNORE NULLS {rows('DESC')}, _far{v}) AS `{name}`" for v, name in zip(ahead, following)],
    )
