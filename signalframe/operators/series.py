"""Row-order work on a time series: lags, rolling means, fills.

Every function takes one row per (keys, time).  The time axis is processed in
bounded blocks, see ``signalframe.plans.ordered``.  These functions read their
input more than once, so hand them a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions import clock
from signalframe.operators.articles import numeric_columns
from signalframe.plans.ordered import nearest_values, number_rows, trailing_windows
from signalframe.plans.running import number_by_range

ROW = "_row"


def rolling_mean(value: Column, window, rows: int, full: bool) -> Column:
    """Mean of the last ``rows`` rows; with ``full`` NULL until that many values exist."""
    frame = window.rowsBetween(1 - rows, 0)
    mean = F.avg(value).over(frame)
    return F.when(F.count(value).over(frame) == rows, mean) if full else mean


def change_columns(window, count: str) -> dict[str, Column]:
    previous = F.lag(count, 1, 0).over(window)
    return {"prev_article_count": previous, "article_count_change": F.col(count) - previous}


def spike_column(window, count: str, rows: int, factor: float) -> dict[str, Column]:
    limit = rolling_mean(F.col(count), window, rows, full=True) * factor
    return {"article_volume_spike": F.coalesce(F.col(count) > limit, F.lit(False)).cast("int")}


def volume_change(df: DataFrame, time: str = "time_bucket", count: str = "article_count",
                  keys: Sequence[str] = ()) -> DataFrame:
    """Count of the previous row (0 for the first) and the difference to it."""
    numbered = number_rows(df, time, keys, ROW)
    return trailing_windows(numbered, ROW, 1, lambda w: change_columns(w, count), keys).drop(ROW)


def volume_spike(df: DataFrame, time: str = "time_bucket", count: str = "article_count",
                 rows: int = config.SPIKE_ROWS, factor: float = config.SPIKE_FACTOR,
                 keys: Sequence[str] = ()) -> DataFrame:
    """1 where the count exceeds ``factor`` times the mean of the last ``rows`` rows."""
    numbered = number_rows(df, time, keys, ROW)
    return trailing_windows(numbered, ROW, rows - 1, lambda w: spike_column(w, count, rows, factor), keys).drop(ROW)


def volume_features(df: DataFrame, time: str = "time_bucket", count: str = "article_count",
                    keys: Sequence[str] = ()) -> DataFrame:
    """``volume_change`` and ``volume_spike`` with one numbering and one shuffle."""
    rows, factor = config.SPIKE_ROWS, config.SPIKE_FACTOR
    numbered = number_rows(df, time, keys, ROW)
    return trailing_windows(
        numbered, ROW, rows - 1,
        lambda w: change_columns(w, count) | spike_column(w, count, rows, factor), keys,
    ).drop(ROW)


def moving_average(df: DataFrame, time: str = "timestamp", value: str = "Power demand_sum",
                   rows: int = 3, name: str = "moving_avg_3", keys: Sequence[str] = ()) -> DataFrame:
    """Mean of up to ``rows`` rows including the current one."""
    numbered = number_rows(df, time, keys, ROW)
    return trailing_windows(
        numbered, ROW, rows - 1,
        lambda w: {name: rolling_mean(F.col(f"`{value}`"), w, rows, full=False)}, keys,
    ).drop(ROW)


def time_spine(df: DataFrame, time: str, start=None, end=None, width: str = "15 minutes") -> DataFrame:
    """Every interval start from the first to the last time, or between given bounds.

    Steps are generated in runs of a thousand that are spread over the cluster.
    """
    bounds = df.agg(
        (F.lit(start).cast("timestamp_ntz") if start is not None else F.min(time)).alias("_from"),
        (F.lit(end).cast("timestamp_ntz") if end is not None else F.max(time)).alias("_to"),
    )
    seconds = F.lit(clock.width_seconds(width)).cast("bigint")
    steps = F.floor((clock.epoch_seconds("_to") - clock.epoch_seconds("_from")) / seconds)
    runs = bounds.where(F.col("_from") <= F.col("_to")).select(
        "_from", steps.alias("_steps"), F.explode(F.sequence(F.lit(0).cast("bigint"), steps, F.lit(1000).cast("bigint"))).alias("_run"))
    each = runs.repartition("_run").select(
        "_from", F.explode(F.sequence("_run", F.least(F.col("_run") + 999, F.col("_steps")))).alias("_i"))
    return each.select(F.timestamp_add("SECOND", F.col("_i") * seconds, F.col("_from")).alias(time))


def densify_spine(df: DataFrame, time: str = "time_bucket", start=None, end=None,
                  width: str = "15 minutes") -> DataFrame:
    """One row per interval, NULLs where the data has none; rows off the spine are dropped."""
    return time_spine(df, time, start, end, width).join(df, time, "left").select(*df.columns)


def gap_fill(df: DataFrame, time: str = "time_bucket", keys: Sequence[str] = (),
             recompute_calendar: bool = False) -> DataFrame:
    """Fill a dense series: sums and article_count with 0, the rest forward, then backward, then 0.

    What is left after the forward fill lies before the first value of a
    column, so the backward fill is that first value.  ``recompute_calendar``
    takes the calendar columns from the row's own time.
    """
    numbers = numeric_columns(df, keys)
    zeroed = [c for c in numbers if c.endswith("_sum") or c == "article_count"]
    calendar = clock.calendar_columns(time) if recompute_calendar else {}
    calendar = {c: e for c, e in calendar.items() if c in df.columns}
    carried = [c for c in numbers if c not in zeroed and c not in calendar]
    out = df.fillna(0, subset=zeroed) if zeroed else df
    if carried:
        near = {f"_n{i}": F.col(f"`{c}`") for i, c in enumerate(carried)}
        values = {c: f"coalesce(_n{i}, 0) AS `{c}`" for i, c in enumerate(carried)}
        filled = nearest_values(out, time, near, keys=keys, head=True)
        out = filled.selectExpr(*[values.get(c, f"`{c}`") for c in df.columns])
    return out.withColumns(calendar) if calendar else out


def ffill_limited(df: DataFrame, time: str, columns: Sequence[str] | None = None,
                  limit: int = config.FILL_LIMIT, keys: Sequence[str] = ()) -> DataFrame:
    """Carry the last value forward over at most ``limit`` missing rows."""
    columns = list(columns or numeric_columns(df, keys))
    numbered = number_rows(df, time, keys, ROW)
    return trailing_windows(
        numbered, ROW, limit,
        lambda w: {c: F.last(f"`{c}`", True).over(w.rowsBetween(-limit, 0)) for c in columns}, keys,
    ).select(*df.columns)


def interpolate_linear(df: DataFrame, time: str, columns: Sequence[str] | None = None,
                       above: float = config.INTERPOLATE_ABOVE) -> DataFrame:
    """Straight line by row position for columns with more than ``above`` missing.

    Missing rows before the first or after the last value take that value.
    Which columns qualify is decided by an aggregate inside the same query.
    """
    columns = list(columns or numeric_columns(df))
    numbered = number_rows(df, time, name=ROW)
    points = {}
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        points |= {f"at{i}": F.when(value.isNotNull(), F.col(ROW)), f"v{i}": value}
    both = nearest_values(numbered, time, {f"_a_{n}": e for n, e in points.items()}, {f"_b_{n}": e for n, e in points.items()})
    share = df.agg(F.struct(*[
        F.try_divide(F.count_if(F.col(f"`{c}`").isNull()), F.count("*")).alias(f"s{i}")
        for i, c in enumerate(columns)]).alias("s"))

    def value(i: int, c: str) -> Column:
        a_at, a_v, b_at, b_v = (F.col(f"_{side}_{part}{i}") for side in "ab" for part in ("at", "v"))
        line = a_v + (b_v - a_v) * (F.col(ROW) - a_at) / (b_at - a_at)
        here, guess = F.col(f"`{c}`"), F.when(a_at.isNull(), b_v).when(b_at.isNull(), a_v).otherwise(line)
        return F.when(here.isNotNull(), here).when(F.col(f"_share.s{i}") > above, guess).alias(c)

    filled = {c: value(i, c) for i, c in enumerate(columns)}
    return both.withColumn("_share", share.scalar()).select(*[filled.get(c, F.col(f"`{c}`")) for c in df.columns])


def mean_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers become the column mean."""
    columns = list(columns or numeric_columns(df))
    means = df.agg(F.struct(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(columns)]).alias("m"))
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"_means.m{i}")).alias(c)
              for i, c in enumerate(columns)}
    return df.withColumn("_means", means.scalar()).select(*[filled.get(c, F.col(f"`{c}`")) for c in df.columns])


def tail_validation(df: DataFrame, time: str, fraction: float = config.VALIDATION_FRACTION,
                    name: str = "part") -> DataFrame:
    """Mark the last int(fraction * n) rows in time order as validation, the rest as fit.

    Works at any grain: rows are numbered over range partitions, so a day, or
    a time, with many rows is spread over tasks.  Rows without a time are
    dropped; rows of one time are cut in the order of the input, so hand in a
    stored table.  Runs a job.
    """
    timed = df.where(F.col(time).isNotNull())
    total = timed.agg(F.count("*").alias("n"))
    numbered = number_by_range(timed, [time], name=ROW).withColumn("_n", total.scalar())
    held = F.floor(F.col("_n") * F.lit(fraction))
    mark = F.when(F.col(ROW) >= F.col("_n") - held, "validation").otherwise("fit")
    return numbered.withColumn(name, mark).drop(ROW, "_n")


def thin_rows(df: DataFrame, time: str = "time_bucket", step: int = config.THIN_STEP) -> DataFrame:
    """Every ``step``-th row in time order, at any grain, as in ``tail_validation``.  Runs a job."""
    numbered = number_by_range(df.where(F.col(time).isNotNull()), [time], name=ROW)
    return numbered.where(F.col(ROW) % step == 0).drop(ROW)


def time_sort(df: DataFrame, *columns: str) -> DataFrame:
    """Whole table in time order: a range-partitioned sort, for output only."""
    return df.orderBy(*columns)
