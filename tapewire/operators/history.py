"""Measures over the history of signals and prices: decayed sentiment, hit rates, lagged
correlation, slopes and change points.

A key's history may be long, so no window spans all of it: it is cut into slices, and the rows of
a slice that the next one needs are copied there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewire.functions.market import finite

# Half-lives in a slice: doubles hold 2^512, and what is older by that much adds nothing.
HALF_LIVES = 512


def daily_scores(signals: DataFrame, by: Sequence[str], score: str, ts: str) -> DataFrame:
    """(by, day, n, total): known scores of each key and day, added up before the shuffle."""
    rows = signals.where(F.col(score).isNotNull() & F.col(ts).isNotNull())
    return rows.groupBy(*by, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(score).cast("double")).alias("total")
    )


def _decay(days: Column, half_life: float) -> Column:
    return F.pow(F.lit(0.5), days / F.lit(float(half_life)))


def decayed_state(daily: DataFrame, by: Sequence[str], as_of: Column, half_life: float) -> DataFrame:
    """(by, as_of, weight, total): sums over all days up to ``as_of``, each day's halved for
    every ``half_life`` days since. Later days do not count."""
    known = daily.where(F.col("day") <= as_of)
    factor = _decay(F.datediff(as_of, "day"), half_life)
    sums = known.groupBy(*by).agg(
        F.sum(F.col("n") * factor).alias("weight"), F.sum(F.col("total") * factor).alias("total")
    )
    return sums.select(*by, as_of.alias("as_of"), "weight", "total")


def merged_states(
    states: Sequence[DataFrame], by: Sequence[str], as_of: Column, half_life: float
) -> DataFrame:
    """States of separate days, of any dates up to ``as_of``, as one state of that date.

    So a stored state and the sums of new days give what all days together would.
    """
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    factor = _decay(F.datediff(as_of, "as_of"), half_life)
    sums = every.groupBy(*by).agg(
        F.sum(F.col("weight") * factor).alias("weight"),
        F.sum(F.col("total") * factor).alias("total"),
    )
    return sums.select(*by, as_of.alias("as_of"), "weight", "total")


def decayed_series(daily: DataFrame, by: Sequence[str], half_life: float) -> DataFrame:
    """(by, day, n, weight, score): for each day of each key its own number of scores, the
    decayed number of all up to then, and their decayed mean."""
    days = int(HALF_LIVES * half_life)
    number = F.unix_date("day")
    here = F.floor(number / days)
    copies = daily.withColumn("_slice", F.explode(F.array(here, here + 1)))
    # Twice as much for every half-life after the slice's start, less before it.
    grown = 1 / _decay(F.unix_date("day") - F.col("_slice") * days, half_life)
    so_far = Window.partitionBy(*by, "_slice").orderBy("day").rowsBetween(
        Window.unboundedPreceding, 0
    )
    sums = copies.withColumns(
        {
            "_weight": F.sum(F.col("n") * grown).over(so_far),
            "_total": F.sum(F.col("total") * grown).over(so_far),
            "_grown": grown,
        }
    ).where(F.floor(F.unix_date("day") / days) == F.col("_slice"))
    return sums.select(
        *by, "day", "n",
        (F.col("_weight") / F.col("_grown")).alias("weight"),
        (F.col("_total") / F.col("_weight")).alias("score"),
    )


def rolling_rates(
    rows: DataFrame,
    key: str,
    ts: str,
    id_col: str,
    hit: str,
    frames: Sequence[int],
    block: int = 10_000,
    step: str = "hour",
) -> DataFrame:
    """All rows with (position, rate_k ...): their place in the key's history, and for each frame
    the share of hits among the known ones of the last k rows, null if none is known.

    Rows are numbered within ``step`` of time first and by counts of earlier steps; then blocks
    of ``block`` rows, each with the last rows of the block before it, make the frames. So a
    key's history lies in many tasks. Rows without a key or a time are left out.
    """
    most = max(frames)
    if block < most:
        raise ValueError("a block must hold the longest frame")
    known = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    stepped = known.withColumn("_step", F.date_trunc(step, ts))
    counts = stepped.groupBy(key, "_step").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        key, "_step", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = F.row_number().over(Window.partitionBy(key, "_step").orderBy(ts, id_col))
    placed = stepped.withColumn("_within", within).join(before, [key, "_step"])
    placed = placed.withColumn("position", F.col("_before") + F.col("_within") - 1)
    home = F.floor(F.col("position") / block)
    last = F.col("position") % block >= block - (most - 1)
    blocks = F.when(last, F.array(home, home + 1)).otherwise(F.array(home))
    dealt = placed.withColumn("_block", F.explode(blocks))
    order = Window.partitionBy(key, "_block").orderBy("position")
    rates = {
        f"rate_{k}": F.avg(F.col(hit).cast("double")).over(order.rowsBetween(1 - k, 0))
        for k in frames
    }
    own = dealt.withColumns(rates).where(home == F.col("_block"))
    return own.select(*rows.columns, "position", *rates)


def lagged_correlation(
    scores: DataFrame, values: DataFrame, key: str, day: str, score: str, value: str, lags: Sequence[int]
) -> DataFrame:
    """(key, lag, n, r, t): correlation of a score with the value ``lag`` days later.

    One row of either side for each key and day. ``r`` is null for fewer than three pairs or
    where one side does not vary, ``t`` (the test statistic of r) also where r is 1 or -1. NaN and
    infinite numbers count as missing. Each pair is met by an equi-join on the day moved by
    the lag; the co-moments add up before the shuffle.
    """
    left = scores.select(key, F.col(day).alias("_day"), finite(score).alias("_x"))
    left = left.where("_x is not null").withColumn("lag", F.explode(F.array(*map(F.lit, lags))))
    left = left.withColumn(day, F.date_add("_day", F.col("lag")))
    right = values.select(key, day, finite(value).alias("_y")).where("_y is not null")
    sums = left.join(right, [key, day]).groupBy(key, "lag").agg(
        F.count(F.lit(1)).alias("n"),
        # Not corr, which fails on a side that does not vary.
        F.try_divide(
            F.covar_pop("_x", "_y"), F.stddev_pop("_x") * F.stddev_pop("_y")
        ).alias("_r"),
        ((F.min("_x") < F.max("_x")) & (F.min("_y") < F.max("_y"))).alias("_varies"),
    )
    r = F.when((F.col("n") >= 3) & F.col("_varies"), F.greatest(F.least("_r", F.lit(1.0)), F.lit(-1.0)))
    t = F.when(F.abs("r") < 1, F.col("r") * F.sqrt((F.col("n") - 2) / (1 - F.col("r") * F.col("r"))))
    return sums.withColumn("r", r).select(key, "lag", "n", "r", t.alias("t"))


def slopes(daily: DataFrame, key: str, day: str, values: Sequence[str], spans: Sequence[int]) -> DataFrame:
    """All rows with slope_<value>_<span>: the least-squares slope a day of each value over the
    last ``span`` days, null where fewer than two days have a value.

    From sums over a range of days; days count from the row's own, so that sums stay small. Daily
    rows of a key are cut by the year, each with the end of the year before.
    """
    most = max(spans)
    year = F.year(day)
    near_end = F.year(F.date_add(day, most - 1)) > year
    dealt = daily.withColumn(
        "_year", F.explode(F.when(near_end, F.array(year, year + 1)).otherwise(F.array(year)))
    )
    dealt = dealt.withColumn("_x", F.datediff(day, F.make_date(F.col("_year"), F.lit(1), F.lit(1))))
    order = Window.partitionBy(key, "_year").orderBy("_x")
    out = {}
    for value in values:
        y = finite(value)
        x = F.when(y.isNotNull(), F.col("_x").cast("double"))
        for span in spans:
            frame = order.rangeBetween(1 - span, 0)
            total = lambda c, w=frame: F.sum(c).over(w)
            n = F.count(y).over(frame)
            spread = n * total(x * x) - total(x) * total(x)
            slope = (n * total(x * y) - total(x) * total(y)) / F.when(spread > 0, spread)
            out[f"slope_{value}_{span}"] = F.when(n >= 2, slope)
    return dealt.withColumns(out).where(year == F.col("_year")).select(*daily.columns, *out)


def change_points(
    daily: DataFrame, key: str, day: str, value: str, slack: float, threshold: float
) -> DataFrame:
    """All rows with (rise, fall, change): two-sided cumulative sums of the value's deviation from
    the key's mean, each in deviations of the key, less ``slack``; ``change`` where one of them
    passes ``threshold`` for the first time since it was not above it.

    The sum that starts anew at zero is the plain running sum less its least value so far, so it
    needs no loop. Rows without a value add nothing. Only daily rows, few for each key, are
    in one window.
    """
    y = finite(value)
    whole = daily.groupBy(key).agg(F.avg(y).alias("_mean"), F.stddev_pop(y).alias("_dev"))
    joined = daily.join(whole, key)
    z = F.when(F.col("_dev") > 0, (y - F.col("_mean")) / F.col("_dev"))
    order = Window.partitionBy(key).orderBy(day)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    steps = joined.withColumns(
        {"_up": F.coalesce(z - slack, F.lit(0.0)), "_down": F.coalesce(-z - slack, F.lit(0.0))}
    )
    sums = steps.withColumns(
        {"_ups": F.sum("_up").over(so_far), "_downs": F.sum("_down").over(so_far)}
    )
    least = lambda c: F.least(F.lit(0.0), F.min(c).over(so_far))
    found = sums.withColumns(
        {"rise": F.col("_ups") - least("_ups"), "fall": F.col("_downs") - least("_downs")}
    )
    above = (F.col("rise") > threshold) | (F.col("fall") > threshold)
    was = F.coalesce(F.lag("_above").over(order), F.lit(False))
    marked = found.withColumn("_above", above).withColumn("change", F.col("_above") & ~was)
    return marked.select(*daily.columns, "rise", "fall", "change")
