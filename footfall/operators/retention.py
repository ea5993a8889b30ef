"""N-day retention from per-user activity bit masks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.expressions import event_day, percent
from footfall.operators.clean import Day, as_date

RET_DAYS = (1, 3, 7, 30)
_BLOCK = 32  # days held by one mask; two masks side by side cover base day + 32
_EPOCH = "1970-01-01"


def _activity(dwd: DataFrame, max_day: int) -> DataFrame:
    """``(user_id, block, m0 … mk)``: the user's active days in a block and in the k blocks after it.

    Each event is added to its own block and to those before it, and OR-ed map-side:
    the one shuffle carries a few integers per user and 32 days, whatever the number
    of events, and no self-join on days is needed.
    """
    ahead = -(-max_day // _BLOCK)
    day = F.datediff(event_day(), F.lit(_EPOCH).cast("date"))
    own = F.floor(day / _BLOCK).cast("int")
    rows = dwd.select("user_id", own.alias("own"), F.pmod(day, F.lit(_BLOCK)).alias("bit")).filter(
        "user_id is not null and own is not null"
    )
    spread = rows.withColumn("ahead", F.explode(F.array(*[F.lit(i) for i in range(ahead + 1)])))
    bit = F.expr("shiftleft(1L, bit)")
    masks = [
        F.coalesce(F.bit_or(F.when(F.col("ahead") == i, bit)), F.lit(0).cast("bigint")).alias(f"m{i}")
        for i in range(ahead + 1)
    ]
    return (
        spread.groupBy("user_id", (F.col("own") - F.col("ahead")).alias("block"))
        .agg(*masks)
        .filter("m0 != 0")
    )


def _is_set(offset: Column, masks: int) -> Column:
    """Is the day ``offset`` days after the block's start an active one?"""
    mask = F.coalesce(
        *[F.when(F.floor(offset / _BLOCK) == i, F.col(f"m{i}")) for i in range(masks)], F.lit(0).cast("bigint")
    )
    return _bit_of(mask, F.pmod(offset, F.lit(_BLOCK)).cast("int"))


def _bit_of(mask: Column, position: Column) -> Column:
    return F.getbit(mask, position) == 1


def _cohort_counts(activity: DataFrame, ret_days: Sequence[int], cohort: str) -> DataFrame:
    """One row per base day: its users ``n`` and, per day N, the returning ones ``r{N}``."""
    masks = len([c for c in activity.columns if c.startswith("m")])
    if cohort == "first_seen":
        names = [f"m{i}" for i in range(masks)]
        activity = (
            activity.groupBy("user_id")
            .agg(F.min(F.struct("block", *names)).alias("f"))
            .select("f.*")
        )
        # The lowest set bit is the first active day of the first block.
        low = F.col("m0").bitwiseAND(-F.col("m0"))
        bases = activity.withColumn("offset", F.log2(low.cast("double")).cast("int"))
    elif cohort == "active":
        days = F.filter(
            F.array(*[F.lit(i) for i in range(_BLOCK)]),
            lambda i: _bit_of(F.col("m0"), i),
        )
        bases = activity.withColumn("offset", F.explode(days))
    else:
        raise ValueError(f"cohort must be 'active' or 'first_seen', not {cohort!r}")
    base_day = F.date_add(F.lit(_EPOCH).cast("date"), F.col("block") * _BLOCK + F.col("offset"))
    return bases.groupBy(base_day.alias("first_date")).agg(
        F.count("*").alias("n"),
        *[F.count_if(_is_set(F.col("offset") + n, masks)).alias(f"r{n}") for n in ret_days],
    )


def retention(
    dwd: DataFrame,
    base_dates: Iterable[Day] | None = None,
    ret_days: Sequence[int] = RET_DAYS,
    cohort: str = "active",
) -> DataFrame:
    """Users of each base day who are active on exactly base day + N.

    ``cohort="active"`` takes all users of the day, ``"first_seen"`` only those
    whose first day in ``dwd`` it is. With ``base_dates`` every asked day gives its
    rows, with 0.0 when it had no users; the active cohort then reads only the days
    it needs.
    """
    bases = None if base_dates is None else sorted({as_date(d) for d in base_dates})
    if bases is not None and cohort == "active":
        wanted = sorted({b + dt.timedelta(days=n) for b in bases for n in (0, *ret_days)})
        dwd = dwd.filter(event_day().isin(*wanted))
        if "dt" in dwd.columns:
            dwd = dwd.filter(F.col("dt").isin(*[str(d) for d in wanted]))
    counts = _cohort_counts(_activity(dwd, max(ret_days)), ret_days, cohort)
    if bases is not None:
        asked = dwd.sparkSession.createDataFrame([(b,) for b in bases], "first_date date")
        counts = asked.join(counts, "first_date", "left").na.fill(0)
    pairs = ", ".join(f"{n}, r{n}" for n in ret_days)
    rows = counts.select(
        "first_date", "n", F.expr(f"stack({len(ret_days)}, {pairs}) as (ret_day, retained_count)")
    )
    return rows.select(
        "first_date",
        "ret_day",
        F.col("n").alias("new_user_count"),
        "retained_count",
        percent(F.col("retained_count"), F.col("n")).alias("retention_rate"),
    )


def retention_matrix(dwd: DataFrame, first: Day, last: Day, max_n: int, cohort: str = "active") -> DataFrame:
    """Base days ``first`` to ``last`` by days 1 … ``max_n``: one rate column ``day_N`` per N.

    The masks already give one column per N, so no pivot is run.
    """
    ret_days = range(1, max_n + 1)
    first, last = as_date(first), as_date(last)
    if cohort == "active":
        dwd = dwd.filter(event_day().between(first, last + dt.timedelta(days=max_n)))
    counts = _cohort_counts(_activity(dwd, max_n), ret_days, cohort)
    return counts.filter(F.col("first_date").between(first, last)).select(
        "first_date",
        F.col("n").alias("new_user_count"),
        *[percent(F.col(f"r{n}"), F.col("n")).alias(f"day_{n}") for n in ret_days],
    )

