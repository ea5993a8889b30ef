"""Conversion funnels. Four different definitions, kept apart on purpose."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.expressions import (
    app_name,
    count_where,
    event_day,
    interval_micros,
    is_type,
    percent,
)
from footfall.operators.clean import Day, as_date

FUNNEL_NAME = "app_download_funnel"

# Step name and event type, in order.
AD_STEPS = (
    ("impression", "ad_impression"),
    ("click", "ad_click"),
    ("download", "app_download"),
    ("install", "app_install"),
)
CONTENT_STEPS = (
    ("impression", "page_view"),
    ("click", "app_click"),
    ("download", "app_download"),
    ("install", "app_install"),
)

Steps = Sequence[tuple[str, str]]


def _step_bits(steps: Steps) -> Column:
    bits = [F.when(is_type(kind), 1 << i).otherwise(0) for i, (_, kind) in enumerate(steps)]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), bits)


def _all_of(count: int) -> int:
    return (1 << count) - 1


def _user_masks(dwd: DataFrame, steps: Steps) -> DataFrame:
    """One small integer per user and day: which steps the user did. OR-ed before the shuffle."""
    return dwd.groupBy(event_day().alias("stat_date"), "user_id").agg(F.bit_or(_step_bits(steps)).alias("mask"))


def _for_days(dwd: DataFrame, days: Iterable[Day] | None) -> tuple[DataFrame, DataFrame | None]:
    if days is None:
        return dwd, None
    wanted = sorted({as_date(d) for d in days})
    grid = dwd.sparkSession.createDataFrame([(d,) for d in wanted], "stat_date date")
    rows = dwd.filter(event_day().isin(*wanted))
    if "dt" in dwd.columns:
        rows = rows.filter(F.col("dt").isin(*[str(d) for d in wanted]))
    return rows, grid


def _step_rows(counts: DataFrame, steps: Steps, grid: DataFrame | None) -> DataFrame:
    """Counts ``c1 … cn`` of a day to one row per step, with the rate to the step before and to the first."""
    if grid is not None:
        counts = grid.join(counts, "stat_date", "left").na.fill(0)
    rows = []
    for i, (name, _) in enumerate(steps, start=1):
        this, first = F.col(f"c{i}"), F.col("c1")
        before = F.col(f"c{max(i - 1, 1)}")
        rows.append(
            F.struct(
                F.lit(i).alias("step_order"),
                F.lit(name).alias("step_name"),
                this.alias("user_count"),
                percent(this, before).alias("step_rate"),
                percent(this, first).alias("overall_rate"),
            )
        )
    return counts.select("stat_date", F.lit(FUNNEL_NAME).alias("funnel_name"), F.inline(F.array(*rows)))


def funnel_steps(dwd: DataFrame, days: Iterable[Day] | None = None, steps: Steps = AD_STEPS) -> DataFrame:
    """Independent steps: users doing each step, whatever else they did; rates may exceed 100.

    Every asked day (or every day with any event) gives one row per step.
    """
    rows, grid = _for_days(dwd, days)
    if grid is not None:
        rows = rows.filter(F.col("event_type").isin(*[kind for _, kind in steps]))
    counts = _user_masks(rows, steps).groupBy("stat_date").agg(
        *[count_where(F.col("mask").bitwiseAND(1 << i) != 0).alias(f"c{i + 1}") for i in range(len(steps))]
    )
    return _step_rows(counts, steps, grid)


def funnel_contained(
    dwd: DataFrame, days: Iterable[Day] | None = None, steps: Steps = CONTENT_STEPS
) -> DataFrame:
    """Containment: step k counts users with all of steps 1 … k, in any order.

    Step 1 counts every user of the day, also those without the first event.
    """
    rows, grid = _for_days(dwd, days)
    has_all = lambda k: F.col("mask").bitwiseAND(_all_of(k)) == _all_of(k)
    counts = _user_masks(rows, steps).groupBy("stat_date").agg(
        F.count("*").alias("c1"),
        *[count_where(has_all(k)).alias(f"c{k}") for k in range(2, len(steps) + 1)],
    )
    return _step_rows(counts, steps, grid)


def ordered_reach(
    dwd: DataFrame,
    keys: Sequence[str],
    steps: Steps,
    within: str = "1 day",
    bin_size: str = "1 minute",
    mask: Column | None = None,
) -> DataFrame:
    """How far each key got through ``steps`` in time order: columns ``start_1 … start_n``.

    Documented, never computed, by the original; the definition is ours. Step k must
    come strictly later than step k-1 and within ``within`` of the first step.
    ``start_k`` is the latest first step of a chain that reaches step k, null if none.

    A key may hold a third of all rows, so no key is ever read as one list or by one task. Events of
    one instant merge to a bit set. Within a short time bin, running window functions carry the chains
    from row to row: the rows of a bin may spill, so a minute with millions of events of one key needs
    no list of them. A bin becomes one row,
      start_k   latest start of a chain 1 … k inside the bin,
      end_i_j   earliest end of a chain i … j inside the bin (for chains begun before it),
    and the bins of a key, whose number its time span bounds, fold in time order. That combines
    exactly, so bins lose nothing.
    ``mask`` overrides which steps an event counts as (bit k-1 for step k).
    """
    mask = _step_bits(steps) if mask is None else mask
    n = len(steps)
    limit = interval_micros(within)
    bin_micros = interval_micros(bin_size)
    pairs = [(i, j) for i in range(2, n + 1) for j in range(i, n + 1)]

    instants = (
        dwd.filter(F.col("event_type").isin(*[kind for _, kind in steps]))
        .groupBy(*keys, F.unix_micros("event_time").alias("t"))
        .agg(F.bit_or(mask).alias("mask"))
    )

    in_bin = Window.partitionBy(*keys, "bin").orderBy("t")
    earlier = in_bin.rowsBetween(Window.unboundedPreceding, -1)
    did = lambda k: F.col("mask").bitwiseAND(1 << (k - 1)) != 0
    chains = instants.withColumn("bin", F.floor(F.col("t") / bin_micros)).withColumns(
        {"start_1": F.when(did(1), F.col("t")), **{f"end_{i}_{i}": F.when(did(i), F.col("t")) for i in range(2, n + 1)}}
    )
    for k in range(2, n + 1):
        # Instants of a bin are different, so the rows before are strictly earlier ones.
        last = {"_last": F.max(f"start_{k - 1}").over(earlier)}
        ready = {f"_ready_{i}": F.max(F.col(f"end_{i}_{k - 1}").isNotNull()).over(earlier) for i in range(2, k)}
        chains = chains.withColumns(last | ready)
        chains = chains.withColumns(
            {f"start_{k}": F.when(did(k) & (F.col("t") - F.col("_last") <= limit), F.col("_last"))}
            | {f"end_{i}_{k}": F.when(did(k) & F.col(f"_ready_{i}"), F.col("t")) for i in range(2, k)}
        ).drop("_last", *ready)

    starts = [F.max(f"start_{k}").alias(f"start_{k}") for k in range(1, n + 1)]
    ends = [F.min(f"end_{i}_{j}").alias(f"end_{i}_{j}") for i, j in pairs]
    bins = chains.groupBy(*keys, "bin").agg(*starts, *ends)
    bins = bins.select(*keys, "bin", F.struct(*[f"start_{k}" for k in range(1, n + 1)], *[f"end_{i}_{j}" for i, j in pairs]).alias("s"))
    no_starts = [F.lit(None).cast("bigint").alias(f"start_{k}") for k in range(1, n + 1)]

    def at_bin(acc: Column, b: Column) -> Column:
        out = [F.greatest(acc["start_1"], b["s"]["start_1"]).alias("start_1")]
        for k in range(2, n + 1):
            carried = [
                F.when(b["s"][f"end_{m + 1}_{k}"] - acc[f"start_{m}"] <= limit, acc[f"start_{m}"])
                for m in range(1, k)
            ]
            out.append(F.greatest(acc[f"start_{k}"], b["s"][f"start_{k}"], *carried).alias(f"start_{k}"))
        return F.struct(*out)

    return (
        bins.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("bin", "s"))).alias("bins"))
        .select(*keys, F.aggregate("bins", F.struct(*no_starts), at_bin).alias("reach"))
        .select(*keys, "reach.*")
    )


def funnel_ordered(
    dwd: DataFrame,
    days: Iterable[Day] | None = None,
    steps: Steps = AD_STEPS,
    within: str = "1 day",
    bin_size: str = "1 minute",
) -> DataFrame:
    """Users per day who did step k strictly after step k-1, the whole chain inside ``within``.

    The day is that of the first step, without which a day gives no rows unless it is asked for; a
    chain may run over midnight. So an event also stands with
    each earlier day from whose end it is less than ``within`` away, there without the first step:
    for spans up to a day that copies the events of the first ``within`` of a day once.
    """
    ahead = -(-interval_micros(within) // interval_micros("1 day"))
    wanted = None if days is None else sorted({as_date(d) for d in days})
    read = None if wanted is None else {d + dt.timedelta(days=n) for d in wanted for n in range(ahead + 1)}
    rows, _ = _for_days(dwd, read)
    grid = None if wanted is None else dwd.sparkSession.createDataFrame([(d,) for d in wanted], "stat_date date")
    since_midnight = F.unix_micros("event_time") - F.unix_micros(F.date_trunc("day", F.col("event_time")))
    back = F.floor((interval_micros(within) - since_midnight) / interval_micros("1 day")).cast("int") + 1
    rows = (
        rows.filter(F.col("event_type").isin(*[kind for _, kind in steps]))
        .withColumn("_back", F.explode(F.sequence(F.lit(0), F.greatest(back, F.lit(0)))))
        .withColumn("stat_date", F.date_sub(event_day(), F.col("_back")))
    )
    if wanted is not None:
        rows = rows.filter(F.col("stat_date").isin(*wanted))
    bits = _step_bits(steps)
    mask = F.when(F.col("_back") == 0, bits).otherwise(bits.bitwiseAND(~1))
    reach = ordered_reach(rows, ["stat_date", "user_id"], steps, within, bin_size, mask)
    reach = reach.filter("start_1 is not null")
    counts = reach.groupBy("stat_date").agg(
        *[F.count(f"start_{k}").alias(f"c{k}") for k in range(1, len(steps) + 1)]
    )
    return _step_rows(counts, steps, grid)


def app_conversion(dwd: DataFrame) -> DataFrame:
    """Per day and app: users downloading it over users clicking it. The definition is ours."""
    rows = dwd.filter(is_type("app_click", "app_download")).select(
        event_day().alias("stat_date"),
        app_name(None).alias("app_name"),
        "user_id",
        F.when(is_type("app_click"), 1).otherwise(2).alias("bit"),
    )
    users = rows.filter("app_name is not null").groupBy("stat_date", "app_name", "user_id").agg(
        F.bit_or("bit").alias("mask")
    )
    counts = users.groupBy("stat_date", "app_name").agg(
        count_where(F.col("mask").bitwiseAND(1) != 0).alias("click_users"),
        count_where(F.col("mask").bitwiseAND(2) != 0).alias("download_users"),
    )
    rate = percent(F.col("download_users"), F.col("click_users"))
    return counts.withColumn("conversion_rate", rate)
