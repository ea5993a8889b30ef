"""Raw log (ODS) to clean detail (DWD)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import (
    count_where,
    or_unknown,
    parse_time,
    valid_event_type,
    valid_user,
)

Day = dt.date | str


def dedup_latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per ``keys``: the newest ``version``; ties fall to the other columns, so reruns agree.

    The checked columns come first among these, whatever others ``df`` has: a copy's user, type and
    day do not depend on what else a query reads. Rows with a null key are no copies of each other
    and fall out; the cleaning report counts them.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle: each task sends at most one row per key, so a key with a third of
    all rows costs its receiver one row per sender.
    """
    df = df.dropna(subset=list(keys))
    rest = [c for c in df.columns if c not in keys and c != version]
    rest.sort(key=lambda c: CHECKED.index(c) if c in CHECKED else len(CHECKED))
    order = [F.col(version).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in rest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def fill_defaults(df: DataFrame) -> DataFrame:
    filled = {
        "city": or_unknown("city"),
        "device_model": or_unknown("device_model"),
        "duration": F.coalesce(F.col("duration"), F.lit(0)),
    }
    return df.withColumns({c: v for c, v in filled.items() if c in df.columns})


def parse_times(df: DataFrame) -> DataFrame:
    """Text times become timestamps; columns that already are stay untouched."""
    texts = [c for c, t in df.dtypes if c in ("event_time", "server_time") and t != "timestamp"]
    return df.withColumns({c: parse_time(c) for c in texts}) if texts else df


CHECKED = ("event_id", "event_type", "user_id", "event_time", "server_time")


def ods_to_dwd(
    ods: DataFrame, columns: Sequence[str] | None = None, days: tuple[Day, Day] | None = None
) -> DataFrame:
    """De-duplicate, then validate: an event whose newest copy is illegal is dropped whole.

    With ``columns`` the result holds these and the checked ones, and nothing else is
    read or shuffled. With ``days`` (first, last) only these days are read, which takes the
    copies of an event to have its event time. Both are for analyses straight on the raw log. Copies with equal times are
    then told apart by the columns kept.
    """
    if days is not None:
        ods = between_days(parse_times(ods), *days)
    if columns is not None:
        ods = ods.select(*[c for c in ods.columns if c in CHECKED or c in columns])
    newest = dedup_latest(parse_times(ods), ["event_id"], "server_time")
    return fill_defaults(newest.filter(valid_user() & valid_event_type()))


def cleaning_report(ods: DataFrame) -> DataFrame:
    """Row counts in, without an id, after de-duplication, after validation and out."""
    newest = dedup_latest(parse_times(ods), ["event_id"], "server_time")
    valid = count_where(valid_user() & valid_event_type())
    after = newest.agg(F.count("*").alias("rows_deduplicated"), valid.alias("rows_valid"), valid.alias("rows_out"))
    before = ods.agg(F.count("*").alias("rows_in"), count_where(F.col("event_id").isNull()).alias("rows_without_id"))
    # Both sides are one row by construction.
    return before.join(F.broadcast(after))


def enrich_city(df: DataFrame, ip_ranges: DataFrame) -> DataFrame:
    """Fill empty cities from ``ip_ranges(ip_from, ip_to, city)``, both ends inclusive, ranges disjoint.

    Only documented, never computed, by the original. A lookup without a range join: ranges are cut into aligned
    blocks of addresses (:func:`address_blocks`), and for each block size there is an equality join on the address's
    leading bits. A range of any width gives a few dozen blocks; blocks are broadcast while Spark's statistics say
    that those of a size are small.
    """
    blocks = address_blocks(ip_ranges)
    # At most 33 sizes.
    sizes = sorted(r.bits for r in blocks.select("bits").distinct().collect())
    joined, found = df.withColumn("_ip", ip_to_long(F.col("ip"))), []
    for bits in sizes:
        own = blocks.filter(F.col("bits") == bits).select(F.col("prefix").alias(f"_p{bits}"), F.col("city").alias(f"_c{bits}"))
        joined = joined.join(own, F.shiftright("_ip", bits) == F.col(f"_p{bits}"), "left")
        found.append(F.col(f"_c{bits}"))
    known = F.coalesce(F.nullif(F.col("city"), F.lit("")), *found, F.lit(""))
    return joined.withColumn("city", known).select(*df.columns)


def address_blocks(ip_ranges: DataFrame) -> DataFrame:
    """bits, prefix, city: each range as aligned blocks of ``2 ** bits`` addresses, at most two of a size.

    With the range as [low, high) in blocks of a size, an odd low one is not half of the next larger block, nor is the
    last one below an odd high; these two stand for themselves, all others go into the next size.
    """
    low, high = F.col("_lo"), F.col("_hi")
    sized = ip_ranges.select(
        ip_to_long(F.col("ip_from")).alias("_from"),
        (ip_to_long(F.col("ip_to")) + 1).alias("_to"),
        "city",
        F.explode(F.sequence(F.lit(0), F.lit(32))).alias("bits"),
    )
    size = F.expr("shiftleft(1L, bits)")
    sized = sized.withColumns({"_lo": F.ceil(F.col("_from") / size), "_hi": F.floor(F.col("_to") / size)}).filter("_lo < _hi")
    first = F.when(low % 2 == 1, low)
    last = F.when((high % 2 == 1) & (low + low % 2 < high), high - 1)
    return sized.select("bits", "city", F.explode(F.array(first, last)).alias("prefix")).filter("prefix is not null")


def ip_to_long(ip: Column) -> Column:
    part = F.split(ip, r"\.")
    return sum(
        (F.get(part, i).cast("bigint") * F.lit(256 ** (3 - i)) for i in range(1, 4)),
        F.get(part, 0).cast("bigint") * F.lit(256**3),
    )


def only_types(df: DataFrame, types: Sequence[str]) -> DataFrame:
    return df.filter(F.col("event_type").isin(*types))


def between_days(df: DataFrame, first: Day, last: Day, time_col: str = "event_time") -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included.

    Written as a half-open range on the raw time, so it reaches the file scan; a
    ``dt`` partition column, when there is one, is filtered too and prunes folders.
    """
    first, last = as_date(first), as_date(last)
    start, end = str(first), str(last + dt.timedelta(days=1))
    df = df.filter(
        (F.col(time_col) >= F.lit(start).cast("timestamp")) & (F.col(time_col) < F.lit(end).cast("timestamp"))
    )
    if "dt" in df.columns:
        df = df.filter(F.col("dt").between(str(first), str(last)))
    return df


def on_day(df: DataFrame, day: Day) -> DataFrame:
    return between_days(df, day, day)


def last_days(df: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """From ``as_of - days`` to ``as_of``: for 7 that is eight calendar days."""
    as_of = as_date(as_of)
    return between_days(df, as_of - dt.timedelta(days=days), as_of)


def as_date(day: Day) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


__all__ = [
    "as_date",
    "between_days",
    "cleaning_report",
    "dedup_latest",
    "enrich_city",
    "fill_defaults",
    "last_days",
    "ods_to_dwd",
    "on_day",
    "only_types",
    "parse_times",
]
