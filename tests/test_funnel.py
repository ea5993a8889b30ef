import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from footfall.operators.funnel import AD_STEPS, funnel_contained, funnel_ordered, funnel_steps, ordered_reach
from footfall.operators.windows import funnel_windowed
from tests.conftest import rows

DAY = "2026-07-10"


def counts(df):
    return [n for _, n in rows(df, "step_order", "user_count")]


def test_published_sample_rates(make_events):
    """1000 / 200 / 50 / 35 users: step 100/20/25/70, overall 100/20/5/3.5."""
    events = make_events(
        [(f"u{i}", kind, f"{DAY} 10:00:00") for (_, kind), n in zip(AD_STEPS, (1000, 200, 50, 35)) for i in range(n)]
    )
    got = rows(funnel_steps(events, [DAY]), "step_order", "step_name", "user_count", "step_rate", "overall_rate")
    assert got == [
        (1, "impression", 1000, 100.0, 100.0),
        (2, "click", 200, 20.0, 20.0),
        (3, "download", 50, 25.0, 5.0),
        (4, "install", 35, 70.0, 3.5),
    ]


def test_independent_rate_may_exceed_hundred(make_events):
    events = make_events([("a", "ad_impression", f"{DAY} 10:00:00"), ("a", "ad_click", f"{DAY} 10:00:00"),
                          ("b", "ad_click", f"{DAY} 10:00:00")])
    assert rows(funnel_steps(events, [DAY]), "step_order", "step_rate")[1] == (2, 200.0)


def test_empty_day_has_four_rows(make_events):
    events = make_events([("a", "ad_click", f"{DAY} 10:00:00")])
    for build in (funnel_steps, funnel_contained, funnel_ordered):
        assert rows(build(events, ["2026-01-01"]), "step_order", "user_count", "step_rate") == [
            (i, 0, 0.0) for i in (1, 2, 3, 4)
        ]


def test_click_before_impression(make_events):
    """Contained counts both steps, ordered only the first."""
    steps = (("impression", "ad_impression"), ("click", "ad_click"))
    events = make_events([("a", "ad_click", f"{DAY} 10:00:00"), ("a", "ad_impression", f"{DAY} 11:00:00")])
    assert counts(funnel_contained(events, [DAY], steps)) == [1, 1]
    assert counts(funnel_ordered(events, [DAY], steps)) == [1, 0]


def test_contained_counts_everybody_first_and_never_rises(make_events):
    rng = random.Random(3)
    kinds = ["page_view", "app_click", "app_download", "app_install", "search_query"]
    events = make_events([(f"u{rng.randrange(30)}", rng.choice(kinds), f"{DAY} 10:00:00") for _ in range(150)])
    got = counts(funnel_contained(events, [DAY]))
    assert got[0] == events.select("user_id").distinct().count()
    assert got == sorted(got, reverse=True)


def reach_by_hand(events, limit):
    """Deepest step of one user: every chain is tried."""
    kinds = [k for _, k in AD_STEPS]
    best = 0
    chains = [(t, t, 1) for k, t in events if k == kinds[0]]
    seen = set()
    while chains:
        start, at, depth = chains.pop()
        if (start, at, depth) in seen:
            continue
        seen.add((start, at, depth))
        best = max(best, depth)
        if depth < 4:
            chains += [(start, t, depth + 1) for k, t in events if k == kinds[depth] and at < t <= start + limit]
    return best


@pytest.mark.parametrize("bin_size", ["10 seconds", "1 minute", "1 day"])
def test_ordered_against_brute_force(make_events, bin_size):
    rng = random.Random(5)
    start = dt.datetime(2026, 7, 10)
    raw = [(f"u{rng.randrange(60)}", rng.choice(AD_STEPS)[1], rng.randrange(600)) for _ in range(900)]
    events = make_events([(u, k, str(start + dt.timedelta(seconds=s))) for u, k, s in raw])
    reach = ordered_reach(events, ["user_id"], AD_STEPS, "100 seconds", bin_size)
    got = {
        r.user_id: sum(r[f"start_{k}"] is not None for k in range(1, 5)) for r in reach.collect()
    }
    want = {u: reach_by_hand([(k, s) for v, k, s in raw if v == u], 100) for u in {u for u, _, _ in raw}}
    assert got == want
    assert len(set(want.values())) > 2


def test_windowed_counts_events(make_events):
    events = make_events([("a", "ad_click", f"{DAY} 10:01:00"), ("a", "ad_click", f"{DAY} 10:02:00"),
                          ("a", "page_view", f"{DAY} 11:00:00"), ("b", "ad_impression", f"{DAY} 10:20:00"),
                          ("b", "ad_click", f"{DAY} 10:29:59")])
    got = rows(funnel_windowed(events), "window_start", "impression", "click", "click_rate")
    assert got == [(dt.datetime(2026, 7, 10, 10, 0), 0, 2, 0.0), (dt.datetime(2026, 7, 10, 10, 20), 1, 1, 100.0)]


def test_ordered_chain_over_midnight(make_events):
    steps = [("u", "ad_impression", "2026-07-10 23:50:00"), ("u", "ad_click", "2026-07-11 00:05:00"), ("u", "app_download", "2026-07-11 00:06:00")]
    late = [("v", "ad_impression", "2026-07-10 10:00:00"), ("v", "ad_click", "2026-07-11 10:00:01")]
    counts = lambda *days: [r.user_count for r in funnel_ordered(make_events(steps + late), days or None).orderBy("stat_date", "step_order").collect()]
    assert counts() == [2, 1, 1, 0]
    assert counts("2026-07-10") == [2, 1, 1, 0] and counts("2026-07-11") == [0, 0, 0, 0]


def test_ordered_funnel_of_a_dense_minute(spark):
    """300,000 instants of one user in one minute: no list of them, and the same chain as by hand."""
    kinds = F.element_at(F.array(*[F.lit(k) for _, k in AD_STEPS]), (F.col("id") / 75_000).cast("int") + 1)
    events = spark.range(300_000).select(
        F.lit("u").alias("user_id"), kinds.alias("event_type"), F.timestamp_micros(F.lit(1_783_641_600_000_000) + F.col("id") * 150).alias("event_time")
    )
    (reach,) = ordered_reach(events, ["user_id"], AD_STEPS, "1 minute").collect()
    start = 1_783_641_600_000_000
    # The latest impression is followed by all steps in time.
    assert [reach[f"start_{k}"] for k in range(1, 5)] == [start + 74_999 * 150] * 4
    plan = ordered_reach(events, ["user_id"], AD_STEPS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "collect_list(struct(bin" in plan.replace("named_struct", "struct")
