import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from footfall.functions import stats
from footfall.operators import experiment, significance
from footfall.sources.experiments import experiments_df
from tests.conftest import rows

DAY = "2026-07-10"
EXP = "exp_001_home_rec_algo"


def group(variant, **more):
    return {"experiment_id": EXP, "variant": variant, **more}


def test_bucket_equals_hashlib(spark):
    users = spark.createDataFrame([(f"user_{i:06d}",) for i in range(1, 2001)], "user_id string")
    got = {(r.user_id, r.experiment_id): (r.bucket, r.variant) for r in experiment.assign_all(users).collect()}
    assert len(got) == 4000
    for (user, exp), (bucket, variant) in got.items():
        want = int.from_bytes(hashlib.md5(f"{user}_{exp}".encode()).digest()[:4], "big") % 100
        assert bucket == want
        assert variant == ("A" if want < (50 if exp == EXP else 60) else "B")
    share = lambda exp: sum(v == "A" for (_, e), (_, v) in got.items() if e == exp) / 2000
    assert abs(share(EXP) - 0.5) < 0.04 and abs(share("exp_002_search_ranking") - 0.6) < 0.04


def test_group_without_downloads(make_events):
    events = make_events([("a", "app_download", f"{DAY} 10:00:00", group("A")), ("b", "app_click", f"{DAY} 10:00:00", group("B"))])
    got = rows(experiment.ab_experiment(events), "metric_name", "variant", "metric_value", "uplift")
    assert ("download_conversion_rate", "B", 0.0, -100.0) in got
    assert [r for r in got if r[0] == "download_count"] == [("download_count", "A", 1.0, 0.0)]


def test_metrics_and_uplift(make_events):
    events = make_events(
        [("a1", "page_view", f"{DAY} 10:00:00", group("A", duration=100)), ("a2", "page_view", f"{DAY} 10:00:00", group("A", duration=101)),
         ("b1", "page_view", f"{DAY} 10:00:00", group("B", duration=300)), ("b1", "app_click", f"{DAY} 10:00:00", group("B")),
         ("b1", "app_click", f"{DAY} 10:00:00", group("B")), ("x", "page_view", f"{DAY} 10:00:00")]
    )
    got = {(r.metric_name, r.variant): r for r in experiment.ab_experiment(events).collect()}
    assert got["pv", "A"].metric_value == 2 and got["pv", "B"].metric_value == 3 and got["pv", "A"].uplift == 50.0
    assert got["avg_duration", "A"].metric_value == 101.0 and got["avg_duration", "A"].uplift == 197.03
    assert got["uv", "B"].metric_unit == "人" and got["uv", "B"].p_value == -1.0


def samples_df(spark, metric, a, b):
    data = [(DAY, EXP, v, metric, f"{v}{i}", float(x)) for v, xs in (("A", a), ("B", b)) for i, x in enumerate(xs)]
    schema = "stat_date string, experiment_id string, variant string, metric_name string, user_id string, value double"
    return spark.createDataFrame(data, schema).withColumn("stat_date", F.to_date("stat_date"))


def test_mann_whitney_against_brute_force(spark):
    rng = random.Random(2)
    a, b = [rng.randrange(6) for _ in range(40)], [rng.randrange(7) for _ in range(35)]
    row = significance.ab_test_stats(samples_df(spark, "pv", a, b)).collect()[0]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    ties = sum(n**3 - n for n in ((a + b).count(v) for v in set(a + b)))
    assert (row.u_statistic, row.tie_term) == (u, ties)
    n = 75
    spread = 40 * 35 / 12 * ((n + 1) - ties / (n * (n - 1)))
    p = math.erfc((max(u, 1400 - u) - 700 - 0.5) / math.sqrt(spread) / math.sqrt(2))
    got = significance.ab_significance(samples_df(spark, "pv", a, b)).collect()[0]
    assert got.test == "mann_whitney" and got.p_value == pytest.approx(p, abs=1e-6)


def test_choice_of_test(spark):
    run = lambda m, a, b: significance.ab_significance(samples_df(spark, m, a, b)).collect()[0]
    few = run("pv", [1, 2, 3, 4], [1, 2, 3, 4, 5])
    assert (few.test, few.p_value, few.is_significant) == ("none", -1.0, 0)
    binary = run("download_conversion_rate", [1] * 8 + [0] * 2, [1] + [0] * 5)
    assert binary.test == "fisher" and binary.p_value == 0.034965 and binary.is_significant == 1
    # Counts that happen to be 0 and 1 only take the same test.
    assert run("search_count", [0, 1, 0, 1, 0], [1, 1, 1, 0, 0]).test == "fisher"
    welch = run("avg_duration", [10.5, 12, 11, 13, 12.5], [20, 22, 19, 25, 21])
    assert welch.test == "welch"
    assert welch.p_value == pytest.approx(0.000258, abs=2e-5) or welch.is_significant == 1


def test_welch_textbook(spark):
    a = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
    b = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 30.5, 25.0]
    rows_ = significance.welch_columns(significance.ab_test_stats(samples_df(spark, "avg_duration", a, b)))
    row = rows_.collect()[0]
    va, vb = (sum((x - sum(v) / 15) ** 2 for x in v) / 14 / 15 for v in (a, b))
    assert row.t_statistic == pytest.approx((sum(a) - sum(b)) / 15 / math.sqrt(va + vb))
    assert row.degrees == pytest.approx((va + vb) ** 2 / (va**2 / 14 + vb**2 / 14))
    got = significance.ab_significance(samples_df(spark, "avg_duration", a, b)).collect()[0]
    assert got.p_value == pytest.approx(stats.student_two_sided(row.t_statistic, row.degrees), abs=1e-6)


def test_p_value_of_zero_is_significant(spark):
    got = significance.ab_significance(samples_df(spark, "pv", range(300), range(1000, 1300))).collect()[0]
    assert (got.p_value, got.is_significant) == (0.0, 1)


def test_z_test(spark):
    z = lambda a, b: significance.z_test(significance.ab_test_stats(samples_df(spark, "pv", a, b))).collect()[0]
    assert z([1, 2, 3, 4, 5], [5, 4, 3, 2, 1]).p_value == pytest.approx(1.0, abs=1e-6)
    assert z([2] * 5, [3] * 5).p_value == 1.0


def test_write_back_and_report(spark, make_events):
    events = make_events(
        [(f"{v}{i}", "page_view", f"{DAY} 10:00:00", group(v, duration=d + i)) for v, d in (("A", 100), ("B", 900)) for i in range(6)]
    )
    results = significance.apply_significance(
        experiment.ab_experiment(events), significance.ab_significance(experiment.ab_samples(events))
    )
    marks = dict(rows(experiment.ab_pivot(results), "metric_name", "marker"))
    assert marks["avg_duration"] == "✅" and marks["uv"] == "" and marks["download_conversion_rate"] == "❌"
    report = {r.metric_name: r for r in experiment.ab_report(results).collect()}
    assert report["avg_duration"].is_significant == 1 and report["uv"].p_value == -1.0
    assert "download_count" not in report


def test_config(spark, make_events):
    config = experiments_df(spark)
    assert rows(config.selectExpr("experiment_id", "traffic_split['A']")) == [(EXP, 50), ("exp_002_search_ranking", 60)]
    events = make_events([("a", "page_view", f"{d} 10:00:00", group("A")) for d in ("2026-07-09", "2026-07-10", "2026-07-21")])
    assert experiment.within_dates(experiment.ab_metrics(events), config).select("stat_date").distinct().count() == 1


def test_assignment_within_dates(make_events):
    at = ["2020-01-01 10:00:00", "2026-07-12 10:00:00", "2026-07-19 10:00:00"]
    events = make_events([("u", "page_view", t, {"event_id": f"{t}{i}"}) for t in at for i in range(20)] + [(None, "page_view", at[1])])
    got = experiment.assign_experiment(events, time_col="event_time").select("event_time", "user_id", "experiment_id", "variant").collect()
    of = lambda t: {r.experiment_id for r in got if str(r.event_time) == t and r.user_id}
    assert of(at[0]) == {""} and of(at[1]) == {"exp_001_home_rec_algo", "exp_002_search_ranking"}
    assert of(at[2]) == {"exp_001_home_rec_algo", ""}
    assert [(r.experiment_id, r.variant) for r in got if r.user_id is None] == [("", "")]
