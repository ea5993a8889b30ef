"""A/B experiments: assignment, metrics, uplift, samples, reports."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import (
    assign_variant,
    count_where,
    event_day,
    experiment_bucket,
    half_up,
    hash_bucket,
    is_type,
    json_field,
    percent,
)
from footfall.operators.clean import Day, on_day
from footfall.sources.experiments import EXPERIMENTS, experiment_structs

KEYS = ["stat_date", "experiment_id", "variant"]


def assign_experiment(
    df: DataFrame,
    config: Mapping[str, Mapping[str, Any]] = EXPERIMENTS,
    seed: int = 0,
    time_col: str | None = "event_time",
) -> DataFrame:
    """Attach one experiment to each event, and the user's group in it.

    A seeded hash of the event id replaces the random draw, so reruns agree. An event outside the drawn
    experiment's dates belongs to none, nor does one without a user: both read as empty. ``time_col=None``
    takes every experiment as running, for logs that lie outside all dates.
    """
    running = experiment_structs(config)
    pick = hash_bucket(F.concat_ws("_", F.lit(str(seed)), F.col("event_id")), len(config)).cast("int")
    chosen = df.withColumn("_e", F.get(running, pick)).withColumns(
        {
            "experiment_id": F.col("_e.experiment_id"),
            "variant": assign_variant(F.col("user_id"), F.col("_e.experiment_id"), F.col("_e.a_share")),
        }
    )
    on = F.col("user_id").isNotNull()
    if time_col is not None:
        day = F.to_date(time_col)
        dates = F.create_map(
            *[
                x
                for key, e in config.items()
                for x in (F.lit(key), F.struct(F.lit(e["start_date"]).cast("date").alias("a"), F.lit(e["end_date"]).cast("date").alias("b")))
            ]
        )
        of = F.try_element_at(dates, F.col("experiment_id"))
        on = F.coalesce(day.between(of["a"], of["b"]) & on, F.lit(False))
    return chosen.withColumns({c: F.when(on, F.col(c)).otherwise("") for c in ("experiment_id", "variant")}).drop("_e")


def assign_all(users: DataFrame, config: Mapping[str, Mapping[str, Any]] = EXPERIMENTS) -> DataFrame:
    """Every user's group in every experiment, the experiments being independent layers."""
    spread = users.select("user_id", F.inline(experiment_structs(config)))
    user, experiment = F.col("user_id"), F.col("experiment_id")
    return spread.select(
        "user_id",
        "experiment_id",
        experiment_bucket(user, experiment).alias("bucket"),
        assign_variant(user, experiment, F.col("a_share")).alias("variant"),
    )


def experiment_events(dwd: DataFrame, day: Day | None = None) -> DataFrame:
    """Rows that belong to an experiment; null ids and groups fall out too."""
    rows = dwd.filter((F.col("experiment_id") != "") & (F.col("variant") != ""))
    return rows if day is None else on_day(rows, day)


def user_totals(dwd: DataFrame, day: Day | None = None) -> DataFrame:
    """One row per day, experiment, group and user. Every metric and sample is built from it.

    This is the only pass over the events; sums are partial before its shuffle. Metrics
    and samples use the same columns of it, so a job that needs both shuffles once.
    Clean rows have a duration (0 when it was missing).
    """
    time = F.col("event_time")
    position = F.when(is_type("app_click"), json_field("position").cast("int"))
    return (
        experiment_events(dwd, day)
        .groupBy(event_day().alias("stat_date"), "experiment_id", "variant", "user_id")
        .agg(
            F.count("*").alias("events"),
            count_where(is_type("app_download")).alias("downloads"),
            count_where(is_type("search_query")).alias("searches"),
            count_where(is_type("app_click")).alias("clicks"),
            count_where(is_type("page_view")).alias("views"),
            F.sum(F.when(is_type("page_view"), F.col("duration").cast("bigint"))).alias("view_ms"),
            F.sum(position.cast("bigint")).alias("position_sum"),
            F.count(position).alias("positions"),
            F.min(F.when(is_type("search_query"), time)).alias("first_search"),
            F.max(F.when(is_type("app_download"), time)).alias("last_download"),
        )
    )


def _metric(name: str, value: Column, unit: str, users: Column, present: Column | None = None) -> Column:
    row = F.struct(
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.lit(unit).alias("metric_unit"),
        users.alias("user_count"),
    )
    return row if present is None else F.when(present, row)


def ab_metrics(dwd: DataFrame, day: Day | None = None, extra: bool = False) -> DataFrame:
    """The metrics of every day, experiment and group in long form.

    A group without downloads, searches or page views has no row for that count, but
    a conversion of 0.0. ``extra`` adds three metrics that are only named in the
    experiment settings; their definitions are ours.
    """
    c = F.col
    searched = c("searches") > 0
    groups = user_totals(dwd, day).groupBy(*KEYS).agg(
        F.sum("events").alias("pv"),
        F.count("*").alias("uv"),
        F.sum("downloads").alias("downloads"),
        count_where(c("downloads") > 0).alias("downloaders"),
        F.sum("searches").alias("searches"),
        count_where(searched).alias("searchers"),
        count_where(c("views") > 0).alias("viewers"),
        F.sum("view_ms").alias("view_ms"),
        F.sum("views").alias("views"),
        count_where(c("clicks") > 0).alias("clickers"),
        count_where(searched & (c("first_search") < c("last_download"))).alias("search_downloaders"),
        F.sum("position_sum").alias("position_sum"),
        F.sum("positions").alias("positions"),
    )
    rows = [
        _metric("pv", c("pv"), "次", c("uv")),
        _metric("uv", c("uv"), "人", c("uv")),
        _metric("download_count", c("downloads"), "次", c("downloaders"), c("downloads") > 0),
        _metric("download_conversion_rate", percent(c("downloaders"), c("uv")), "%", c("uv")),
        _metric("search_count", c("searches"), "次", c("searchers"), c("searches") > 0),
        _metric(
            "avg_duration",
            half_up(F.try_divide(c("view_ms").cast("double"), c("views")), 0),
            "ms",
            c("viewers"),
            c("views") > 0,
        ),
    ]
    if extra:
        rows += [
            _metric("app_click_rate", percent(c("clickers"), c("uv")), "%", c("uv")),
            _metric(
                "search_to_download_rate",
                percent(c("search_downloaders"), c("searchers")),
                "%",
                c("searchers"),
                c("searchers") > 0,
            ),
            _metric(
                "avg_search_position_clicked",
                half_up(F.try_divide(c("position_sum").cast("double"), c("positions"))),
                "",
                c("clickers"),
                c("positions") > 0,
            ),
        ]
    return groups.select(*KEYS, F.inline(F.array_compact(F.array(*rows))))


def uplift(a: Column, b: Column) -> Column:
    """``(B - A) / A`` in percent; 0 when A is missing or not positive, or B is missing."""
    value = half_up((b - a) / a * F.lit(100.0))
    return F.coalesce(F.when(a > 0, value), F.lit(0.0))


def with_uplift(metrics: DataFrame) -> DataFrame:
    """Both groups' rows get the uplift of their rounded metric values."""
    pair = Window.partitionBy("stat_date", "experiment_id", "metric_name")
    of = lambda v: F.max(F.when(F.col("variant") == v, F.col("metric_value"))).over(pair)
    return metrics.withColumns({"_a": of("A"), "_b": of("B")}).withColumn(
        "uplift", uplift(F.col("_a"), F.col("_b"))
    ).drop("_a", "_b")


def ab_experiment(dwd: DataFrame, day: Day | None = None, extra: bool = False) -> DataFrame:
    """Result rows, untested: p-value -1, not significant."""
    return with_uplift(ab_metrics(dwd, day, extra)).select(
        "experiment_id",
        "stat_date",
        "variant",
        "metric_name",
        "metric_value",
        "metric_unit",
        "user_count",
        F.lit(-1.0).alias("p_value"),
        F.lit(0).alias("is_significant"),
        "uplift",
        F.lit("").alias("sample_data"),
    )


def ab_samples(dwd: DataFrame, day: Day | None = None) -> DataFrame:
    """One value per user and metric: all users, those without such events counting 0."""
    c = F.col
    value = lambda name, v: F.struct(F.lit(name).alias("metric_name"), v.cast("double").alias("value"))
    mean = F.try_divide(c("view_ms").cast("double"), c("views"))
    rows = F.array(
        value("pv", c("events")),
        value("download_count", c("downloads")),
        value("search_count", c("searches")),
        value("download_conversion_rate", (c("downloads") > 0).cast("int")),
        F.when(c("views") > 0, value("avg_duration", mean)),
    )
    return user_totals(dwd, day).select(*KEYS, "user_id", F.inline(F.array_compact(rows)))


def ab_pivot(results: DataFrame) -> DataFrame:
    """The two groups side by side, with the chart's marker: significant, tested but not, untested."""
    marker = (
        F.when(F.max("is_significant") == 1, "✅").when(F.max("p_value") >= 0, "❌").otherwise("")
    )
    return (
        results.groupBy("experiment_id", "stat_date", "metric_name", "metric_unit")
        .agg(
            F.max(F.when(F.col("variant") == "A", F.col("metric_value"))).alias("a_value"),
            F.max(F.when(F.col("variant") == "B", F.col("metric_value"))).alias("b_value"),
            F.max("uplift").alias("uplift"),
            marker.alias("marker"),
        )
    )


def ab_report(results: DataFrame) -> DataFrame:
    """One row per experiment and metric that has both groups: values, uplift, p-value, verdict."""
    both = results.groupBy("experiment_id", "stat_date", "metric_name").agg(
        F.max(F.when(F.col("variant") == "A", F.col("metric_value"))).alias("a_value"),
        F.max(F.when(F.col("variant") == "B", F.col("metric_value"))).alias("b_value"),
        F.max("uplift").alias("uplift"),
        F.max("p_value").alias("p_value"),
        F.max("is_significant").alias("is_significant"),
    )
    return both.filter("a_value is not null and b_value is not null")


def hypothesis_met(results: DataFrame, experiments: DataFrame) -> DataFrame:
    """Did each experiment's main metric rise by at least what its hypothesis asks?"""
    goals = experiments.select(
        "experiment_id", F.col("primary_metric").alias("metric_name"), "min_uplift"
    )
    main = results.filter(F.col("variant") == "B").join(goals, ["experiment_id", "metric_name"])
    return main.select(
        "experiment_id",
        "stat_date",
        "metric_name",
        "uplift",
        "min_uplift",
        (F.col("uplift") >= F.col("min_uplift")).cast("int").alias("is_met"),
    )


def within_dates(df: DataFrame, experiments: DataFrame) -> DataFrame:
    """Rows dated inside their experiment's running days."""
    dates = experiments.select("experiment_id", "start_date", "end_date")
    return (
        df.join(dates, "experiment_id")
        .filter(F.col("stat_date").between(F.col("start_date"), F.col("end_date")))
        .drop("start_date", "end_date")
    )
