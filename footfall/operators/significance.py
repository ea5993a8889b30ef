"""Significance tests. Moments, ranks and tables are Spark aggregates; only the last step is a tail function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.expressions import count_where, half_up
from footfall.functions.stats import fisher_p, mann_whitney_p, normal_two_sided, student_p

PAIR = ["stat_date", "experiment_id", "metric_name"]
MEAN_METRIC = "avg_duration"
MIN_SAMPLE = 5
LEVEL = 0.05


def ab_test_stats(samples: DataFrame) -> DataFrame:
    """Per day, experiment and metric: sizes, moments, the 0/1 table and the rank statistics of both groups.

    Samples merge to (value, count A, count B) before ranking, so ranks run over
    distinct values. Those metrics are counts per user, whose distinct values number at
    most the square root of twice the events; the one metric of means has almost as many
    values as users, needs no ranks, and merges to a single row of moments instead.
    """
    c = F.col
    in_a, in_b = c("variant") == "A", c("variant") == "B"
    value_a, value_b = F.when(in_a, c("value")), F.when(in_b, c("value"))
    ranked = F.when(c("metric_name") != MEAN_METRIC, c("value"))
    merged = (
        samples.filter(in_a | in_b)
        .groupBy(*PAIR, ranked.alias("rank_value"))
        .agg(
            F.count(value_a).alias("n_a"),
            F.count(value_b).alias("n_b"),
            F.avg(value_a).alias("mean_a"),
            F.avg(value_b).alias("mean_b"),
            F.var_samp(value_a).alias("var_a"),
            F.var_samp(value_b).alias("var_b"),
            F.sum(F.coalesce(value_a, F.lit(0.0))).alias("sum_a"),
            F.sum(F.coalesce(value_b, F.lit(0.0))).alias("sum_b"),
            F.sum(F.coalesce(value_a * value_a, F.lit(0.0))).alias("sq_a"),
            F.sum(F.coalesce(value_b * value_b, F.lit(0.0))).alias("sq_b"),
            count_where(~c("value").isin(0.0, 1.0)).alias("other"),
        )
    )
    below = (
        Window.partitionBy(*PAIR).orderBy("rank_value").rowsBetween(Window.unboundedPreceding, -1)
    )
    n = c("n_a") + c("n_b")
    placed = merged.withColumn("n", n).withColumn(
        "mid_rank", F.coalesce(F.sum("n").over(below), F.lit(0)) + (c("n") + 1) / F.lit(2.0)
    )
    is_mean = F.col("metric_name") == MEAN_METRIC
    total = placed.groupBy(*PAIR).agg(
        *[F.sum(x).alias(x) for x in ("n_a", "n_b", "sum_a", "sum_b", "sq_a", "sq_b", "other")],
        # A metric of means has one merged row, whose moments are already exact.
        F.max(F.when(is_mean, c("mean_a"))).alias("mean_a"),
        F.max(F.when(is_mean, c("mean_b"))).alias("mean_b"),
        F.max(F.when(is_mean, c("var_a"))).alias("var_a"),
        F.max(F.when(is_mean, c("var_b"))).alias("var_b"),
        F.sum(c("mid_rank") * c("n_a")).alias("rank_sum_a"),
        F.sum(c("n").cast("double") * c("n") * c("n") - c("n")).alias("tie_term"),
    )

    def mean(v: str) -> Column:
        return F.coalesce(c(f"mean_{v}"), F.try_divide(c(f"sum_{v}"), c(f"n_{v}"))).alias(f"mean_{v}")

    def var(v: str) -> Column:
        whole = c(f"sq_{v}") - F.try_divide(c(f"sum_{v}") * c(f"sum_{v}"), c(f"n_{v}"))
        return F.when(
            c(f"n_{v}") > 1, F.coalesce(c(f"var_{v}"), whole / (c(f"n_{v}") - 1))
        ).alias(f"var_{v}")

    u = c("rank_sum_a") - c("n_a") * (c("n_a") + 1) / F.lit(2.0)
    return total.select(
        *PAIR,
        "n_a",
        "n_b",
        mean("a"),
        mean("b"),
        var("a"),
        var("b"),
        (c("other") == 0).cast("int").alias("is_binary"),
        c("sum_a").alias("ones_a"),
        c("sum_b").alias("ones_b"),
        F.when(~is_mean, u).alias("u_statistic"),
        F.when(~is_mean, c("tie_term")).alias("tie_term"),
    )


def _enough() -> Column:
    return (F.col("n_a") >= MIN_SAMPLE) & (F.col("n_b") >= MIN_SAMPLE)


def contingency(stats: DataFrame) -> DataFrame:
    """Binary metrics as a 2×2 table: ones and zeros of A, then of B."""
    c = F.col
    ones = lambda v: c(f"ones_{v}").cast("bigint")
    return stats.filter(_enough() & (c("is_binary") == 1)).select(
        *PAIR,
        ones("a").alias("a"),
        (c("n_a") - ones("a")).alias("b"),
        ones("b").alias("c"),
        (c("n_b") - ones("b")).alias("d"),
    )


def fisher_test(tables: DataFrame) -> DataFrame:
    return tables.withColumn("p_value", fisher_p("a", "b", "c", "d"))


def chi_square_test(tables: DataFrame) -> DataFrame:
    """Pearson's chi-square of the 2×2 table, one degree of freedom, for large counts."""
    a, b, c, d = (F.col(x).cast("double") for x in "abcd")
    n = a + b + c + d
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    cross = a * d - b * c
    chi2 = F.when(margins > 0, n * cross * cross / margins).otherwise(F.lit(0.0))
    return tables.withColumn("chi2", chi2).withColumn("p_value", normal_two_sided(F.sqrt("chi2")))


def welch_columns(stats: DataFrame) -> DataFrame:
    """Welch's t and its degrees of freedom."""
    c = F.col
    stats = stats.withColumns({"_va": c("var_a") / c("n_a"), "_vb": c("var_b") / c("n_b")})
    spread = c("_va") + c("_vb")
    parts = c("_va") * c("_va") / (c("n_a") - 1) + c("_vb") * c("_vb") / (c("n_b") - 1)
    return stats.withColumns(
        {
            "t_statistic": F.when(spread > 0, (c("mean_a") - c("mean_b")) / F.sqrt(spread)),
            "degrees": F.when(spread > 0, spread * spread / parts),
        }
    ).drop("_va", "_vb")


def z_test(stats: DataFrame) -> DataFrame:
    """Two-sample z test with the polynomial normal tail; 1.0 when neither group varies."""
    c = F.col
    rows = stats.filter(_enough())
    error = F.sqrt(c("var_a") / c("n_a") + c("var_b") / c("n_b"))
    z = F.when(error > 0, F.abs(c("mean_a") - c("mean_b")) / error)
    p = F.when(error > 0, normal_two_sided(z)).otherwise(F.lit(1.0))
    return rows.select(*PAIR, "n_a", "n_b", z.alias("z"), p.alias("p_value"))


def mann_whitney_columns(stats: DataFrame) -> DataFrame:
    """U of group A, the tie term, and the corrected normal deviate of the larger U."""
    c = F.col
    n_a, n_b = c("n_a").cast("double"), c("n_b").cast("double")
    n = n_a + n_b
    spread = n_a * n_b / 12 * ((n + 1) - c("tie_term") / (n * (n - 1)))
    larger = F.greatest(c("u_statistic"), n_a * n_b - c("u_statistic"))
    z = F.when(spread > 0, (larger - n_a * n_b / 2 - 0.5) / F.sqrt(spread))
    rows = stats.filter(_enough() & c("u_statistic").isNotNull())
    return rows.select(*PAIR, "n_a", "n_b", "u_statistic", "tie_term", z.alias("z"))


def ab_significance(samples: DataFrame) -> DataFrame:
    """The test that fits each metric, its p-value and whether it is below 5 %.

    Too few users: -1. All values 0 or 1: Fisher. Mean stay: Welch. Counts:
    Mann-Whitney. The comparison uses the unrounded p-value.
    """
    c = F.col
    test = (
        F.when(~_enough(), "none")
        .when(c("is_binary") == 1, "fisher")
        .when(c("metric_name") == MEAN_METRIC, "welch")
        .otherwise("mann_whitney")
    )
    stats = welch_columns(ab_test_stats(samples)).withColumn("test", test)
    # Rows of other tests pass harmless values, so each function runs once per batch.
    only = lambda kind, col, other: F.when(c("test") == kind, col).otherwise(F.lit(other))
    ones_a, ones_b = c("ones_a").cast("bigint"), c("ones_b").cast("bigint")
    tested = stats.withColumns(
        {
            "_fisher": fisher_p(
                only("fisher", ones_a, 0),
                only("fisher", c("n_a") - ones_a, 0),
                only("fisher", ones_b, 0),
                only("fisher", c("n_b") - ones_b, 0),
            ),
            "_welch": student_p(
                F.when(c("test") == "welch", c("t_statistic")), F.when(c("test") == "welch", c("degrees"))
            ),
            "_rank": mann_whitney_p(
                only("mann_whitney", c("u_statistic"), 0.0),
                only("mann_whitney", c("n_a"), 1),
                only("mann_whitney", c("n_b"), 1),
                only("mann_whitney", c("tie_term"), 0.0),
            ),
        }
    )
    p = (
        F.when(c("test") == "fisher", c("_fisher"))
        .when(c("test") == "welch", c("_welch"))
        .when(c("test") == "mann_whitney", c("_rank"))
    )
    raw = F.coalesce(p, F.lit(-1.0))
    return tested.withColumn("_p", raw).select(
        *PAIR,
        "n_a",
        "n_b",
        "test",
        F.when(c("_p") >= 0, half_up(c("_p"), 6)).otherwise(F.lit(-1.0)).alias("p_value"),
        ((c("_p") >= 0) & (c("_p") < LEVEL)).cast("int").alias("is_significant"),
    )


def apply_significance(results: DataFrame, tests: DataFrame) -> DataFrame:
    """The result rows with p-value and verdict; rows without a test keep theirs."""
    verdicts = tests.select(*PAIR, F.col("p_value").alias("_p"), F.col("is_significant").alias("_s"))
    joined = results.join(verdicts, PAIR, "left")
    return joined.withColumns(
        {
            "p_value": F.coalesce("_p", "p_value"),
            "is_significant": F.coalesce("_s", "is_significant"),
        }
    ).select(*results.columns)
