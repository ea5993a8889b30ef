"""Maps the generic ``events`` table to behaviour events, with the dirt the cleaning must handle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.expressions import assign_variant
from footfall.schema import BEHAVIOR_EVENT

RAW_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def read_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream; the glob takes a single file or a folder of parts."""
    return spark.readStream.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parquet*")


def behavior_events(raw: DataFrame) -> DataFrame:
    """The 18-column event log (batch or streaming), about 5 % of it newer copies.

    Copies come from ``explode``, not from a union, so the table is scanned once.
    """
    k = F.col("k")
    uid = F.col("uid")
    eid = F.col("eid")
    text = lambda c: c.cast("string")
    user_key = F.concat(F.lit("user_"), F.lpad(text(uid), 6, "0"))
    app = F.concat(
        F.lit('{"app_id":"app_'), text(k % 25), F.lit('","app_name":"App'), text(k % 25)
    )
    base = raw.select(
        F.col("event_id").alias("eid"),
        F.col("ts").cast("timestamp").alias("at"),
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("kind"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(F.col("event_id") % 10 == 9, "")
        .when(F.col("event_id") % 2 == 0, "exp_001_home_rec_algo")
        .otherwise("exp_002_search_ranking")
        .alias("exp"),
        F.explode(
            F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("dup"),
    )
    kind = F.col("kind")
    a_share = F.when(F.col("exp") == "exp_001_home_rec_algo", 50).otherwise(60)
    return base.select(
        F.concat(F.lit("evt_"), text(eid)).alias("event_id"),
        F.when(kind == "view", F.when(k < 70, "page_view").otherwise("ad_impression"))
        .when(kind == "click", F.when(k < 60, "app_click").otherwise("ad_click"))
        .when(kind == "signup", "app_install")
        .when(kind == "purchase", F.when(k < 80, "app_download").otherwise("in_app_purchase"))
        .otherwise(F.when(k < 50, "search_query").otherwise("error"))
        .alias("event_type"),
        F.when(eid % 97 == 1, "")
        .when(eid % 89 == 1, "null")
        .when(eid % 83 == 1, F.lit(None))
        .otherwise(user_key)
        .alias("user_id"),
        F.concat(F.lit("device_"), F.lpad(text(uid * 3 % 97), 6, "0")).alias("device_id"),
        F.col("at").alias("event_time"),
        F.timestamp_add("SECOND", F.col("dup"), F.col("at")).alias("server_time"),
        F.when(eid % 17 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("Model "), text((uid + k) % 7)))
        .alias("device_model"),
        F.concat(F.lit("Android "), text(10 + uid % 5)).alias("os_version"),
        F.when(k % 3 == 0, "8.7.0").when(k % 3 == 1, "8.6.3").otherwise("8.5.0").alias("app_version"),
        F.lit("").alias("session_id"),
        F.when(k % 7 == 0, "home")
        .when(k % 7 == 1, "search")
        .when(k % 7 == 2, "category")
        .when(k % 7 == 3, "ranking")
        .when(k % 7 == 4, "detail")
        .when(k % 7 == 5, "download")
        .otherwise("mine")
        .alias("page"),
        F.concat(F.lit("10.0."), text(uid % 256), F.lit("."), text(k)).alias("ip"),
        F.when(F.col("dup") == 1, "广州")
        .when(eid % 13 == 0, "")
        .when(uid % 5 == 0, "北京")
        .when(uid % 5 == 1, "上海")
        .when(uid % 5 == 2, "深圳")
        .when(uid % 5 == 3, "成都")
        .otherwise("武汉")
        .alias("city"),
        F.when(eid % 31 == 0, F.lit(None))
        .otherwise(F.floor(F.col("value") * 100))
        .cast("int")
        .alias("duration"),
        F.when((kind == "purchase") & (k < 80) & (k % 25 == 24), '{"download_source":"search"}')
        .when(
            kind.isin("purchase", "signup"),
            F.concat(app, F.lit('","app_category":"Cat'), text(k % 5), F.lit('"}')),
        )
        .when(kind == "click", F.concat(app, F.lit('","position":'), text(1 + k % 20), F.lit("}")))
        .when(kind == "error", F.concat(F.lit('{"keyword":"kw'), text(k % 24), F.lit('"}')))
        .otherwise("{}")
        .alias("properties"),
        F.lit("simulator").alias("source"),
        F.col("exp").alias("experiment_id"),
        F.when(F.col("exp") == "", "")
        .otherwise(assign_variant(user_key, F.col("exp"), a_share))
        .alias("variant"),
    ).select(*BEHAVIOR_EVENT.fieldNames())


def ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior_events(read_raw_events(spark, sf_dir))


def ods_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior_events(stream_raw_events(spark, sf_dir))
