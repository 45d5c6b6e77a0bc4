"""The test tables (orders, lineitem, part, customer, events, ...) seen as our sources.

Order history becomes viewing activity, parts become the content catalogue,
customers become profiles, and the event log becomes user actions and mail.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.config import ChurnConfig
from ebbtide.functions.exprs import week_of
from ebbtide.sources import schemas

MAX_DATE = date(2001, 7, 29)
EVENT_SHIFT_DAYS = (date(2024, 1, 28) - MAX_DATE).days

CONFIG = ChurnConfig(
    max_date=MAX_DATE,
    named_brands=tuple(f"Brand#{i}" for i in range(1, 16)),
    schedule_since=date(1995, 1, 1))

DEVICES = (("1-URGENT", "Desktop"), ("2-HIGH", "Smart TV"), ("3-MEDIUM", "Smartphone"),
           ("4-NOT SPECIFIED", "Tablet"), ("5-LOW", "Console"))
GENRE_NAMES = (("SMALL", "Comedy"), ("STANDARD", "Drama"), ("MEDIUM", "Music"),
               ("LARGE", "News;Factual"), ("ECONOMY", "Religion & Ethics"), ("PROMO", "Quiz"))
AGE_RANGES = ("16-19", "20-24", "25-29", "30-34", "35-39", "40-44", "55+")


def _choose(column: Column, pairs) -> Column:
    out = F
    for key, value in pairs:
        out = out.when(column == key, value)
    return out


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _series() -> Column:
    return F.when(F.col("p_size") % 7 == 0, "null").otherwise(_id("s", "p_size"))


def _brand() -> Column:
    return (F.when(F.col("p_brand") == "Brand#1", "null")
            .when(F.col("p_brand") == "Brand#2", "N/A").otherwise(F.col("p_brand")))


class SampleTables:
    """Source tables derived from one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _fit(self, name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in schemas.SOURCES[name]])

    @cached_property
    def activity(self) -> DataFrame:
        lines = self.table("lineitem")
        orders = self.table("orders")
        part = self.table("part")
        joined = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                  .join(part, F.col("l_partkey") == F.col("p_partkey")))
        return self._fit("activity", joined.select(
            F.col("o_custkey").alias("user_id"),
            F.when(F.col("l_linestatus") == "F", "VIDEO_APP").otherwise("AUDIO_APP")
            .alias("destination"),
            F.col("l_returnflag").alias("app_name"),
            F.col("o_orderpriority").alias("page_name"),
            F.col("o_orderdate").cast("date").alias("date_of_event"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey") % 24))
            .alias("event_ts"),
            _id("v", "l_partkey").alias("version_id"),
            _id("e", "l_partkey").alias("episode_id"),
            _series().alias("series_id"),
            _brand().alias("brand_id"),
            F.lit("null").alias("clip_id"),
            F.when(F.col("o_orderstatus") == "F", "Live").otherwise("On Demand")
            .alias("broadcast_type"),
            _choose(F.col("o_orderpriority"), DEVICES).alias("device_type"),
            F.when(F.col("l_linenumber") % 2 == 0, "Applications")
            .when(F.col("l_linenumber") % 5 != 0, "Chrome").alias("browser_brand"),
            _choose(F.col("p_type"), GENRE_NAMES).alias("genre_names"),
            ((F.col("l_quantity") - 1) * 60).alias("playback_time"),
            F.col("l_linenumber").alias("page_views")))

    @cached_property
    def catalogue(self) -> DataFrame:
        last = (self.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
                .agg(F.max("l_shipdate").cast("date").alias("tx")))
        key = F.col("p_partkey")
        return self._fit("catalogue", self.table("part").join(last, "p_partkey", "left").select(
            _id("v", "p_partkey").alias("version_id"),
            _id("e", "p_partkey").alias("episode_id"),
            _series().alias("series_id"),
            _brand().alias("brand_id"),
            F.when(key % 2 == 0, "video").otherwise("audio").alias("media_type"),
            F.when(F.col("p_brand") == "Brand#1", "null")
            .when(F.col("p_brand") == "Brand#2", "n/a")
            .otherwise(F.concat(F.lit("T "), "p_brand")).alias("brand_title"),
            F.when(F.col("p_size") % 7 == 0, "").otherwise(_id("S ", "p_size"))
            .alias("series_title"),
            F.col("p_name").alias("programme_title"),
            _id("E", "p_partkey").alias("episode_title"),
            F.lit(None).alias("presentation_title"),
            F.lit("null").alias("clip_title"),
            _choose(F.col("p_type"), GENRE_NAMES).alias("genre_names"),
            F.concat_ws(";", "p_type", "p_brand").alias("genre_list"),
            F.when((key % 13 == 0) | F.col("tx").isNull(), "null")
            .otherwise(F.col("tx").cast("string")).alias("tx_date"),
            F.when(key % 17 == 0, "null").otherwise(
                F.concat(F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":00:00")))
            .alias("tx_start"),
            F.col("p_size").alias("programme_duration"),
            F.when(F.col("p_size") % 5 == 0, "Podcast").when(F.col("p_size") % 5 == 1, "Mixes")
            .otherwise("Series").alias("format_names"),
            F.when(F.col("p_brand") == "Brand#20", "app_podcasts")
            .otherwise(F.lower("p_brand")).alias("master_brand_id"),
            F.when(F.col("p_brand") == "Brand#18", "App Mixes")
            .when(F.col("p_brand") == "Brand#19", "Radio")
            .when(F.col("p_brand").isin("Brand#16", "Brand#17"),
                  F.concat(F.lit("Local Radio "), "p_brand"))
            .otherwise(F.col("p_brand")).alias("master_brand_name"),
            F.when(key % 9 == 0, "Podcast version").otherwise("Original").alias("version_type"),
            F.when(key % 19 == 0, "clip").otherwise("episode").alias("content_kind")))

    @cached_property
    def podcast_list(self) -> DataFrame:
        return self.table("part").where(F.col("p_brand").isin("Brand#5", "Brand#6")).select(
            F.col("p_brand").alias("tleo_id")).distinct()

    def _episodes(self, step: int) -> DataFrame:
        return self.table("part").where(F.col("p_partkey") % step == 0).select(
            _id("e", "p_partkey").alias("episode_id"))

    @cached_property
    def mixes_list(self) -> DataFrame:
        return self._episodes(23)

    @cached_property
    def mix_exceptions(self) -> DataFrame:
        return self._episodes(29)

    @cached_property
    def profile(self) -> DataFrame:
        key = F.col("c_custkey")
        people = self.table("customer").select(
            key.alias("user_id"),
            (key % 3 == 0).cast("string").alias("enable_personalisation"),
            (key % 5 < 3).cast("string").alias("mail_verified"),
            F.when(key % 50 != 0, F.date_add(F.lit(MAX_DATE), -(key * 37 % 2000).cast("int")))
            .alias("created_date"),
            F.when(key % 10 != 0, key % 130 - 5).alias("age"),
            F.when(key % 2 == 1, "female").when(key % 4 == 2, "male").alias("gender"),
            F.when(F.col("c_nationkey") < 12, "GB").otherwise("FR").alias("location"),
            F.when(key % 41 == 0, "deleted").when(key % 97 != 0, "active").alias("status"))
        return self._fit("profile", people.unionByName(people.where(F.col("user_id") % 53 == 0)))

    @cached_property
    def profile_extension(self) -> DataFrame:
        key = F.col("c_custkey")
        ranges = F.array(*[F.lit(r) for r in AGE_RANGES])
        nation, region = self.table("nation"), self.table("region")
        joined = (self.table("customer").where(key % 8 != 0)
                  .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                  .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
        return self._fit("profile_extension", joined.select(
            key.alias("user_id"),
            F.when(key % 6 != 0, F.get(ranges, (key % 7).cast("int"))).alias("age_range"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("barb_region"),
            F.concat_ws(" ", "c_mktsegment", "r_name").alias("acorn_type_description"),
            F.col("c_mktsegment").alias("acorn_group_description"),
            F.concat(F.lit("Group "), F.col("n_regionkey").cast("string"))
            .alias("acorn_category_description"),
            (F.col("c_nationkey") % 6 + 1).alias("acorn_category")))

    @cached_property
    def gender_predictions(self) -> DataFrame:
        return self._fit("gender_predictions", self.table("customer").where(
            F.col("c_custkey") % 8 == 0).select(
            F.col("c_custkey").alias("user_id"),
            F.when(F.col("c_acctbal") < 5000, "male").otherwise("female")
            .alias("predicted_gender")))

    @cached_property
    def age_predictions(self) -> DataFrame:
        return self._fit("age_predictions", self.table("customer").where(
            F.col("c_custkey") % 3 == 0).select(
            F.col("c_custkey").alias("user_id"),
            F.when(F.col("c_acctbal") < 3000, "16-34").otherwise("35+").alias("predicted_age")))

    @cached_property
    def segments(self) -> DataFrame:
        low, status = F.col("o_orderpriority"), F.col("o_orderstatus")
        product = (F.when(low == "1-URGENT", "Video").when(low == "2-HIGH", "Audio")
                   .when(low == "3-MEDIUM", "News")
                   .when(low == "4-NOT SPECIFIED", F.when(status == "F", "Sport")
                         .when(status == "O", "Kids").otherwise("Preschool"))
                   .when(status == "F", "Weather").otherwise("All"))
        weekly = self.table("orders").groupBy(
            F.col("o_custkey").alias("user_id"), product.alias("product"),
            week_of(F.col("o_orderdate")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
        return self._fit("segments", weekly.select(
            "user_id", "product", F.date_add("week", 2).alias("date_of_segmentation"),
            F.when(F.col("n") >= 2, "A. Heavy").otherwise("B. Light").alias("segment")))

    def _activations(self, status: str) -> DataFrame:
        lines = self.table("lineitem").where(
            (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == status))
        return lines.join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user_id"),
            week_of(F.col("o_orderdate")).alias("week_beginning"),
            _id("e", "l_partkey").alias("episode_id"),
            _id("v", "l_partkey").alias("version_id"))

    @cached_property
    def audio_activations(self) -> DataFrame:
        return self._fit("audio_activations", self._activations("O"))

    @cached_property
    def video_activations(self) -> DataFrame:
        return self._fit("video_activations", self._activations("F"))

    def item_factors(self, product: str, n: int) -> DataFrame:
        key = F.col("vec_id")
        return self.table("embeddings").select(
            F.when(key <= 25, _id("Brand#", "vec_id"))
            .otherwise(F.concat(F.lit("s"), (key - 25).cast("string"))).alias("content_id"),
            *[F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(n)])

    @cached_property
    def _events(self) -> DataFrame:
        return self.table("events").withColumn(
            "at", (F.col("ts") - F.make_dt_interval(days=F.lit(EVENT_SHIFT_DAYS)))
            .cast("timestamp"))

    @cached_property
    def user_actions(self) -> DataFrame:
        kind = F.col("event_type")
        return self._fit("user_actions", self._events.select(
            "user_id", F.col("at").cast("date").alias("action_date"),
            F.when(kind.isin("click", "error"), "brand").when(kind == "view", "series")
            .when(kind == "signup", "episode").otherwise("track").alias("resource_type"),
            F.when(kind.isin("click", "view", "error"), "FOLLOWS").otherwise("FAVOURITES")
            .alias("activity_type"),
            F.when(kind == "click", "tv").when(kind.isin("view", "purchase"), "music")
            .otherwise("radio").alias("resource_domain")))

    @cached_property
    def newsletter_actions(self) -> DataFrame:
        return self._fit("newsletter_actions", self._events.where(
            F.col("event_type").isin("signup", "error")).select(
            "user_id", F.col("at").cast("date").alias("action_date"),
            F.col("at").alias("server_time"),
            F.when(F.col("event_type") == "signup", "followed").otherwise("unfollowed")
            .alias("action"),
            F.lit("Follows").alias("activity_type"), F.lit("newsletter").alias("resource_type"),
            F.lit("profile").alias("resource_domain"),
            F.when(F.col("event_id") % 2 == 0, "main").otherwise("other").alias("resource_id")))

    def _mail(self, kind: str) -> DataFrame:
        return self._events.where(F.col("event_type") == kind).select(
            "user_id", (F.col("event_id") % 40).alias("send_id"), F.col("at").alias("event_ts"))

    @cached_property
    def email_opens(self) -> DataFrame:
        return self._fit("email_opens", self._mail("view"))

    @cached_property
    def email_clicks(self) -> DataFrame:
        return self._fit("email_clicks", self._mail("click"))

    @cached_property
    def _scores(self) -> DataFrame:
        score = 1 / (1 + F.exp(-(F.col("value") - 50) / 50))
        return self.table("events").withColumn("score", F.round(score, 4))

    @cached_property
    def scored(self) -> DataFrame:
        """Labelled scores for the metric operators."""
        return self._scores.select(
            F.col("event_id").alias("row_id"),
            (F.col("event_type") == "purchase").cast("int").alias("label"), "score",
            (F.col("event_id") % 5).cast("int").alias("fold"))

    @cached_property
    def score_history(self) -> DataFrame:
        """Score records, one learner per event type."""
        meta = F.col("event_type") == "purchase"
        return self._scores.select(
            F.col("user_id").cast("string").alias("user_id"),
            week_of(F.col("ts")).alias("target_week_start_date"),
            F.when(meta, "meta-learner").otherwise("weak-learner").alias("learner_type"),
            F.col("event_type").alias("learner_name"),
            F.col("score").alias("predicted_probability"),
            F.lit(0.5).alias("optimal_threshold"),
            (F.col("score") >= 0.5).cast("int").alias("optimal_classification"),
            F.col("ts").cast("timestamp").alias("score_datetime"))

    @cached_property
    def explained(self) -> DataFrame:
        """Attributions of three features, one learner per event type, with their inputs."""
        parts = ("array(struct('level' AS feature, score AS input_value, "
                 "round(score - 0.5, 4) AS value), "
                 "struct('early' AS feature, CAST(event_id % 24 AS DOUBLE) AS input_value, "
                 "round((0.3 - score) * (event_id % 3), 4) AS value), "
                 "struct('turn' AS feature, CAST(event_id % 5 AS DOUBLE) AS input_value, "
                 "(event_id % 5 - 2) / 10D AS value))")
        rows = self._scores.withColumn("target_week_start_date", week_of(F.col("ts")))
        return rows.selectExpr(
            "event_type AS learner", "CAST(event_id AS STRING) AS user_id",
            "target_week_start_date", "CAST(event_id % 5 AS INT) AS fold", f"inline({parts})")

    @cached_property
    def predicted(self) -> DataFrame:
        """Wide predictions of two learners and the meta-learner."""
        meta = 0.5 * F.col("score") + 0.25
        return self._scores.select(
            F.col("event_id").cast("string").alias("user_id"),
            week_of(F.col("ts")).alias("target_week_start_date"),
            F.col("score").alias("p_Up"), (1 - F.col("score")).alias("p_Down"),
            meta.alias("p_meta"), (F.col("score") >= 0.5).cast("int").alias("class_Up"),
            (1 - F.col("score") >= 0.4).cast("int").alias("class_Down"),
            (meta >= 0.6).cast("int").alias("class_meta"))
