"""The feature set of one product: every block joined to the churn target.

Blocks are aggregated to (user, fresh) before the join, so no join input has a
repeated key, however uneven the raw logs are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, functions as F, types as T

from ebbtide.config import GENRES, PIVOT_WEEKS, PRODUCTS, SEGMENT_PRODUCTS, ChurnConfig
from ebbtide.functions.skew import stable
from ebbtide.operators import (
    activity, cohorts, content, devices, genre, last_week, logs, product_mix, profile, target,
    time_of_day)

KEY = ["user_id", "fresh"]


class Blocks:
    """Lazily built feature blocks over a set of sources.

    With ``stage`` the tables that several blocks read are written once to the
    checkpoint folder: the activity of the extract, the catalogue, the weekly and
    daily roll-ups and the content table, none larger than what it comes from. With a ``WeeklyState`` the roll-ups are those it keeps.
    """

    def __init__(self, sources, cfg: ChurnConfig, *, stage: bool = False, state=None):
        self.sources, self.cfg, self.stage, self.state = sources, cfg, stage, state

    def _shared(self, df: DataFrame) -> DataFrame:
        return stable(df) if self.stage else df

    @cached_property
    def scan(self) -> DataFrame:
        return self._shared(activity.activity_scan(self.sources.activity, self.cfg))

    @cached_property
    def catalogue(self) -> DataFrame:
        return self._shared(self.sources.catalogue)

    @cached_property
    def weekly(self) -> DataFrame:
        if self.state is not None:
            return self.state.weekly(self.sources.activity)
        return self._shared(activity.activity_weekly_rollup(self.scan, self.cfg))

    @cached_property
    def cohorts(self) -> DataFrame:
        return cohorts.cohort_assign(self.scan, self.cfg)

    @cached_property
    def pivot(self) -> DataFrame:
        return target.weekly_pivot(self.weekly, self.cfg)

    @cached_property
    def linreg(self) -> DataFrame:
        return target.linreg_13w(self.pivot)

    @cached_property
    def targets(self) -> DataFrame:
        return target.churn_target(self.pivot, self.cfg)

    @cached_property
    def affinity(self) -> DataFrame:
        return genre.genre_affinity(self.weekly, self.cfg)

    @cached_property
    def schedule(self) -> DataFrame:
        return genre.genre_schedule(self.catalogue)

    @cached_property
    def scaled_schedule(self) -> DataFrame:
        return genre.schedule_moving_average(self.schedule, self.cfg)

    @cached_property
    def schedule_match(self) -> DataFrame:
        return genre.schedule_match_index(
            self.affinity, self.schedule, self.scaled_schedule, self.cfg)

    @cached_property
    def daily(self) -> DataFrame:
        """What the windowed blocks read: the daily roll-up if kept or staged, else the activity."""
        if self.state is not None:
            return self.state.daily(self.sources.activity)
        if not self.stage:
            return self.sources.activity
        return stable(activity.daily_activity(self.scan, self.cfg))  # its days are in the extract

    @cached_property
    def windowed(self) -> DataFrame:
        return activity.windowed_activity(self.daily, self.cfg)

    @cached_property
    def listening(self) -> DataFrame:
        s = self.sources
        return product_mix.listening_type(
            product_mix.audio_listening(self.windowed, self.cfg), self.catalogue, s.podcast_list,
            s.mixes_list, s.mix_exceptions, self.cfg)

    @cached_property
    def product_mix(self) -> DataFrame:
        return product_mix.product_mix(self.listening)

    @cached_property
    def device_usage(self) -> DataFrame:
        return devices.device_usage(self.windowed, self.cfg)

    @cached_property
    def device_features(self) -> DataFrame:
        return devices.device_features(self.device_usage)

    @cached_property
    def series_schedule(self) -> DataFrame:
        return last_week.series_schedule(self.catalogue)

    @cached_property
    def series_finales(self) -> DataFrame:
        return last_week.series_finales(self.series_schedule)

    @cached_property
    def lastweek_views(self) -> DataFrame:
        return last_week.lastweek_views(self.daily, self.cfg)

    @cached_property
    def lastweek_series(self) -> DataFrame:
        return last_week.lastweek_series(
            self.lastweek_views, self.catalogue, self.series_finales)

    @cached_property
    def lastweek_repeats(self) -> DataFrame:
        return last_week.lastweek_repeats(self.lastweek_views, self.catalogue)

    @cached_property
    def lastweek_features(self) -> DataFrame:
        return last_week.lastweek_features(self.lastweek_series, self.lastweek_repeats)

    def time_of_day(self, product: str | None = None) -> DataFrame:
        return time_of_day.time_of_day_shares(self.windowed, self.cfg, product)

    def factors(self, product: str) -> DataFrame:
        return self.sources.item_factors(product, self.cfg.factors[product])

    @cached_property
    def contents(self) -> DataFrame:
        return self._shared(content.content_mode_genre(self.catalogue, self.cfg))

    def activation(self, product: str, users: DataFrame | None = None) -> DataFrame:
        return content.activation_asof(
            getattr(self.sources, f"{product}_activations"), self.catalogue,
            self.contents, self.factors(product), self.cfg, product, users)

    @cached_property
    def favourite_pick(self) -> DataFrame:
        return content.favourite_pick(self.windowed, self.cfg)

    def favourite(self, product: str) -> DataFrame:
        mine = self.favourite_pick.select(
            "user_id", "fresh", f"{product}_fav_content_id", f"{product}_fav_content_level")
        return content.favourite_content(
            mine.where(F.col(f"{product}_fav_content_id").isNotNull()), self.contents,
            self.factors(product), self.cfg, product)

    def favourites(self) -> DataFrame:
        """Favourites of both products from one pass over the activity."""
        out = self.favourite_pick
        for product in PRODUCTS:
            out = content.favourite_content(
                out, self.contents, self.factors(product), self.cfg, product)
        return out

    def demographics(self, users: DataFrame | None = None) -> DataFrame:
        s = self.sources
        return profile.profile_demographics(
            s.profile, s.profile_extension, s.gender_predictions, s.age_predictions, self.cfg,
            users)

    def segments(self, users: DataFrame | None = None) -> DataFrame:
        return logs.segment_pivot(self.sources.segments, self.cfg, users)

    def optin(self, users: DataFrame | None = None) -> DataFrame:
        return logs.marketing_optin(self.sources.newsletter_actions, self.cfg, users)

    def mail(self, users: DataFrame | None = None) -> DataFrame:
        return logs.marketing_activity(
            self.sources.email_opens, self.sources.email_clicks, self.cfg, users)

    def follows(self, users: DataFrame | None = None) -> DataFrame:
        return logs.follow_counts(self.sources.user_actions, self.cfg, users)

    def feature_set(self, product: str) -> DataFrame:
        return feature_set_assemble(self, product)


def _flag(column: str) -> str:
    return f"coalesce(CAST({column} = 'true' AS INT), 0)"


def _zero(column: str, name: str | None = None) -> str:
    return f"coalesce({column}, 0) AS {name or column}"


def _base(blocks: Blocks, product: str) -> DataFrame:
    """Target, weekly columns and trends of both products, keyed (user, fresh).

    All of it comes from one weekly pivot: the trend and the target are row
    expressions on it, and one aggregation puts the two products side by side.
    """
    weeks = ["streaming_time_13w", *[f"stw_{w}" for w in PIVOT_WEEKS],
             *[f"ew_{w}" for w in PIVOT_WEEKS]]
    both = target.linreg_pivot(blocks.linreg, blocks.cfg, product, ["cohort", *weeks])
    trends = [c for c in both.columns if c not in ("user_id", "fresh", "cohort", *weeks)]
    mine = both.where(F.col(f"{product}_user") == 1).withColumn("destination", F.lit(product))
    return target.churn_target(mine, blocks.cfg, keep=[*weeks, *trends])


def feature_columns(product: str) -> list[str]:
    """The output contract of the product's feature set, in order."""
    audio = product == "audio"
    other = "video" if audio else "audio"
    factors = range(20 if audio else 10)
    trend = ["user", "active_last_week", "lin_reg_coeff", "13w_yintercept", "13w_xintercept",
             "lin_reg_churn_flag"]
    columns = [
        "user_id", "fresh", "target_week_start_date", "destination",
        "target_churn_this_week", "target_churn_next_week", "active_last_week", "train",
        "train_eligible", "cohort",
        f"{_flag('enable_personalisation')} AS profile_enablepersonalisation",
        f"{_flag('mail_verified')} AS profile_mailverified",
        "acc_age_days AS profile_acc_age_days",
        "CASE WHEN age BETWEEN 0 AND 120 THEN age END AS profile_age",
        *[f"{c} AS profile_{c}" for c in (
            "age_1634_enriched", "gender_enriched", "nation", "uk_flag", "barb_region",
            "acorn_type_description", "acorn_group_description", "acorn_category_description")],
        "streaming_time_13w",
        *[f"stw_{w}" for w in PIVOT_WEEKS], *[f"ew_{w}" for w in PIVOT_WEEKS],
        *[f"{p}_{t}" for p in PRODUCTS for t in trend],
    ]
    if audio:
        names = [n for n, _ in product_mix.LISTENING_DETAIL]
        names += [n for n, _, _ in product_mix.LISTENING_COARSE]
        columns += [_zero(f"audio_prod_{m}_{n}") for m in ("st", "ev") for n in names]
        columns += [_zero(f"audio_prod_{n}_{m}_perc") for m in ("st", "ev") for n in names]
        columns += [f"coalesce({c}, 'Unknown') AS {c}" for c in (
            f"audio_prod_{m}_preferred_listening{d}"
            for m in ("st", "ev") for d in ("_detail", ""))]
    columns += [
        *[f"genre_share_{g[0]}" for g in GENRES], "genre_distinct_count",
        *[f"releases_{g[2]}" for g in GENRES], *[f"scaled_releases_{g[2]}" for g in GENRES],
        *[f"sched_match_index_{g[0]}" for g in GENRES], "sched_match_index",
        *[_zero(c, f"lw_{c}") for c in (
            "distinct_series", "distinct_episodes", *([] if audio else ["series_premieres"]),
            "series_finales", "watched_finale_flag", "avg_episode_repeats")],
        *[f"coalesce(freq_seg_{p}, '{logs.SEGMENT_DEFAULT}') AS freq_seg_latest_{p}"
          for p in SEGMENT_PRODUCTS],
        "audio_device_count", "video_device_count",
        *[f"device_{product}_{m}_{n}_perc" for m in ("st", "ev") for n, _ in
          devices.DEVICE_TYPES],
        *[f"device_{p}_{m}_preferred" for m in ("st", "ev") for p in PRODUCTS],
        *[f"{product}_activ_f{i}" for i in factors],
        *[f"{product}_{c}" for c in (
            "weeks_since_activation", "activating_genre", "activating_masterbrand",
            "fav_content_genre", "fav_content_masterbrand")],
        *[f"{product}_fav_f{i}" for i in factors],
        f"{other}_fav_content_genre", f"{other}_fav_content_masterbrand",
        _zero("mkt_opted_in"), "mkt_days_opted_in", "mkt_days_opted_out",
        *[_zero(f"mkt_email_{k}_{w}") for k in ("opens", "clicks") for w in ("lw", "13w")],
        *[_zero(f"{n}_{w}") for n in (
            ["audio_subscribes", "audio_bookmarks"] if audio else ["video_programme_follows"])
          for w in ("13w", "lastweek")],
        *[f"{c} AS {product}_{c}" for c in (
            *[f"tod_{n}" for n, _, _ in time_of_day.HOUR_BANDS],
            *[f"dow_{n}" for n in time_of_day.WEEKDAYS])],
    ]
    return columns


def _may_be_null(first: Sequence[DataFrame], further: Sequence[DataFrame],
                 expressions: Sequence[str]) -> set[str]:
    """The columns that expressions without a default name; a left join may leave any empty."""
    fields = {f.name: f for df in first for f in df.schema}
    fields |= {f.name: T.StructField(f.name, f.dataType) for df in further for f in df.schema
               if f.name not in KEY}
    known = first[0].sparkSession.createDataFrame([], T.StructType([*fields.values()]))
    return {word for field, text in zip(known.selectExpr(*expressions).schema, expressions)
            if field.nullable for word in re.findall(r"\w+", text)}


def join_packed(first: Sequence[DataFrame], further: Sequence[DataFrame],
                expressions: Sequence[str]) -> DataFrame:
    """Inner join of ``first``, left joins to ``further``, then the expressions.

    Each table travels as a struct of the columns that the expressions name, so a join copies
    a few packed values of a row, not its hundreds of columns again for every table. Columns
    behind a default travel in a second struct: counting nulls reads none of them, and Spark
    would unpack a struct of which only some columns are read below all joins.
    """
    used = set(re.findall(r"\w+", " ".join(expressions))) - set(KEY)
    open_ended = _may_be_null(first, further, expressions)
    parts = []

    def packed(df: DataFrame) -> DataFrame:
        names = [c for c in df.columns if c in used]
        halves = [[c for c in names if c in open_ended], [c for c in names if c not in open_ended]]
        mine = {f"_part{len(parts) + i}": F.struct(*half)
                for i, half in enumerate(filter(None, halves))}
        parts.extend(mine)
        return df.select(*KEY, *[c.alias(n) for n, c in mine.items()])

    tables = [packed(df) for df in [*first, *further]]
    out = tables[0]
    for i, table in enumerate(tables[1:], 1):
        out = out.join(table, KEY, "inner" if i < len(first) else "left")
    return out.select(*KEY, *[f"{p}.*" for p in parts]).selectExpr(*expressions)


def feature_set_assemble(blocks: Blocks, product: str) -> DataFrame:
    """(user, fresh) rows of the product's users that have a profile, about 200 columns."""
    own = F.col("destination") == product
    drop = ["destination", "cohort"]
    parts = [
        blocks.schedule_match.where(own).drop(*drop, "events", "streaming_time"),
        blocks.lastweek_features.where(own).drop("destination"),
        blocks.segments(),
        blocks.device_features,
        blocks.activation(product),
        blocks.favourites(),
        blocks.optin(), blocks.mail(), blocks.follows(),
        blocks.time_of_day(product),
    ]
    if product == "audio":
        parts.append(blocks.product_mix)
    return join_packed(
        [_base(blocks, product), blocks.demographics()], parts, feature_columns(product))
