"""SQL twin of every feature query, keyed like the queries."""

from __future__ import annotations

from ebbtide.config import DEVICE_TYPES, GENRES, PRODUCTS, SEGMENT_PRODUCTS
from ebbtide.oracles.blocks import (
    ALL_GENRES, ALL_RELEASES, APP_TYPE, MIX_NAMES, NAMES, PRODUCT, RELEASES, T, TIME_NAMES,
    first_valid, lst, number, rounded, shown, with_tables)

STW = [f"stw_{w}" for w in range(15)]
DATES = ("min_date", "max_date", "max_feature_date", "last_week_start")
SHARES = [f"genre_share_{n}" for n in ALL_GENRES]
MATCH = [*[f"sched_match_index_{n}" for n in NAMES], "sched_match_index"]
SCALED = [f"scaled_releases_{n}" for n in ALL_RELEASES]
MIX_SHARES = [f"audio_prod_{n}_{m}_perc" for m in ("st", "ev") for n in MIX_NAMES]
DEVICE_SHARES = [f"device_{p}_{m}_{n}_perc"
                 for p in PRODUCTS for m in ("st", "ev") for n, _ in DEVICE_TYPES]
TREND = ["lin_reg_coeff", "13w_yintercept", "13w_xintercept"]
TRENDS = [f"{p}_{t}" for p in PRODUCTS for t in TREND]
LINE = ["beta_hat", "alpha_hat", "se2", "sb2", "sa2", "beta_lower", "beta_upper",
        "alpha_lower", "alpha_upper", "x_intercept"]


def factor_names(product: str, kind: str) -> list[str]:
    return [f"{product}_{kind}_f{i}" for i in range(20 if product == "audio" else 10)]


def feature_set_columns(product: str) -> list[str]:
    """Select list of the product's feature set."""
    audio = product == "audio"
    other = "video" if audio else "audio"
    columns: list[str] = [
        "t.user_id", "t.fresh", "CAST(t.target_week_start_date AS VARCHAR) AS"
        " target_week_start_date", "t.destination", "target_churn_this_week",
        "target_churn_next_week", "active_last_week", "train", "train_eligible", "t.cohort",
        "CASE WHEN enable_personalisation = 'true' THEN 1 ELSE 0 END"
        " AS profile_enablepersonalisation",
        "CASE WHEN mail_verified = 'true' THEN 1 ELSE 0 END AS profile_mailverified",
        "acc_age_days AS profile_acc_age_days",
        "CASE WHEN age BETWEEN 0 AND 120 THEN age END AS profile_age",
        *[f"{c} AS profile_{c}" for c in (
            "age_1634_enriched", "gender_enriched", "nation", "uk_flag", "barb_region",
            "acorn_type_description", "acorn_group_description", "acorn_category_description")],
        "w.streaming_time_13w", *[f"w.{c}" for c in STW], *[f"w.ew_{k}" for k in range(15)]]
    for p in PRODUCTS:
        columns += [f"{p}_user", f"{p}_active_last_week",
                    *[f"{rounded(f'{p}_{t}')} AS {p}_{t}" for t in TREND],
                    f"{p}_lin_reg_churn_flag"]
    if audio:
        columns += [f"coalesce(audio_prod_{m}_{n}, 0) AS audio_prod_{m}_{n}"
                    for m in ("st", "ev") for n in MIX_NAMES]
        columns += [f"coalesce({rounded(c)}, 0) AS {c}" for c in MIX_SHARES]
        columns += [f"coalesce({c}, 'Unknown') AS {c}" for c in (
            f"audio_prod_{m}_preferred_listening{d}"
            for m in ("st", "ev") for d in ("_detail", ""))]
    columns += [f"{rounded(f'genre_share_{n}')} AS genre_share_{n}" for n in NAMES]
    columns += ["genre_distinct_count", *[f"releases_{r}" for r in RELEASES]]
    columns += [f"{rounded(f'scaled_releases_{r}')} AS scaled_releases_{r}" for r in RELEASES]
    columns += [f"{rounded(c)} AS {c}" for c in MATCH]
    columns += [f"coalesce({c}, 0) AS lw_{c}" for c in (
        "distinct_series", "distinct_episodes", *([] if audio else ["series_premieres"]),
        "series_finales", "watched_finale_flag")]
    columns += [f"coalesce({rounded('avg_episode_repeats')}, 0) AS lw_avg_episode_repeats"]
    columns += [f"freq_seg_{p} AS freq_seg_latest_{p}" for p in SEGMENT_PRODUCTS]
    columns += ["audio_device_count", "video_device_count"]
    columns += [f"{rounded(c)} AS {c}" for c in DEVICE_SHARES if f"device_{product}_" in c]
    columns += [f"device_{p}_{m}_preferred" for m in ("st", "ev") for p in PRODUCTS]
    columns += [f"{rounded(c)} AS {c}" for c in factor_names(product, "activ")]
    columns += [f"{product}_weeks_since_activation", f"{product}_activating_genre",
                f"{product}_activating_masterbrand", f"{product}_fav_content_genre",
                f"{product}_fav_content_masterbrand"]
    columns += [f"{rounded(c)} AS {c}" for c in factor_names(product, "fav")]
    columns += [f"{other}_fav_content_genre", f"{other}_fav_content_masterbrand",
                "coalesce(mkt_opted_in, 0) AS mkt_opted_in", "mkt_days_opted_in",
                "mkt_days_opted_out"]
    columns += [f"coalesce(mkt_email_{k}_{p}, 0) AS mkt_email_{k}_{p}"
                for k in ("opens", "clicks") for p in ("lw", "13w")]
    columns += [f"coalesce({n}_{p}, 0) AS {n}_{p}" for n in (
        ["audio_subscribes", "audio_bookmarks"] if audio else ["video_programme_follows"])
        for p in ("13w", "lastweek")]
    columns += [f"{rounded('h.' + n)} AS {product}_{n}" for n in TIME_NAMES]
    return columns


def feature_set_names(product: str) -> list[str]:
    return [c.rsplit(" AS ", 1)[-1].strip().split(".")[-1] for c in feature_set_columns(product)]


def feature_set(product: str) -> str:
    audio = product == "audio"
    other = "video" if audio else "audio"

    def left(table: str, alias: str, condition: str = "") -> str:
        return (f"LEFT JOIN {table} {alias} ON {alias}.user_id = t.user_id "
                f"AND {alias}.fresh = t.fresh{condition}")

    own = f".destination = '{product}'"
    joins = [
        left("weeks_wide", "w", f" AND w{own}"), left(f"trend_{product}", "r"),
        left("match", "m", f" AND m{own}"), left("last_week", "l", f" AND l{own}"),
        left("frequency", "q"), left("devices", "v"), left(f"activation_{product}", "a"),
        left(f"favourite_{product}", "f"), left(f"favourite_{other}", "g"),
        left("optin", "o"), left("mail", "e"), left("follows", "u"),
        left("times", "h", f" AND h.product = '{product}'")]
    if audio:
        joins.append(left("mix", "x"))
    return f"""
SELECT {lst(feature_set_columns(product))}
FROM targets t
JOIN demographics p ON p.user_id = t.user_id AND p.fresh = t.fresh
{lst(joins, chr(10))}
WHERE t{own}"""


T["features_video"], T["features_audio"] = feature_set("video"), feature_set("audio")


def oracle_sql() -> dict[str, str]:
    sql = {
        "activity_scan": shown("scan", dates=["date_of_event"]),
        "destination_product": with_tables(
            f"SELECT destination, app_name, {PRODUCT} AS product, count(*) AS n "
            "FROM activity GROUP BY 1, 2, 3"),
        "activity_weekly_rollup": shown("weekly", dates=["week"]),
        "weekly_incremental": shown("weekly", dates=["week"]),
        "genre_conditional_sums": with_tables("SELECT device_type, " + lst(
            f"CAST(sum(CASE WHEN genre_names LIKE '{g[1]}%' THEN playback_time ELSE 0 END) "
            f"AS DOUBLE) AS genre_st_{g[0]}" for g in GENRES)
            + " FROM activity GROUP BY device_type"),
        "cohort_dates": with_tables(
            "SELECT d.* REPLACE (" + ", ".join(
                f"CAST(d.{c} AS VARCHAR) AS {c}" for c in (*DATES, "max_week"))
            + "), users FROM dates d LEFT JOIN (SELECT cohort, count(*) AS users FROM cohorts "
            "GROUP BY cohort) c ON c.cohort = d.cohort"),
        "cohort_assign": shown("cohorts", dates=DATES, drop=["max_week"]),
        "weekly_pivot": shown("weeks_wide"),
        "weekly_flags": with_tables(
            "SELECT user_id, destination, cohort, fresh, " + ", ".join(
                f"CASE WHEN ew_{w} > 0 THEN 1 ELSE 0 END AS aw_{w}" for w in range(15))
            + " FROM weeks_wide"),
        "linreg_13w": shown("linreg", doubles=LINE),
        "linreg_pivot": shown("trend", doubles=TRENDS),
        "churn_target": shown(
            "targets", dates=["target_week_start_date", "target_week_end_date"]),
        "genre_affinity": shown("affinity", doubles=SHARES),
        "genre_schedule": shown("schedule", dates=["week"]),
        "schedule_moving_average": shown("scaled", dates=["week"], doubles=SCALED),
        "schedule_match_index": shown("match", doubles=[*SHARES, *SCALED, *MATCH]),
        "windowed_activity": with_tables(
            "SELECT user_id, fresh, cohort, destination, "
            "CAST(date_of_event AS VARCHAR) AS date_of_event, version_id, playback_time, "
            "page_views FROM win"),
        "tleo_ladder": with_tables(f"""
SELECT {first_valid(["brand_id", "series_id", "episode_id", "clip_id"], ["N/A", "", "null"])}
    AS tleo_id,
  CASE WHEN brand_id NOT IN ('N/A', '', 'null') THEN 'brand_id'
    WHEN series_id NOT IN ('N/A', '', 'null') THEN 'series_id'
    WHEN episode_id NOT IN ('N/A', '', 'null') THEN 'episode_id'
    WHEN clip_id NOT IN ('N/A', '', 'null') THEN 'clip_id' END AS level, count(*) AS n
FROM activity GROUP BY 1, 2"""),
        "listening_type": with_tables(
            "SELECT * REPLACE (" + ", ".join(
                f"CAST(coalesce({c}, FALSE) AS INTEGER) AS {c}" for c in
                ("all_podcasts", "app_podcasts", "all_mixes", "app_mixes")) + ") FROM typed"),
        "product_mix": shown("mix", doubles=MIX_SHARES),
        "preferred_listening": with_tables(
            "SELECT user_id, fresh, " + ", ".join(
                f"audio_prod_{m}_preferred_listening{d}" for m in ("st", "ev")
                for d in ("", "_detail")) + " FROM mix"),
        "device_app_type": with_tables(
            f"SELECT device_type, browser_brand, {APP_TYPE} AS app_type, count(*) AS n "
            "FROM activity GROUP BY 1, 2, 3"),
        "device_counts": with_tables(
            "SELECT user_id, fresh, video_device_count, audio_device_count FROM devices"),
        "device_shares": shown(
            "device_parts", doubles=DEVICE_SHARES,
            drop=["video_device_count", "audio_device_count"]),
        "preferred_device": with_tables(
            "SELECT user_id, fresh, " + ", ".join(
                f"device_{p}_{m}_preferred" for p in PRODUCTS for m in ("st", "ev"))
            + " FROM devices"),
        "device_features": shown("devices", doubles=DEVICE_SHARES),
        "time_of_day_shares": shown("times", doubles=TIME_NAMES),
        "series_schedule": shown("episodes"),
        "series_finales": shown("finales"),
        "lastweek_series": shown("last_series"),
        "lastweek_repeats": shown("last_repeats", doubles=["avg_episode_repeats"]),
        "lastweek_features": shown("last_week", doubles=["avg_episode_repeats"]),
        "profile_demographics": shown("demographics"),
        "dedupe_anti_join": with_tables(
            "SELECT * EXCLUDE (is_repeated) REPLACE (CAST(created_date AS VARCHAR) AS "
            "created_date, CAST(age AS VARCHAR) AS age) FROM people WHERE NOT is_repeated"),
        "segment_pivot": shown("frequency"),
        "content_mode_genre": shown("contents"),
        "activation_asof": shown("activation_audio", dates=["activation_week"],
                                 doubles=factor_names("audio", "activ")),
        "activation_asof_video": shown("activation_video", dates=["activation_week"],
                                       doubles=factor_names("video", "activ")),
        "favourite_content": shown("favourite_audio", doubles=factor_names("audio", "fav")),
        "favourite_content_video": shown(
            "favourite_video", doubles=factor_names("video", "fav")),
        "marketing_optin": shown("optin", drop=["server_time"]),
        "marketing_activity": shown("mail"),
        "follow_counts": shown("follows"),
        "feature_set_assemble": shown("features_video"),
        "feature_set_assemble_audio": shown("features_audio"),
        "random_sample_n": with_tables(
            "SELECT event_id, user_id, event_type FROM events "
            f"ORDER BY {number('event_id', 'sample')}, event_id LIMIT 500"),
        "sample_with_replacement": with_tables(f"""
SELECT draw, event_id, user_id, event_type
FROM (SELECT d AS draw, {number("CAST(d AS VARCHAR)", "again-draw")} * n // 4294967296 + 1 AS r
      FROM range(700) t(d), (SELECT count(*) AS n FROM events))
JOIN (SELECT *, row_number() OVER (ORDER BY {number("event_id", "again")}, event_id) AS r
      FROM events) USING (r)"""),
        "train_population": with_tables(f"""
SELECT t.user_id, t.cohort, target_churn_next_week,
  CASE WHEN t.cohort = 0 THEN 'holdout' WHEN {number("t.user_id", "split")} % 4 = 0
    THEN 'private' ELSE 'public' END AS role
FROM targets t JOIN demographics p ON p.user_id = t.user_id AND p.fresh = t.fresh
WHERE t.destination = 'video' AND t.fresh = 0 AND active_last_week = 1
  AND train_eligible = 1"""),
        "stratified_folds": with_tables(f"""
SELECT row_id, label, CAST((row_number() OVER (PARTITION BY label
    ORDER BY {number("row_id", "fold")}, row_id) - 1) % 10 AS INTEGER) AS fold FROM scored"""),
        "score_sample_profile": with_tables(f"""
SELECT s.user_id, age, CASE WHEN age BETWEEN 16 AND 34 THEN 1 ELSE 0 END AS age_1634, gender,
  nation, acorn_category_description AS acorn_cat, acorn_category AS acorn_cat_num
FROM (SELECT user_id FROM cohorts WHERE fresh = 1
      ORDER BY {number("user_id", "score")}, user_id LIMIT 300) s
JOIN people p ON p.user_id = s.user_id LEFT JOIN extension e ON e.user_id = s.user_id"""),
        "dashboard_rollups": with_tables("""
SELECT CAST(target_week_start_date AS VARCHAR) AS week, target_churn_next_week, destination,
  count(*) AS users
FROM targets WHERE fresh = 0 AND active_last_week = 1 GROUP BY 1, 2, 3"""),
        "dashboard_rollups_predicted": with_tables(f"""
SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, 'video' AS destination,
  CASE WHEN event_type = 'purchase' THEN 'meta-learner' ELSE 'weak-learner' END AS learner_type,
  event_type AS learner_name, {rounded("sum(score)")} AS predicted_churn_raw,
  count(*) FILTER (score >= 0.5) AS predicted_churn_thresholded, count(*) AS users
FROM scored GROUP BY 1, 2, 3, 4"""),
        "expect_empty": with_tables("""
SELECT 'profile user ids' AS check_name,
  CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warning' END AS status, count(*) AS n,
  min('{"user_id":"' || user_id || '","n":2}') AS example FROM people WHERE is_repeated
UNION ALL
SELECT 'target keys', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END, count(*),
  min(user_id) FROM (SELECT user_id FROM targets GROUP BY user_id, fresh, destination
                     HAVING count(*) > 1)"""),
        "duplicate_key_check": with_tables(
            "SELECT user_id, CAST(2 AS BIGINT) AS n FROM people WHERE is_repeated"),
        "class_balance": with_tables(f"""
SELECT count(target_churn_next_week) AS size,
  CAST(sum(target_churn_next_week) AS BIGINT) AS positives,
  {rounded("avg(target_churn_next_week)")} AS density
FROM targets WHERE active_last_week = 1"""),
    }
    columns = [
        "user_id", "fresh", "enable_personalisation", "mail_verified", "acc_age_days",
        "train_eligible", "age", "age_range", "age_1634_enriched", "age_missing_flag",
        "age_1634_enriched_missing_flag", "gender", "gender_enriched", "gender_missing_flag",
        "gender_enriched_missing_flag", "nation", "uk_flag", "barb_region",
        "acorn_type_description", "acorn_group_description", "acorn_category_description"]
    sql["na_counts"] = with_tables(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null "
        "FROM demographics" for c in columns))
    flat = ["genre_share_comedy", "genre_share_sport", "genre_distinct_count",
            "genre_watch_drama", "distinct_days"]
    sql["invariate_columns"] = with_tables(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {rounded(f'var_pop({c})')} AS variance, "
        f"CASE WHEN count({c}) = 0 THEN 1 ELSE 0 END AS is_empty, "
        f"CASE WHEN count({c}) = 0 OR min({c}) = max({c}) THEN 1 ELSE 0 END AS \"drop\" "
        "FROM affinity" for c in flat))
    return sql

