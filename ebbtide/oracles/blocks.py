"""The feature blocks once more, as plain SQL over the test tables.

Independent of the Spark code on purpose: cohorts are joined as a table, days
are counted with count(distinct), top-1 picks use row_number.
Each entry is one common table expression; ``with_tables`` adds those a query needs.
"""

from __future__ import annotations

import re

from ebbtide.config import (
    DEVICE_TYPES, FOLLOW_RULES, GENRES, HOUR_BANDS, LISTENING_COARSE, LISTENING_DETAIL, PRODUCTS,
    SEGMENT_PRODUCTS, WEEKDAYS)
from ebbtide.sources.sample_tables import CONFIG, EVENT_SHIFT_DAYS

M = f"DATE '{CONFIG.max_date}'"
WEEKS = range(15)
FEATURES = range(2, 15)


def cases(column: str, pairs, otherwise: str | None = None) -> str:
    arms = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {arms}{f' ELSE {otherwise}' if otherwise else ''} END"


def number(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5({key} || '{salt}'), 1, 8) AS BIGINT)"


def week(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def ratio(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN CAST({part} AS DOUBLE) / {total} ELSE 0.0::DOUBLE END"


def best(pairs) -> str:
    """Label of the greatest value; the first listed wins a tie."""
    top = "greatest(" + ", ".join(c for c, _ in pairs) + ")"
    return "CASE " + " ".join(f"WHEN {c} = {top} THEN '{label}'" for c, label in pairs) + " END"


def lst(items, sep=",\n  ") -> str:
    return sep.join(items)


def first_valid(columns, sentinels) -> str:
    return "coalesce(" + ", ".join(
        f"CASE WHEN {c} NOT IN {in_list(sentinels)} THEN {c} END" for c in columns) + ")"


TITLE = first_valid(
    ["brand_title", "series_title", "programme_title", "episode_title", "presentation_title",
     "clip_title"], ["n/a", "", "null"])
GENRE_CASE = cases("p_type", [
    ("SMALL", "Comedy"), ("STANDARD", "Drama"), ("MEDIUM", "Music"), ("LARGE", "News;Factual"),
    ("ECONOMY", "Religion & Ethics"), ("PROMO", "Quiz")])
SERIES = "CASE WHEN p_size % 7 = 0 THEN 'null' ELSE 's' || p_size END"
BRAND = "CASE p_brand WHEN 'Brand#1' THEN 'null' WHEN 'Brand#2' THEN 'N/A' ELSE p_brand END"
NAMES = [g[0] for g in GENRES]
RELEASES = [g[2] for g in GENRES]

T: dict[str, str] = {}

# ---- sources -------------------------------------------------------------

T["activity"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS user_id,
  CASE WHEN l_linestatus = 'F' THEN 'VIDEO_APP' ELSE 'AUDIO_APP' END AS destination,
  l_returnflag AS app_name, CAST(o_orderdate AS DATE) AS date_of_event,
  CAST(o_orderkey % 24 AS INTEGER) AS hour_of_event,
  'v' || l_partkey AS version_id, 'e' || l_partkey AS episode_id,
  {SERIES} AS series_id, {BRAND} AS brand_id, 'null' AS clip_id,
  CASE WHEN o_orderstatus = 'F' THEN 'Live' ELSE 'On Demand' END AS broadcast_type,
  {cases("o_orderpriority", [("1-URGENT", "Desktop"), ("2-HIGH", "Smart TV"),
                             ("3-MEDIUM", "Smartphone"), ("4-NOT SPECIFIED", "Tablet"),
                             ("5-LOW", "Console")])} AS device_type,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Applications'
       WHEN l_linenumber % 5 <> 0 THEN 'Chrome' END AS browser_brand,
  {GENRE_CASE} AS genre_names,
  CAST((l_quantity - 1) * 60 AS BIGINT) AS playback_time,
  CAST(l_linenumber AS BIGINT) AS page_views
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

T["catalogue"] = f"""
SELECT 'v' || p_partkey AS version_id, 'e' || p_partkey AS episode_id,
  {SERIES} AS series_id, {BRAND} AS brand_id,
  CASE WHEN p_partkey % 2 = 0 THEN 'video' ELSE 'audio' END AS media_type,
  CASE p_brand WHEN 'Brand#1' THEN 'null' WHEN 'Brand#2' THEN 'n/a'
    ELSE 'T ' || p_brand END AS brand_title,
  CASE WHEN p_size % 7 = 0 THEN '' ELSE 'S ' || p_size END AS series_title,
  p_name AS programme_title, 'E' || p_partkey AS episode_title,
  CAST(NULL AS VARCHAR) AS presentation_title, 'null' AS clip_title,
  {GENRE_CASE} AS genre_names, p_type || ';' || p_brand AS genre_list,
  CASE WHEN p_partkey % 13 = 0 OR tx IS NULL THEN 'null'
    ELSE CAST(tx AS VARCHAR) END AS tx_date,
  CASE WHEN p_partkey % 17 = 0 THEN 'null'
    ELSE lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') || ':00:00' END AS tx_start,
  CASE WHEN p_size % 5 = 0 THEN 'Podcast' WHEN p_size % 5 = 1 THEN 'Mixes'
    ELSE 'Series' END AS format_names,
  CASE WHEN p_brand = 'Brand#20' THEN 'app_podcasts' ELSE lower(p_brand) END AS master_brand_id,
  CASE WHEN p_brand = 'Brand#18' THEN 'App Mixes' WHEN p_brand = 'Brand#19' THEN 'Radio'
    WHEN p_brand IN ('Brand#16', 'Brand#17') THEN 'Local Radio ' || p_brand
    ELSE p_brand END AS master_brand_name,
  CASE WHEN p_partkey % 9 = 0 THEN 'Podcast version' ELSE 'Original' END AS version_type,
  CASE WHEN p_partkey % 19 = 0 THEN 'clip' ELSE 'episode' END AS content_kind
FROM part LEFT JOIN (SELECT l_partkey, CAST(max(l_shipdate) AS DATE) AS tx
                     FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey"""

T["people"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END AS enable_personalisation,
  CASE WHEN c_custkey % 5 < 3 THEN 'true' ELSE 'false' END AS mail_verified,
  CASE WHEN c_custkey % 50 <> 0
    THEN {M} - CAST(c_custkey * 37 % 2000 AS INTEGER) END AS created_date,
  CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey % 130 - 5 AS INTEGER) END AS age,
  CASE WHEN c_custkey % 2 = 1 THEN 'female' WHEN c_custkey % 4 = 2 THEN 'male' END AS gender,
  CASE WHEN c_nationkey < 12 THEN 'GB' ELSE 'FR' END AS location,
  CASE WHEN c_custkey % 41 = 0 THEN 'deleted' WHEN c_custkey % 97 <> 0 THEN 'active' END
    AS status,
  c_custkey % 53 = 0 AS is_repeated
FROM customer"""

T["extension"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_custkey % 6 <> 0 THEN
    ['16-19', '20-24', '25-29', '30-34', '35-39', '40-44', '55+'][c_custkey % 7 + 1] END
    AS age_range,
  n_name AS nation, r_name AS barb_region, c_mktsegment || ' ' || r_name
    AS acorn_type_description,
  c_mktsegment AS acorn_group_description, 'Group ' || n_regionkey AS acorn_category_description,
  c_nationkey % 6 + 1 AS acorn_category
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_custkey % 8 <> 0"""

T["genders"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_acctbal < 5000 THEN 'male' ELSE 'female' END AS predicted_gender
FROM customer WHERE c_custkey % 8 = 0"""

T["ages"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_acctbal < 3000 THEN '16-34' ELSE '35+' END AS predicted_age
FROM customer WHERE c_custkey % 3 = 0"""

T["segments"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS user_id, {week("o_orderdate")} AS seg_week,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'video' WHEN '2-HIGH' THEN 'audio'
    WHEN '3-MEDIUM' THEN 'news'
    WHEN '4-NOT SPECIFIED' THEN
      CASE o_orderstatus WHEN 'F' THEN 'sport' WHEN 'O' THEN 'kids' ELSE 'preschool' END
    ELSE CASE o_orderstatus WHEN 'F' THEN 'weather' ELSE 'all' END END AS product,
  CASE WHEN count(*) >= 2 THEN 'A. Heavy' ELSE 'B. Light' END AS segment
FROM orders GROUP BY 1, 2, 3"""

for _product, _status in (("video", "F"), ("audio", "O")):
    T[f"activations_{_product}"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS user_id, {week("o_orderdate")} AS week_beginning,
  'e' || l_partkey AS episode_id, 'v' || l_partkey AS version_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'A' AND l_linestatus = '{_status}'"""

T["factors"] = f"""
SELECT CASE WHEN vec_id <= 25 THEN 'Brand#' || vec_id ELSE 's' || (vec_id - 25) END AS content_id,
  {lst(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(20))}
FROM embeddings"""

T["log"] = f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, event_type,
  CAST(ts AS TIMESTAMP) - INTERVAL {EVENT_SHIFT_DAYS} DAY AS happened,
  CAST(CAST(ts AS TIMESTAMP) - INTERVAL {EVENT_SHIFT_DAYS} DAY AS DATE) AS day
FROM events"""

T["scored"] = """
SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS user_id, ts, event_type,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
  round(1 / (1 + exp(-(value - 50) / 50)), 4) AS score, CAST(event_id % 5 AS INTEGER) AS fold
FROM events"""

T["explained"] = """
SELECT event_type AS learner, CAST(row_id AS VARCHAR) AS user_id,
  CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS target_week_start_date, fold,
  unnest(['level', 'early', 'turn']) AS feature,
  unnest([score, CAST(row_id % 24 AS DOUBLE), CAST(row_id % 5 AS DOUBLE)]) AS input_value,
  unnest([round(score - 0.5, 4), round((0.3::DOUBLE - score) * (row_id % 3), 4),
          (row_id % 5 - 2) / 10.0::DOUBLE]) AS value
FROM scored"""

# ---- cohorts -------------------------------------------------------------

T["cohort_numbers"] = """
SELECT unnest(range(-2, 6)) AS c"""

T["dates"] = f"""
SELECT CAST(c AS INTEGER) AS cohort, {M} - CAST(7 * (c + 15) - 1 AS INTEGER) AS min_date,
  {M} - CAST(7 * c AS INTEGER) AS max_date,
  {M} - CAST(7 * c + 14 AS INTEGER) AS max_feature_date,
  {week(f"{M} - CAST(7 * c AS INTEGER)")} AS max_week,
  {week(f"{M} - CAST(7 * c + 14 AS INTEGER)")} AS last_week_start
FROM cohort_numbers WHERE c <> -1"""

T["scan"] = f"""
SELECT * FROM activity
WHERE date_of_event BETWEEN DATE '{CONFIG.extract_min_date}' AND {M}"""

T["users"] = f"""
SELECT DISTINCT user_id, CAST({number("user_id", "cohort")} % 6 AS INTEGER) AS bucket FROM scan"""

T["cohorts"] = """
SELECT u.user_id, r.fresh, d.*
FROM users u CROSS JOIN (VALUES (0), (1)) r(fresh)
JOIN dates d ON d.cohort = CASE WHEN r.fresh = 1 THEN -2 ELSE u.bucket END"""

PRODUCT = ("CASE WHEN destination = 'VIDEO_APP' AND app_name = 'R' THEN 'radio' "
           "WHEN destination = 'VIDEO_APP' THEN 'video' ELSE 'audio' END")

T["weekly"] = f"""
SELECT user_id, {PRODUCT} AS destination, {week("date_of_event")} AS week,
  count(*) AS events, CAST(sum(playback_time) AS DOUBLE) AS streaming_time,
  count(DISTINCT date_of_event) AS distinct_days, CAST(sum(page_views) AS DOUBLE) AS page_views,
  {lst(f"CAST(sum(CASE WHEN genre_names LIKE '{g[1]}%' THEN playback_time ELSE 0 END) AS DOUBLE)"
       f" AS genre_st_{g[0]}" for g in GENRES)},
  CAST(sum(playback_time) - ({lst((
      f"sum(CASE WHEN genre_names LIKE '{g[1]}%' THEN playback_time ELSE 0 END)"
      for g in GENRES), " + ")}) AS DOUBLE) AS genre_st_other
FROM scan GROUP BY 1, 2, 3"""

T["cohort_weeks"] = f"""
SELECT w.*, c.cohort, c.fresh, ({week(M)} - w.week) // 7 - c.cohort AS k
FROM weekly w JOIN cohorts c ON w.user_id = c.user_id WHERE w.destination <> 'radio'"""

# ---- target --------------------------------------------------------------

T["weeks_wide"] = f"""
SELECT user_id, destination, cohort, fresh,
  {lst(f"sum(CASE WHEN k = {w} THEN streaming_time ELSE 0 END) AS stw_{w}" for w in WEEKS)},
  sum(CASE WHEN k BETWEEN 2 AND 14 THEN streaming_time ELSE 0 END) AS streaming_time_13w,
  {lst(f"CAST(sum(CASE WHEN k = {w} THEN events ELSE 0 END) AS BIGINT) AS ew_{w}"
       for w in WEEKS)}
FROM cohort_weeks GROUP BY ALL"""

T["targets"] = f"""
SELECT p.user_id, p.destination, p.cohort, d.max_week AS target_week_start_date,
  d.max_date AS target_week_end_date, p.fresh,
  CASE WHEN fresh = 0 THEN CASE WHEN ew_1 > 0 THEN 0 ELSE 1 END END AS target_churn_this_week,
  CASE WHEN fresh = 0 THEN CASE WHEN ew_0 > 0 THEN 0 ELSE 1 END END AS target_churn_next_week,
  CASE WHEN ew_2 > 0 AND streaming_time_13w > 180 THEN 1 ELSE 0 END AS active_last_week,
  CASE WHEN {number("p.user_id", "cohort-train")} % 5 = 4 THEN 0 ELSE 1 END AS train
FROM weeks_wide p JOIN dates d ON p.cohort = d.cohort"""

T["points"] = f"""
SELECT user_id, destination, cohort, fresh, unnest(range(1, 14)) AS x,
  unnest([{", ".join(f"ew_{w}" for w in FEATURES)}]) AS y FROM weeks_wide"""

T["sums"] = """
SELECT user_id, destination, cohort, fresh, CAST(sum(x) AS DOUBLE) AS sx,
  CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(x * x) AS DOUBLE) AS sxx, CAST(sum(x * y) AS DOUBLE)
  AS sxy, CAST(sum(y * y) AS DOUBLE) AS syy FROM points GROUP BY ALL"""

T["line"] = """
SELECT *, (13 * sxy - sx * sy) / (13 * sxx - sx * sx) AS beta_hat,
  sy / 13 - (13 * sxy - sx * sy) / (13 * sxx - sx * sx) * sx / 13 AS alpha_hat FROM sums"""

T["spread"] = """
SELECT *, greatest(0, (13 * syy - sy * sy - beta_hat * beta_hat * (13 * sxx - sx * sx))
  / (13 * 11)) AS se2 FROM line"""

T["linreg"] = """
SELECT *, 13 * se2 / (13 * sxx - sx * sx) AS sb2,
  13 * se2 / (13 * sxx - sx * sx) * sxx / 13 AS sa2,
  beta_hat - 2.201 * sqrt(13 * se2 / (13 * sxx - sx * sx)) AS beta_lower,
  beta_hat + 2.201 * sqrt(13 * se2 / (13 * sxx - sx * sx)) AS beta_upper,
  alpha_hat - 2.201 * sqrt(se2 / (13 * sxx - sx * sx) * sxx) AS alpha_lower,
  alpha_hat + 2.201 * sqrt(se2 / (13 * sxx - sx * sx) * sxx) AS alpha_upper,
  CASE WHEN beta_hat < 0 THEN -alpha_hat / beta_hat END AS x_intercept
FROM spread"""


def trend(own: str | None) -> str:
    parts = []
    for p in PRODUCTS:
        enough = " AND streaming_time_13w > 180" if p == own else ""
        here = f"destination = '{p}'"
        parts += [
            f"max(CASE WHEN {here} THEN 1 ELSE 0 END) AS {p}_user",
            f"max(CASE WHEN {here} AND ew_2 > 0{enough} THEN 1 ELSE 0 END)"
            f" AS {p}_active_last_week",
            f"max(CASE WHEN {here} THEN beta_hat END) AS {p}_lin_reg_coeff",
            f"max(CASE WHEN {here} THEN alpha_hat END) AS {p}_13w_yintercept",
            f"max(CASE WHEN {here} THEN x_intercept END) AS {p}_13w_xintercept",
            f"max(CASE WHEN {here} AND x_intercept IS NOT NULL THEN 1 ELSE 0 END)"
            f" AS {p}_lin_reg_churn_flag"]
    return f"""
SELECT user_id, fresh,
  {lst(parts)}
FROM linreg JOIN weeks_wide USING (user_id, destination, cohort, fresh) GROUP BY user_id, fresh"""


T["trend"] = trend(None)
T["trend_video"], T["trend_audio"] = trend("video"), trend("audio")

# ---- genre ---------------------------------------------------------------

ALL_GENRES = [*NAMES, "other"]
T["genre_totals"] = f"""
SELECT user_id, destination, cohort, fresh, CAST(sum(events) AS BIGINT) AS events,
  CAST(sum(distinct_days) AS BIGINT) AS distinct_days,
  {lst(f"sum({c}) AS {c}" for c in ["streaming_time", "page_views",
                                    *[f"genre_st_{n}" for n in ALL_GENRES]])}
FROM cohort_weeks WHERE k BETWEEN 2 AND 14 GROUP BY ALL"""

T["affinity"] = f"""
SELECT *,
  {lst(f"{ratio(f'genre_st_{n}', 'streaming_time')} AS genre_share_{n}" for n in ALL_GENRES)},
  {lst(f"CASE WHEN genre_st_{n} > 0 THEN 1 ELSE 0 END AS genre_watch_{n}" for n in ALL_GENRES)},
  {lst((f"CASE WHEN genre_st_{n} > 0 THEN 1 ELSE 0 END" for n in ALL_GENRES), " + ")}
    AS genre_distinct_count
FROM genre_totals"""

T["programmes"] = f"""
SELECT DISTINCT media_type AS destination, {TITLE} AS tleo,
  {week("CAST(tx_date AS DATE)")} AS week, genre_names
FROM catalogue WHERE tx_date <> 'null' AND tx_date >= '1970-01-01'"""

T["schedule"] = f"""
SELECT destination, week,
  {lst(f"CAST(count(*) FILTER (genre_names LIKE '{g[1]}%') AS DOUBLE) AS releases_{g[2]}"
       for g in GENRES)},
  CAST(count(*) FILTER (NOT ({lst((f"genre_names LIKE '{g[1]}%'" for g in GENRES), " OR ")}))
    AS DOUBLE) AS releases_other
FROM programmes GROUP BY 1, 2"""

ALL_RELEASES = [*RELEASES, "other"]
T["scaled"] = f"""
SELECT destination, week,
  {lst(f"CASE WHEN avg(releases_{n}) OVER w = 0 THEN 1.0::DOUBLE "
       f"ELSE releases_{n} / avg(releases_{n}) OVER w END AS scaled_releases_{n}"
       for n in ALL_RELEASES)}
FROM schedule WHERE week >= DATE '{CONFIG.schedule_since}'
WINDOW w AS (PARTITION BY destination ORDER BY week ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)"""

T["match"] = f"""
SELECT a.*, s.* EXCLUDE (destination, week), f.* EXCLUDE (destination, week),
  {lst(f"(f.scaled_releases_{r} - 1) * a.genre_share_{n} AS sched_match_index_{n}"
       for n, r in zip(NAMES, RELEASES))},
  {lst((f"(f.scaled_releases_{r} - 1) * a.genre_share_{n}"
        for n, r in zip(NAMES, RELEASES)), " + ")} AS sched_match_index
FROM affinity a JOIN dates d ON a.cohort = d.cohort
LEFT JOIN schedule s ON a.destination = s.destination AND s.week = d.max_week
LEFT JOIN scaled f ON a.destination = f.destination AND f.week = d.max_week"""

# ---- windowed activity ---------------------------------------------------

T["win"] = """
SELECT a.*, c.fresh, c.cohort FROM activity a JOIN cohorts c ON a.user_id = c.user_id
  AND a.date_of_event BETWEEN c.min_date AND c.max_feature_date"""

T["listening"] = f"""
SELECT user_id, fresh,
  {first_valid(["brand_id", "series_id", "episode_id", "clip_id"], ["N/A", "", "null"])}
    AS tleo_id, version_id, broadcast_type, CAST(sum(playback_time) AS DOUBLE) AS streaming_time,
  CAST(count(DISTINCT CASE WHEN playback_time >= 180 THEN date_of_event END) AS DOUBLE) AS events
FROM win WHERE destination = 'AUDIO_APP' AND playback_time > 0 GROUP BY 1, 2, 3, 4, 5"""

T["flagged"] = """
SELECT l.*, l.tleo_id IN ('Brand#5', 'Brand#6')
    AND l.tleo_id IN (SELECT p_brand FROM part) AS listed,
  c.master_brand_id = 'app_podcasts' OR c.format_names LIKE '%Podcast%' AS podcast,
  c.episode_id IN (SELECT episode_id FROM catalogue WHERE version_type = 'Podcast version')
    AS podcast_version,
  c.format_names LIKE '%Mixes%' OR c.version_id IN
    (SELECT 'v' || p_partkey FROM part WHERE p_partkey % 23 = 0) AS mix,
  c.master_brand_name = 'App Mixes'
    OR (c.master_brand_name = 'Radio' AND c.format_names LIKE '%Mixes%')
    OR c.version_id IN (SELECT 'v' || p_partkey FROM part WHERE p_partkey % 29 = 0) AS app_mix
FROM listening l LEFT JOIN catalogue c ON l.version_id = c.version_id"""

T["typed"] = """
SELECT user_id, fresh, tleo_id, version_id, broadcast_type, streaming_time, events,
  podcast OR podcast_version OR listed AS all_podcasts, podcast OR listed AS app_podcasts,
  mix AS all_mixes, app_mix AS app_mixes,
  CASE WHEN broadcast_type = 'Live' THEN 'live_radio'
    WHEN podcast OR listed THEN 'od_app_podcasts' WHEN app_mix THEN 'od_app_mixes'
    WHEN podcast_version THEN 'od_radio_podcasts' WHEN mix THEN 'od_linear_mixes'
    ELSE 'od_radio' END AS listening_type
FROM flagged"""

_M = {"st": "streaming_time", "ev": "events"}
T["mix_sums"] = f"""
SELECT user_id, fresh, sum(streaming_time) AS total_st, sum(events) AS total_ev,
  {lst(f"sum(CASE WHEN listening_type = '{n}' THEN {c} ELSE 0 END) AS audio_prod_{m}_{n}"
       for m, c in _M.items() for n, _ in LISTENING_DETAIL)},
  {lst(f"sum(CASE WHEN listening_type IN {in_list(parts)} THEN {c} ELSE 0 END)"
       f" AS audio_prod_{m}_{n}" for m, c in _M.items() for n, _, parts in LISTENING_COARSE)}
FROM typed GROUP BY 1, 2"""

MIX_NAMES = [*[n for n, _ in LISTENING_DETAIL], *[n for n, _, _ in LISTENING_COARSE]]
T["mix_shares"] = f"""
SELECT * EXCLUDE (total_st, total_ev),
  {lst(f"{ratio(f'audio_prod_{m}_{n}', f'total_{m}')} AS audio_prod_{n}_{m}_perc"
       for m in _M for n in MIX_NAMES)}
FROM mix_sums"""

T["mix"] = f"""
SELECT *,
  {lst(best([(f"audio_prod_{n}_{m}_perc", label) for n, label in LISTENING_DETAIL])
       + f" AS audio_prod_{m}_preferred_listening_detail" for m in _M)},
  {lst(best([(f"audio_prod_{n}_{m}_perc", label) for n, label, _ in LISTENING_COARSE])
       + f" AS audio_prod_{m}_preferred_listening" for m in _M)}
FROM mix_shares"""

APP_TYPE = """CASE WHEN device_type = 'Desktop' THEN 'desktop-web'
    WHEN device_type = 'Smart TV' THEN 'smart-tv'
    WHEN device_type = 'Smartphone' AND browser_brand = 'Applications' THEN 'mobile-app'
    WHEN device_type = 'Smartphone' AND browser_brand <> 'Applications' THEN 'mobile-web'
    WHEN device_type = 'Tablet' AND browser_brand = 'Applications' THEN 'tablet-app'
    WHEN device_type = 'Tablet' AND browser_brand <> 'Applications' THEN 'tablet-web'
    ELSE 'other-web' END"""

T["usage"] = f"""
SELECT user_id, fresh, {PRODUCT} AS product, device_type, {APP_TYPE} AS app_type,
  CAST(sum(playback_time) AS DOUBLE) AS streaming_time,
  CAST(count(DISTINCT date_of_event) AS DOUBLE) AS events
FROM win WHERE playback_time >= 180 AND {PRODUCT} <> 'radio' GROUP BY 1, 2, 3, 4, 5"""

T["device_sums"] = f"""
SELECT user_id, fresh,
  {lst(f"count(DISTINCT CASE WHEN product = '{p}' THEN device_type END) AS {p}_device_count"
       for p in PRODUCTS)},
  {lst(f"sum(CASE WHEN product = '{p}' AND app_type = '{label}' THEN {c} ELSE 0 END)"
       f" AS {p}_{m}_{n}" for p in PRODUCTS for m, c in _M.items() for n, label in DEVICE_TYPES)}
FROM usage GROUP BY 1, 2"""


def _device_total(p: str, m: str) -> str:
    return "(" + " + ".join(f"{p}_{m}_{n}" for n, _ in DEVICE_TYPES) + ")"


T["device_parts"] = f"""
SELECT user_id, fresh, video_device_count, audio_device_count,
  {lst(f"{ratio(f'{p}_{m}_{n}', _device_total(p, m))} AS device_{p}_{m}_{n}_perc"
       for p in PRODUCTS for m in _M for n, _ in DEVICE_TYPES)}
FROM device_sums"""

T["devices"] = f"""
SELECT *,
  {lst(best([(f"device_{p}_{m}_{n}_perc", label) for n, label in DEVICE_TYPES])
       + f" AS device_{p}_{m}_preferred" for p in PRODUCTS for m in _M)}
FROM device_parts"""

T["time_sums"] = f"""
SELECT user_id, fresh, {PRODUCT} AS product, sum(playback_time) AS total,
  {lst(f"sum(CASE WHEN hour_of_event BETWEEN {a} AND {b} THEN playback_time ELSE 0 END) AS tod_{n}"
       for n, a, b in HOUR_BANDS)},
  {lst(f"sum(CASE WHEN isodow(date_of_event) = {i + 1} THEN playback_time ELSE 0 END) AS dow_{n}"
       for i, n in enumerate(WEEKDAYS))}
FROM win GROUP BY 1, 2, 3"""

TIME_NAMES = [*[f"tod_{n}" for n, _, _ in HOUR_BANDS], *[f"dow_{n}" for n in WEEKDAYS]]
T["times"] = f"""
SELECT user_id, fresh, product, {lst(f"{ratio(n, 'total')} AS {n}" for n in TIME_NAMES)}
FROM time_sums"""

# ---- content -------------------------------------------------------------

T["episode_content"] = """
SELECT DISTINCT episode_id,
  CASE WHEN brand_id = 'null' THEN series_id ELSE brand_id END AS content_id
FROM catalogue WHERE episode_id <> 'null'"""

for _name, _expr in (("genre", "split_part(genre_names, ';', 1)"),
                     ("masterbrand", "master_brand_name")):
    T[f"top_{_name}"] = f"""
SELECT content_id, {_name} FROM (
  SELECT content_id, {_expr} AS {_name}, row_number() OVER (
    PARTITION BY content_id ORDER BY count(*) DESC, {_expr} NULLS FIRST) AS rn
  FROM catalogue JOIN episode_content USING (episode_id) WHERE content_id <> 'null'
  GROUP BY content_id, {_expr}) WHERE rn = 1"""

T["contents"] = f"""
SELECT content_id, genre, masterbrand,
  CASE WHEN masterbrand IN {in_list(CONFIG.named_brands)} THEN masterbrand
    WHEN lower(masterbrand) LIKE '%radio%' THEN 'Other Radio' ELSE 'Other' END
    AS brand_simplified
FROM top_genre JOIN top_masterbrand USING (content_id)"""

for _p in PRODUCTS:
    _key = "version_id" if _p == "video" else "episode_id"
    T[f"latest_{_p}"] = f"""
SELECT * FROM (
  SELECT c.user_id, c.fresh, c.last_week_start, a.week_beginning, a.{_key}, row_number() OVER (
    PARTITION BY c.user_id, c.fresh ORDER BY a.week_beginning DESC, a.{_key} DESC) AS rn
  FROM cohorts c JOIN activations_{_p} a
    ON a.user_id = c.user_id AND a.week_beginning <= c.last_week_start) WHERE rn = 1"""
    T[f"activation_{_p}"] = f"""
SELECT c.user_id, c.fresh, l.week_beginning AS activation_week,
  v.episode_id AS activation_episode_id, e.content_id AS activation_content_id,
  {lst(f"f.f{i} AS {_p}_activ_f{i}" for i in range(CONFIG.factors[_p]))},
  CAST((l.last_week_start - l.week_beginning) // 7 + 1 AS INTEGER)
    AS {_p}_weeks_since_activation,
  t.genre AS {_p}_activating_genre, t.brand_simplified AS {_p}_activating_masterbrand
FROM cohorts c LEFT JOIN latest_{_p} l ON c.user_id = l.user_id AND c.fresh = l.fresh
LEFT JOIN catalogue v ON v.{_key} = l.{_key}
LEFT JOIN episode_content e ON e.episode_id = v.episode_id
LEFT JOIN contents t ON t.content_id = e.content_id
LEFT JOIN factors f ON f.content_id = t.content_id"""
    T[f"favourite_{_p}"] = f"""
SELECT r.user_id, r.fresh, r.content_id AS {_p}_fav_content_id, r.level AS {_p}_fav_content_level,
  t.genre AS {_p}_fav_content_genre, t.brand_simplified AS {_p}_fav_content_masterbrand,
  {lst(f"f.f{i} AS {_p}_fav_f{i}" for i in range(CONFIG.factors[_p]))}
FROM (SELECT user_id, fresh, content_id, level, row_number() OVER (PARTITION BY user_id, fresh
        ORDER BY count(DISTINCT date_of_event) DESC, content_id, level) AS rn
      FROM (SELECT *, CASE WHEN brand_id <> 'null' THEN brand_id WHEN series_id <> 'null'
              THEN series_id ELSE episode_id END AS content_id,
              CASE WHEN brand_id <> 'null' THEN 'brand_id' WHEN series_id <> 'null'
              THEN 'series_id' ELSE 'episode_id' END AS level
            FROM win WHERE destination = '{_p.upper()}_APP' AND playback_time >= 180)
      GROUP BY user_id, fresh, content_id, level) r
LEFT JOIN contents t ON t.content_id = r.content_id
LEFT JOIN factors f ON f.content_id = r.content_id WHERE r.rn = 1"""

# ---- last week -----------------------------------------------------------

T["first_shown"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, episode_id
  ORDER BY CASE WHEN tx_date = 'null' THEN '2099-01-01' ELSE tx_date END,
    CASE WHEN tx_start = 'null' THEN '99:99:99' ELSE tx_start END, version_id) AS rn
  FROM catalogue WHERE content_kind = 'episode' AND series_id <> 'null') WHERE rn = 1"""

T["episodes"] = """
SELECT episode_id, version_id AS version_id_first_broadcast, series_id, programme_title,
  episode_title, split_part(genre_list, ';', 1) AS genre, split_part(genre_list, ';', 2)
  AS subgenre, CASE WHEN tx_date <> 'null' THEN tx_date END AS tx_date, tx_start,
  row_number() OVER (PARTITION BY series_id
    ORDER BY CASE WHEN tx_date = 'null' THEN '2099-01-01' ELSE tx_date END,
    CASE WHEN tx_start = 'null' THEN '99:99:99' ELSE tx_start END, episode_id) AS episode_number
FROM first_shown"""

T["finales"] = """
SELECT episode_id, series_id, episode_number,
  max(episode_number) OVER (PARTITION BY series_id) AS eps_in_series,
  CASE WHEN episode_number = 1 THEN 1 ELSE 0 END AS series_premiere,
  CASE WHEN episode_number = max(episode_number) OVER (PARTITION BY series_id)
    THEN 1 ELSE 0 END AS series_finale
FROM episodes"""

T["views"] = f"""
SELECT a.user_id, c.fresh, CASE WHEN destination = 'VIDEO_APP' THEN 'video' ELSE 'audio' END
  AS destination, {PRODUCT} AS product, version_id, count(DISTINCT date_of_event) AS events
FROM activity a JOIN cohorts c ON a.user_id = c.user_id
  AND a.date_of_event BETWEEN c.last_week_start AND c.max_feature_date
WHERE playback_time >= 600 GROUP BY 1, 2, 3, 4, 5"""

T["last_series"] = f"""
SELECT user_id, fresh, destination, count(DISTINCT tleo) AS distinct_series,
  count(DISTINCT v.episode_id) AS distinct_episodes,
  CAST(coalesce(sum(series_premiere), 0) AS BIGINT) AS series_premieres,
  CAST(coalesce(sum(series_finale), 0) AS BIGINT) AS series_finales
FROM views LEFT JOIN (SELECT version_id, episode_id, {TITLE} AS tleo FROM catalogue) v
  USING (version_id)
LEFT JOIN finales f ON f.episode_id = v.episode_id
WHERE product <> 'radio' GROUP BY 1, 2, 3"""

T["last_repeats"] = """
SELECT user_id, fresh, destination, avg(repeats) AS avg_episode_repeats
FROM (SELECT user_id, fresh, destination, c.episode_id,
        sum(CASE WHEN c.episode_id IS NULL THEN 0 ELSE events END) AS repeats
      FROM views LEFT JOIN catalogue c USING (version_id) GROUP BY 1, 2, 3, 4)
GROUP BY 1, 2, 3"""

T["last_week"] = """
SELECT s.*, CASE WHEN series_finales > 0 THEN 1 ELSE 0 END AS watched_finale_flag,
  r.avg_episode_repeats
FROM last_series s LEFT JOIN last_repeats r USING (user_id, fresh, destination)"""

# ---- dimensions and logs -------------------------------------------------

T["demographics"] = """
SELECT p.user_id, c.fresh, enable_personalisation, mail_verified,
  CAST(c.max_week - created_date AS INTEGER) AS acc_age_days,
  CASE WHEN c.max_week - created_date < 14 THEN 0 ELSE 1 END AS train_eligible,
  age, age_range,
  CASE WHEN age_range IN ('16-19', '20-24', '25-29', '30-34') THEN 1
    WHEN age_range IS NOT NULL THEN 0 WHEN predicted_age = '16-34' THEN 1 ELSE 0 END
    AS age_1634_enriched,
  CASE WHEN age IS NULL THEN 1 ELSE 0 END AS age_missing_flag,
  CASE WHEN age_range IS NULL AND predicted_age IS NULL THEN 1 ELSE 0 END
    AS age_1634_enriched_missing_flag,
  gender, coalesce(gender, predicted_gender) AS gender_enriched,
  CASE WHEN gender IS NULL THEN 1 ELSE 0 END AS gender_missing_flag,
  CASE WHEN gender IS NULL AND predicted_gender IS NULL THEN 1 ELSE 0 END
    AS gender_enriched_missing_flag,
  nation, CASE WHEN lower(location) = 'gb' THEN 1 ELSE 0 END AS uk_flag, barb_region,
  acorn_type_description, acorn_group_description, acorn_category_description
FROM people p JOIN cohorts c ON p.user_id = c.user_id
LEFT JOIN extension e ON e.user_id = p.user_id
LEFT JOIN genders g ON g.user_id = p.user_id LEFT JOIN ages a ON a.user_id = p.user_id
WHERE NOT is_repeated AND status <> 'deleted'"""

T["facts"] = """
SELECT d.user_id AS who, acc_age_days, d.age, d.gender, d.barb_region, d.acorn_group_description,
  acorn_category AS acorn_cat_num, CASE WHEN d.age BETWEEN 16 AND 34 THEN 1 ELSE 0 END AS age_1634
FROM demographics d LEFT JOIN extension e ON e.user_id = d.user_id WHERE d.fresh = 1"""

T["segments_of"] = """
SELECT who, 'user_base' AS user_id FROM facts
UNION ALL SELECT who, 'user_1634' FROM facts WHERE age_1634 = 1
UNION ALL SELECT who, 'user_1624' FROM facts WHERE age <= 24
UNION ALL SELECT who, 'user_female' FROM facts WHERE gender = 'female'
UNION ALL SELECT who, 'user_acorn_456' FROM facts WHERE acorn_cat_num IN (4, 5, 6)"""

T["averages"] = """
SELECT user_id, median(CAST(acc_age_days AS DOUBLE)) AS days, median(CAST(age AS DOUBLE)) AS years,
  max(region) AS region
FROM facts JOIN segments_of USING (who) LEFT JOIN (
  SELECT user_id AS u, barb_region AS region FROM facts JOIN segments_of USING (who)
  WHERE barb_region IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, barb_region) = 1)
  ON u = user_id
GROUP BY user_id"""

T["frequency"] = f"""
SELECT c.user_id, c.fresh,
  {lst(f"coalesce(max(CASE WHEN s.product = '{p}' THEN s.segment END), 'X. Inactive')"
       f" AS freq_seg_{p}" for p in SEGMENT_PRODUCTS)}
FROM cohorts c LEFT JOIN segments s
  ON s.user_id = c.user_id AND s.seg_week = c.last_week_start GROUP BY 1, 2"""

T["optin"] = """
SELECT user_id, fresh, server_time, last_action,
  CASE WHEN last_action = 'followed' THEN 1 ELSE 0 END AS mkt_opted_in,
  CASE WHEN last_action = 'followed' THEN CAST(max_feature_date - day AS INTEGER) END
    AS mkt_days_opted_in,
  CASE WHEN last_action = 'unfollowed' THEN CAST(max_feature_date - day AS INTEGER) END
    AS mkt_days_opted_out
FROM (SELECT c.user_id, c.fresh, c.max_feature_date, day, happened AS server_time,
        CASE event_type WHEN 'signup' THEN 'followed' ELSE 'unfollowed' END AS last_action,
        row_number() OVER (PARTITION BY c.user_id, c.fresh ORDER BY happened DESC, event_type) AS rn
      FROM log JOIN cohorts c ON log.user_id = c.user_id AND day <= c.max_feature_date
      WHERE event_type IN ('signup', 'error') AND event_id % 2 = 0) WHERE rn = 1"""

for _name, _kind in (("opens", "view"), ("clicks", "click")):
    T[_name] = f"""
SELECT c.user_id, c.fresh, count(DISTINCT event_id % 40) AS n13,
  count(DISTINCT CASE WHEN happened >= c.last_week_start THEN event_id % 40 END) AS nlw
FROM log JOIN cohorts c ON log.user_id = c.user_id
  AND day BETWEEN c.min_date AND c.max_feature_date
WHERE event_type = '{_kind}' GROUP BY 1, 2"""

T["mail"] = """
SELECT coalesce(o.user_id, k.user_id) AS user_id, coalesce(o.fresh, k.fresh) AS fresh,
  coalesce(o.n13, 0) AS mkt_email_opens_13w, coalesce(o.nlw, 0) AS mkt_email_opens_lw,
  coalesce(k.n13, 0) AS mkt_email_clicks_13w, coalesce(k.nlw, 0) AS mkt_email_clicks_lw
FROM opens o FULL JOIN clicks k ON o.user_id = k.user_id AND o.fresh = k.fresh"""

_RULES = {"video_programme_follows": "event_type = 'click'",
          "audio_subscribes": "event_type IN ('view', 'error')",
          "audio_bookmarks": "event_type IN ('signup', 'purchase')"}
assert list(_RULES) == [r[0] for r in FOLLOW_RULES]
T["follows"] = f"""
SELECT c.user_id, c.fresh,
  {lst(f"count(*) FILTER ({rule}) AS {n}_13w, "
       f"count(*) FILTER ({rule} AND day >= c.last_week_start) AS {n}_lastweek"
       for n, rule in _RULES.items())}
FROM log JOIN cohorts c ON log.user_id = c.user_id
  AND day BETWEEN c.min_date AND c.max_feature_date GROUP BY 1, 2"""


def needed(sql: str) -> list[str]:
    """Names of the tables a text uses, in definition order."""
    found, queue = set(), [sql]
    while queue:
        words = set(re.findall(r"(?:FROM|JOIN)\s+([a-z_][a-z_0-9]*)", queue.pop()))
        fresh = {n for n in T if n in words and n not in found}
        found |= fresh
        queue += [T[n] for n in fresh]
    return [n for n in T if n in found]


def with_tables(sql: str) -> str:
    names = needed(sql)
    head = ",\n".join(f"{n} AS ({T[n].strip()})" for n in names)
    return (f"WITH {head}\n" if names else "") + sql.strip()


def rounded(column: str) -> str:
    return (f"CASE WHEN abs({column}) < 0.0000005 THEN 0.0::DOUBLE "
            f"ELSE round({column}, 6) END")


def shown(table: str, *, dates=(), doubles=(), drop=(), where: str = "") -> str:
    """The whole block, days as text and fractions rounded to six places."""
    changes = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    changes += [f"{rounded(c)} AS {c}" for c in doubles]
    replace = f" REPLACE ({', '.join(changes)})" if changes else ""
    exclude = f" EXCLUDE ({', '.join(drop)})" if drop else ""
    return with_tables(f"SELECT *{exclude}{replace} FROM {table} {where}")
