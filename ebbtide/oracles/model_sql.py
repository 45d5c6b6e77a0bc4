"""SQL twins of the deterministic preparation, evaluation and export queries."""

from __future__ import annotations

from ebbtide.oracles.blocks import T, rounded, shown, with_tables
from ebbtide.oracles.feature_sql import feature_set_names

CURVE = """
SELECT {g} score AS threshold, sum(label) AS tp_here, count(*) - sum(label) AS fp_here,
  CAST(sum(sum(label)) OVER up AS BIGINT) AS tp,
  CAST(sum(count(*) - sum(label)) OVER up AS BIGINT) AS fp,
  CAST(sum(sum(label)) OVER {w} AS DOUBLE) AS p,
  CAST(sum(count(*) - sum(label)) OVER {w} AS DOUBLE) AS n
FROM scored GROUP BY {g} score
WINDOW up AS ({part} ORDER BY score DESC)"""

T["curve"] = CURVE.format(g="", w="()", part="")
T["fold_curve"] = CURVE.format(g="fold,", w="(PARTITION BY fold)", part="PARTITION BY fold")
T["grid"] = "SELECT CAST(unnest(range(0, 100)) AS INTEGER) AS point"
# a grid point lies on the piece of the curve that starts at or before it
T["grid_tpr"] = """
SELECT fold, point, CASE WHEN point = 99 THEN 1.0 ELSE
  (tp - tp_here + (point * n - 99 * (fp - fp_here)) / (99.0::DOUBLE * fp_here) * tp_here) / p END
  AS tpr
FROM fold_curve JOIN grid ON fp_here > 0 AND 99 * (fp - fp_here) <= point * n
  AND (point * n < 99 * fp OR (point = 99 AND fp = n))"""


# Learners of the audio stack, imputed columns.
LEARNERS = "('Content'), ('Behaviour'), ('Marketing'), ('Cross-Sell'), ('Product Type'), ('Events')"
IMPUTED = ("profile_age", "profile_nation", "profile_barb_region",
           "profile_acorn_type_description", "profile_acorn_group_description",
           "profile_acorn_category_description", "profile_gender_enriched")

# The role rules as patterns on the column name, for the video product.
ROLE = """CASE
  WHEN column_name IN ('user_id', 'destination', 'target_week_start_date',
    'target_churn_this_week', 'target_churn_next_week', 'active_last_week', 'train',
    'train_eligible', 'cohort', 'ew_0', 'ew_1') THEN 'id'
  WHEN column_name IN ('profile_enablepersonalisation', 'profile_mailverified',
    'profile_nation', 'profile_barb_region', 'profile_acorn_type_description',
    'profile_acorn_group_description', 'profile_acorn_category_description',
    'profile_age_1634_enriched', 'profile_gender_enriched', 'audio_user',
    'audio_active_last_week', 'video_lin_reg_churn_flag', 'audio_lin_reg_churn_flag',
    'lw_watched_finale_flag', 'video_activating_genre', 'video_activating_masterbrand',
    'mkt_opted_in') OR column_name LIKE '%\\_fav\\_content\\_%' ESCAPE '\\'
    OR column_name LIKE 'freq\\_seg\\_latest\\_%' ESCAPE '\\'
    OR (column_name LIKE 'device\\_%' ESCAPE '\\' AND column_name LIKE '%preferred%') THEN 'factor'
  WHEN column_name IN ('fresh', 'stw_0', 'stw_1', 'video_user', 'video_active_last_week',
    'profile_uk_flag', 'audio_device_count', 'video_device_count') THEN
    CASE WHEN column_name LIKE '%device%' THEN 'continuous' ELSE 'unclassified' END
  ELSE 'continuous' END"""


def _nulls(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (\"{c}\" IS NULL) AS n_null FROM {source}"
        for c in columns)


# The two trees of the query, as the score over a pair of conditions each.
T["tree_scores"] = """
SELECT tree, a, b, CASE tree
    WHEN 1 THEN CASE WHEN a THEN 0.5::DOUBLE WHEN b THEN -1 ELSE 2 END
    ELSE 0.5::DOUBLE * CASE WHEN a THEN 1 WHEN b THEN -3 ELSE 0.25::DOUBLE END END AS v
FROM (VALUES (1), (2)) t(tree), (VALUES (TRUE), (FALSE)) x(a), (VALUES (TRUE), (FALSE)) y(b)"""
T["tree_sides"] = """
SELECT user_id || '/' || destination AS row_id, fresh, tree,
  CASE tree WHEN 1 THEN streaming_time <= 1000 ELSE genre_share_drama <= 0.2::DOUBLE END AS a,
  CASE tree WHEN 1 THEN page_views <= 3 ELSE streaming_time <= 4000 END AS b
FROM affinity, (VALUES (1), (2)) t(tree)"""
T["tree_known"] = """
SELECT tree, a, b, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY tree) AS share
FROM tree_sides WHERE fresh = 0 GROUP BY 1, 2, 3"""
# half of each order: the first feature before and after the second one
T["tree_values"] = """
SELECT r.row_id, r.tree,
  sum(k.share * (x_b.v - none.v + all_.v - b_x.v)) / 2 AS of_a,
  sum(k.share * (b_x.v - none.v + all_.v - x_b.v)) / 2 AS of_b
FROM tree_sides r JOIN tree_known k USING (tree)
JOIN tree_scores x_b ON x_b.tree = r.tree AND x_b.a = r.a AND x_b.b = k.b
JOIN tree_scores b_x ON b_x.tree = r.tree AND b_x.a = k.a AND b_x.b = r.b
JOIN tree_scores none ON none.tree = r.tree AND none.a = k.a AND none.b = k.b
JOIN tree_scores all_ ON all_.tree = r.tree AND all_.a = r.a AND all_.b = r.b
WHERE r.fresh = 1 GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    shares = [f"genre_share_{n}" for n in (
        "comedy", "drama", "ents", "childrens", "factual", "learning", "music", "news",
        "religion", "sport", "weather", "other")]
    scaled = ["streaming_time", "page_views", "genre_st_drama", "genre_st_sport"]
    hot = {"gender_enriched": ["female", "male"],
           "barb_region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
           "age_range": ["16-19", "20-24", "25-29", "30-34", "35-39", "40-44", "55+"]}
    flags = ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_"
        + v.replace("-", "_").replace(" ", "_").replace("+", "")
        for c, values in hot.items() for v in values)
    week = "CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR)"
    gap = "tp / p - fp / n"
    return {
        "roc_curve": with_tables(
            f"SELECT threshold, tp, fp, {rounded('tp / p')} AS tpr, {rounded('fp / n')} AS fpr "
            "FROM curve"),
        "roc_auc": with_tables(f"""
SELECT fold, {rounded("(sum(pairs) / max(p * n))")} AS auc
FROM (SELECT fold, p, n, fp_here * (tp - tp_here / 2.0::DOUBLE) AS pairs FROM fold_curve)
GROUP BY fold"""),
        "log_loss": with_tables(f"""
SELECT fold, {rounded("avg(-CASE WHEN label = 1 THEN ln(s) ELSE ln(1 - s) END)")} AS log_loss
FROM (SELECT fold, label, least(greatest(score, 1e-15), 1 - 1e-15) AS s FROM scored)
GROUP BY fold"""),
        "youden_threshold": with_tables(f"""
SELECT fold, {rounded("threshold")} AS threshold, {rounded("youden")} AS youden
FROM (SELECT fold, threshold, {gap} AS youden, row_number() OVER (PARTITION BY fold
        ORDER BY round({gap}, 12) DESC, threshold DESC) AS rn FROM fold_curve) WHERE rn = 1"""),
        "mean_roc": with_tables(f"""
SELECT point, {rounded("(point / 99.0::DOUBLE)")} AS fpr, {rounded("m")} AS mean_tpr,
  {rounded("s")} AS std_tpr, {rounded("greatest(m - s, 0)")} AS lower,
  {rounded("least(m + s, 1)")} AS upper
FROM (SELECT point, avg(tpr) AS m, stddev_pop(tpr) AS s FROM grid_tpr GROUP BY point)"""),
        "confusion_metrics": with_tables(f"""
SELECT fold, tn, fp, fn, tp, {rounded("((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE))")}
    AS accuracy, {rounded("(2.0::DOUBLE * tp / (2 * tp + fp + fn))")} AS f1
FROM (SELECT fold, count(*) FILTER (score < 0.5 AND label = 0) AS tn,
        count(*) FILTER (score >= 0.5 AND label = 0) AS fp,
        count(*) FILTER (score < 0.5 AND label = 1) AS fn,
        count(*) FILTER (score >= 0.5 AND label = 1) AS tp FROM scored GROUP BY fold)"""),
        "sqrt_transform": with_tables(
            "SELECT user_id, destination, fresh, "
            + ", ".join(f"{rounded(f'sqrt({c})')} AS sqrt_{c}" for c in shares)
            + " FROM affinity"),
        "maxabs_scale": with_tables(
            "SELECT user_id, destination, fresh, " + ", ".join(
                rounded(f"({c} / (SELECT CASE WHEN max(abs({c})) > 0 THEN max(abs({c})) "
                        f"ELSE 1 END FROM genre_totals WHERE fresh = 0))") + f" AS {c}"
                for c in scaled) + " FROM genre_totals WHERE fresh = 1"),
        "one_hot_align": with_tables(
            f"SELECT user_id, {flags} FROM demographics WHERE fresh = 1"),
        "feature_registry": with_tables(f"""
SELECT column_name, n_null, {ROLE} AS role
FROM ({_nulls(feature_set_names("video"), "features_video")})"""),
        "stack_config": with_tables(f"""
SELECT learner, column_name AS feature, n_null
FROM ({_nulls(feature_set_names("audio"), "features_audio")}) JOIN (VALUES
  ('Content', 'genre_distinct_count|genre_share|sched_match_index'),
  ('Behaviour', 'audio_device_count|^device_audio_st_.*(perc|preferred)|^audio_(tod|dow)_'
    || '|lw_series_finales|lw_distinct_'),
  ('Marketing', '^mkt_|profile_enablepersonalisation|profile_mailverified'),
  ('Cross-Sell', '^freq_seg_latest_(video|news|sport|kids|preschool|weather)$'),
  ('Product Type', '^audio_prod_.*(perc|preferred)')) r(learner, pattern)
  ON regexp_matches(column_name, pattern)"""),
        "model_impute": with_tables(f"""
SELECT column_name, 0::BIGINT AS n_null,
  (SELECT count(*) FROM features_audio WHERE fresh = 0) AS rows
FROM (VALUES {", ".join(f"('{c}')" for c in IMPUTED)}) c(column_name)"""),
        **{f"weak_learner_{kind}": with_tables("""
SELECT count(*) AS rows, count(*) AS scored, 1 AS no_worse FROM features_audio
WHERE fresh = 0 AND target_churn_next_week IS NOT NULL""")
           for kind in ("logr", "gbt", "mlp", "rf")},
        "feature_select_rfe": "SELECT 3::BIGINT AS n_kept, 1 AS all_known",
        "feature_select_gain": "SELECT 10::BIGINT AS n_kept, 1 AS all_known",
        "feature_select_known": """
SELECT method, feature, CASE WHEN method = 'gain' AND feature = 'level' THEN 1 ELSE 0 END AS first
FROM (VALUES ('rfe'), ('gain')) m(method), (VALUES ('level'), ('turn'), ('early')) f(feature)""",
        "logistic_equations": with_tables("""
SELECT CAST(f.fold AS INTEGER) AS fold, (SELECT count(*) FROM scored s WHERE s.fold <> f.fold)
  AS rows, input, 1 AS holds
FROM range(5) f(fold), (VALUES ('level'), ('turn'), ('early'), ('noise_101'), ('noise_211'),
  ('noise_307'), ('noise_401'), ('intercept')) i(input)"""),
        "impute_regression": """
SELECT count(*) AS rows, count(*) FILTER (event_id % 7 = 0) AS filled,
  count(*) FILTER (event_id % 7 = 0) AS on_the_line FROM events WHERE value IS NOT NULL""",
        "stack_fit_logistic": """
SELECT learner, models, 1 AS has_features, 1 AS cut FROM (VALUES
  ('Content', 10::BIGINT), ('Behaviour', 10), ('Marketing', 10), ('Cross-Sell', 10),
  ('RFE-Optimised', 10), ('RFE-Boosted', 10), ('meta', 1)) l(learner, models)""",
        "stack_fit": """
SELECT * FROM (VALUES ('threshold', 7::BIGINT, 1), ('auc', 0::BIGINT, 1),
  ('log_loss', 2::BIGINT, 1)) m(measure, n, in_range)""",
        "stack_predict": with_tables(f"""
SELECT learner, count(*) AS rows, count(*) AS scored
FROM features_audio, (VALUES {LEARNERS}, ('meta')) l(learner) WHERE fresh = 1 GROUP BY 1"""),
        "shapley_sampled": with_tables(f"""
SELECT learner, least(count(*), 1000) AS rows, least(count(*), 1000) AS add_up
FROM features_audio, (VALUES {LEARNERS}) l(learner) WHERE fresh = 1 GROUP BY 1"""),
        "shapley_trees": with_tables(f"""
SELECT row_id, feature, {rounded("sum(v)")} AS value FROM (
  SELECT row_id, unnest(CASE tree WHEN 1 THEN ['streaming_time', 'page_views']
    ELSE ['genre_share_drama', 'streaming_time'] END) AS feature, unnest([of_a, of_b]) AS v
  FROM tree_values) GROUP BY 1, 2"""),
        "importance_mean": with_tables(f"""
SELECT learner, feature, {rounded("avg(abs(value))")} AS gain FROM explained GROUP BY 1, 2"""),
        "linear_contributions": with_tables("SELECT * FROM (" + " UNION ALL ".join(
            f"""
SELECT user_id || '/' || destination AS row_id, '{c}' AS feature,
  {rounded(f"(({c} - avg({c}) OVER ()) * {w})")} AS value FROM affinity WHERE fresh = 1"""
            for c, w in (("streaming_time", 0.001), ("page_views", -0.02),
                         ("genre_share_drama", 1.5))) + ")"),
        "attribution_summary": with_tables(f"""
SELECT learner, feature, {rounded("size")} AS mean_abs_value,
  CAST(row_number() OVER (PARTITION BY learner ORDER BY size DESC, feature) AS INTEGER) AS rank
FROM (SELECT learner, feature, avg(abs(value)) AS size FROM explained GROUP BY 1, 2)"""),
        "attribution_export": with_tables(f"""
SELECT learner AS learner_name, user_id, target_week_start_date, feature,
  {rounded("input_value")} AS input_value, {rounded("value")} AS value FROM explained"""),
        "dependence_pairs": with_tables(f"""
SELECT {rounded("input_value")} AS input_value, {rounded("value")} AS value
FROM explained WHERE feature = 'level'"""),
        "decision_paths": with_tables(f"""
SELECT user_id, feature, CAST(row_number() OVER up AS INTEGER) AS step,
  {rounded("(0.25::DOUBLE + sum(value) OVER up)")} AS score
FROM explained JOIN (SELECT feature, row_number() OVER (
    ORDER BY avg(abs(value)) DESC, feature) AS place
  FROM explained WHERE learner = 'click' GROUP BY 1) USING (feature)
WHERE learner = 'click'
WINDOW up AS (PARTITION BY user_id ORDER BY place DESC)"""),
        **dict.fromkeys(("representative_users", "what_if_export"), with_tables(f"""
SELECT user_id, mod_column, base AS baseval, modifier, method,
  {rounded("before")} AS base_prediction, {rounded("later")} AS modified_prediction,
  {rounded("(later - before)")} AS modified_impact
FROM (SELECT user_id, mod_column, method, modifier,
    CASE mod_column WHEN 'acc_age_days' THEN CAST(days AS VARCHAR)
      WHEN 'age' THEN CAST(years AS VARCHAR) ELSE region END AS base,
    days / 10000 + years / 1000 + CASE WHEN region = 'EUROPE' THEN 0.25::DOUBLE ELSE 0 END
      AS before,
    CASE WHEN mod_column <> 'acc_age_days' THEN days WHEN method = 'delta' THEN days + 100
      ELSE 50 END / 10000
    + CASE WHEN mod_column = 'age' THEN years - 2.5::DOUBLE ELSE years END / 1000
    + CASE WHEN mod_column = 'barb_region' OR region = 'EUROPE' THEN 0.25::DOUBLE ELSE 0 END
      AS later
  FROM averages, (VALUES ('acc_age_days', 'delta', '100'), ('acc_age_days', 'replace', '50'),
    ('age', 'delta', '-2.5'), ('barb_region', 'replace', 'EUROPE'))
    m(mod_column, method, modifier))""")),
        "representative_scores": with_tables(f"""
SELECT user_id, {rounded("p")} AS p FROM (SELECT user_id, days / 10000 + years / 1000
  + CASE WHEN region = 'EUROPE' THEN 0.25::DOUBLE ELSE 0 END AS p FROM averages)"""),
        "score_export": with_tables(f"""
SELECT CAST(row_id AS VARCHAR) AS user_id, {week} AS target_week_start_date,
  CASE WHEN name = 'meta' THEN 'meta-learner' ELSE 'weak-learner' END AS learner_type,
  CASE WHEN name = 'meta' THEN 'audio-meta' ELSE name END AS learner_name,
  {rounded("p")} AS predicted_probability, cut AS optimal_threshold,
  CASE WHEN p >= cut THEN 1 ELSE 0 END AS optimal_classification,
  '2001-07-30 12:00:00' AS score_datetime
FROM (SELECT row_id, ts, unnest(['Up', 'Down', 'meta']) AS name,
  unnest([score, 1 - score, 0.5::DOUBLE * score + 0.25]) AS p,
  unnest([0.5::DOUBLE, 0.4, 0.6]) AS cut FROM scored)"""),
        "average_users": with_tables(f"""
SELECT user_id, 'acc_age_days' AS feature, CAST(median(CAST(acc_age_days AS DOUBLE)) AS VARCHAR)
  AS baseval FROM facts JOIN segments_of USING (who) WHERE acc_age_days IS NOT NULL GROUP BY 1
UNION ALL SELECT user_id, 'age', CAST(median(CAST(age AS DOUBLE)) AS VARCHAR)
  FROM facts JOIN segments_of USING (who) WHERE age IS NOT NULL GROUP BY 1
UNION ALL SELECT user_id, 'acorn_group_description', acorn_group_description
  FROM facts JOIN segments_of USING (who) WHERE acorn_group_description IS NOT NULL
  GROUP BY 1, 3 QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY count(*) DESC, acorn_group_description) = 1
UNION ALL SELECT user_id, 'barb_region', barb_region
  FROM facts JOIN segments_of USING (who) WHERE barb_region IS NOT NULL
  GROUP BY 1, 3 QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY count(*) DESC, barb_region) = 1"""),
        "modifiers_csv": """
SELECT 'user_' || c_custkey AS user_id, c_name || ', "x"' || chr(10) AS mod_column,
  CASE WHEN c_custkey % 2 = 0 THEN 'delta' ELSE 'replace' END AS method,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS modifier FROM customer""",
        "attribution_current": with_tables(f"""
SELECT learner, feature, {rounded("input_value")} AS input_value, {rounded("value")} AS value
FROM explained"""),
        "score_csv_rejects": with_tables("""
SELECT user_id, 'kept' AS column_name, CAST(count(*) AS VARCHAR) AS value FROM scored
WHERE CAST(user_id AS BIGINT) % 17 <> 0 AND CAST(user_id AS BIGINT) % 19 <> 0 GROUP BY 1
UNION ALL SELECT user_id, 'predicted_probability', 'n/a' FROM scored
WHERE CAST(user_id AS BIGINT) % 17 = 0
UNION ALL SELECT user_id, 'target_week_start_date', '2024-13-45' FROM scored
WHERE CAST(user_id AS BIGINT) % 19 = 0"""),
        "score_csv_load": with_tables(f"""
SELECT user_id, {week} AS target_week_start_date,
  CASE WHEN event_type = 'purchase' THEN 'meta-learner' ELSE 'weak-learner' END AS learner_type,
  event_type AS learner_name, {rounded("score")} AS predicted_probability,
  0.5::DOUBLE AS optimal_threshold,
  CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS optimal_classification, 'video' AS product
FROM scored"""),
        "score_append": with_tables(f"""
SELECT user_id, {week} AS target_week_start_date,
  CASE WHEN event_type = 'purchase' THEN 'meta-learner' ELSE 'weak-learner' END AS learner_type,
  event_type AS learner_name, {rounded("score")} AS predicted_probability,
  0.5::DOUBLE AS optimal_threshold,
  CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS optimal_classification, product
FROM scored, (VALUES ('video'), ('audio')) p(product)"""),
        "historical_partition": with_tables(f"""
SELECT user_id, event_type AS learner_name, {rounded("score")} AS predicted_probability,
  w AS week_start
FROM scored JOIN (VALUES ('2024-01-01', TRUE), ('2024-01-08', FALSE)) v(w, clicks)
  ON NOT clicks OR event_type = 'click'"""),
        "csv_feature_roundtrip": shown(
            "targets", dates=["target_week_start_date", "target_week_end_date"]),
    }

