"""Roles of feature columns and feature lists of learners, by naming convention."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from ebbtide.config import FEATURE_WEEKS

# Identifiers and targets, never features.
IDS = ("user_id", "destination", "target_week_start_date", "target_churn_this_week",
       "target_churn_next_week", "active_last_week", "train", "train_eligible", "cohort",
       "ew_0", "ew_1")
# 0/1 flags that need no encoding.
FLAGS = ("mkt_opted_in", "profile_enablepersonalisation", "profile_mailverified",
         "profile_age_1634_enriched", "video_user", "video_active_last_week", "audio_user",
         "audio_active_last_week", "video_lin_reg_churn_flag", "audio_lin_reg_churn_flag",
         "lw_watched_finale_flag")
# Columns filled by a model, and how.
IMPUTED = {
    "profile_age": "regression",
    "profile_nation": "classification",
    "profile_barb_region": "classification",
    "profile_acorn_type_description": "classification",
    "profile_acorn_group_description": "classification",
    "profile_acorn_category_description": "classification",
    "profile_gender_enriched": "classification",
}
HELPERS = (*[f"ew_{w}" for w in FEATURE_WEEKS], "lw_distinct_series", "lw_distinct_episodes",
           "genre_share_drama", "genre_share_comedy", "genre_share_sport", "genre_share_music")
PREPARED_ROLES = ("continuous", "factor")


def other_product(product: str) -> str:
    return "audio" if product == "video" else "video"


def _is_continuous(product: str) -> Callable[[str], bool]:
    named = {"profile_age", "profile_acc_age_days", "streaming_time_13w", "lw_distinct_series",
             "lw_distinct_episodes", "lw_series_finales", "lw_avg_episode_repeats",
             f"{product}_weeks_since_activation"}
    named |= {f"{kind}_{w}" for kind in ("stw", "ew") for w in FEATURE_WEEKS}
    named |= {f"{p}_{t}" for p in ("video", "audio")
              for t in ("lin_reg_coeff", "13w_yintercept", "13w_xintercept")}
    parts = ["genre_st_", "genre_share_", "releases_", "sched_match", f"{product}_activ_f",
             f"{product}_fav_f", "mkt_days_", "mkt_email_"]
    if product == "video":
        named |= {"genre_distinct_count", "lw_series_premieres"}
        parts += ["video_tod_", "video_dow_", "video_programme_follows_"]
    else:
        parts += ["audio_subscribes_", "audio_bookmarks_"]
    unless_preferred = [f"{product}_prod_", "device_"]

    def test(name: str) -> bool:
        return (name in named or any(p in name for p in parts)
                or any(p in name for p in unless_preferred) and "preferred" not in name)

    return test


def _is_factor(product: str) -> Callable[[str], bool]:
    other = other_product(product)
    named = {
        "profile_enablepersonalisation", "profile_mailverified", "profile_nation",
        "profile_barb_region", "profile_acorn_type_description",
        "profile_acorn_group_description", "profile_acorn_category_description",
        "profile_age_1634_enriched", "profile_gender_enriched",
        f"{other}_user", f"{other}_active_last_week", "video_lin_reg_churn_flag",
        "audio_lin_reg_churn_flag", "lw_watched_finale_flag", f"{product}_activating_genre",
        f"{product}_activating_masterbrand", "mkt_opted_in",
        *[f"{p}_fav_content_{k}" for p in ("video", "audio") for k in ("genre", "masterbrand")]}

    def test(name: str) -> bool:
        return (name in named or "freq_seg_latest_" in name
                or "device_" in name and "preferred" in name
                or f"{product}_prod_" in name and "preferred" in name)

    return test


def feature_registry(columns: Iterable[str], product: str) -> dict[str, str]:
    """Column to role: id, factor, continuous or unclassified."""
    factor, continuous = _is_factor(product), _is_continuous(product)
    roles = {}
    for c in columns:
        roles[c] = ("id" if c in IDS else "factor" if factor(c)
                    else "continuous" if continuous(c) else "unclassified")
    return roles


def sqrt_candidates(columns: Iterable[str]) -> list[str]:
    """Lop-sided columns that may be replaced by their square root."""
    return [c for c in columns
            if any(p in c for p in ("genre_st_", "genre_share_", "ew_", "mkt_email_"))
            or "device_" in c and "perc" not in c]


def has_any(*parts: str) -> Callable[[str], bool]:
    return lambda name: any(p in name for p in parts)


def demographic(name: str) -> bool:
    return (has_any("acorn_", "gender_", "nation_", "barb_")(name)
            or name in ("profile_age", "profile_age_1634_enriched"))


def explorer(name: str) -> bool:
    # The hand-picked exploration list.
    exact = {"streaming_time_13w", "profile_age_1634_enriched", "profile_gender_enriched_female",
             "profile_nation_England", "profile_barb_region_London", "profile_acc_age_days",
             "profile_mailverified", "profile_enablepersonalisation", "sched_match_index",
             "sqrt_genre_share_comedy", "mkt_opted_in", "sqrt_mkt_email_opens_13w",
             "video_programme_follows_13w"}
    parts = ("device_video_st_smart_tv_perc", "lw_distinct_series", "series_finales",
             "avg_episode_repeats", "freq_seg_latest_video_A_",
             "profile_acorn_type_description_Socialising_young_renters",
             "video_activating_genre_Sport", "video_fav_content_genre_Drama")
    return name in exact or has_any(*parts)(name)


def _rules(stack: str, product: str) -> dict[str, tuple[str, Callable[[str], bool]]]:
    other_segments = (lambda name: "freq_seg_" in name and product not in name
                      and "latest_all" not in name)
    finer = has_any("lw_series_premieres", "lw_series_finales", "lw_distinct_series",
                    "lw_distinct_episodes")
    content = has_any("genre_distinct_count", "genre_share", "sched_match_index")

    def behaviour(name: str) -> bool:
        return (finer(name)
                or has_any(f"{product}_device_count", f"device_{product}_st_preferred",
                           f"{product}_tod_", f"{product}_dow_")(name)
                or f"device_{product}_st_" in name and "perc" in name)

    marketing = has_any("mkt_opted_in", "mkt_days_", "mkt_email_",
                        "profile_enablepersonalisation", "profile_mailverified")
    everything = (lambda name: True)

    if stack == "diverse":
        rules = {"Content": ("gbt", content), "Behaviour": ("gbt", behaviour),
                 "Marketing": ("gbt", marketing), "Cross-Sell": ("gbt", other_segments)}
        if product == "audio":
            rules["Product Type"] = ("gbt", lambda name: "audio_prod_" in name and (
                "perc" in name or "preferred" in name))
        return rules
    if stack == "logistic":
        with_content = has_any("genre_distinct_count", "genre_share", "sched_match_index",
                               f"{product}_fav_content_genre", f"{product}_fav_content_masterbrand")
        follows = (lambda name: finer(name) or f"{product}_programme_follows_" in name)
        mail = has_any("mkt_opted_in", "mkt_email_", "profile_enablepersonalisation",
                       "profile_mailverified")
        selectable = (lambda name: not has_any(
            "ew_", "stw_", "streaming_time", "yintercept")(name))
        return {"Content": ("logr", with_content), "Behaviour": ("logr", follows),
                "Marketing": ("logr", mail), "Cross-Sell": ("logr", other_segments),
                "RFE-Optimised": ("logr", selectable), "RFE-Boosted": ("gbt", selectable)}
    events, index = has_any("ew_"), has_any("sched_match_index_")
    if stack == "boosted":
        return {"event_gbt": ("gbt", events), "index_gbt": ("gbt", index),
                "big_gbt": ("gbt", everything), "little_gbt": ("gbt", everything),
                "demo_gbt": ("gbt", demographic)}
    if stack == "simple":
        # cherry_logr starts from the features big_gbt selects, so it comes after it
        rules = {"event_logr": ("logr", events), "index_logr": ("logr", index),
                 "big_gbt": ("gbt", everything), "cherry_logr": ("logr", everything),
                 "demo_gbt": ("gbt", demographic)}
        if product == "video":
            rules["explorer_gbt"] = ("gbt", explorer)
        return rules
    raise ValueError(f"unknown stack {stack}")


# How many features a selection step leaves, or whose selection is taken over.
SELECTED = {"big_gbt": ("gain", 30), "little_gbt": ("gain", 30), "cherry_logr": ("rfe", 15),
            "RFE-Optimised": ("rfe", 30), "RFE-Boosted": ("as", "RFE-Optimised")}
BOOSTED_SELECTED = {"big_gbt": ("gain", 100)}


def stack_config(stack: str, product: str, columns: Iterable[str]) -> dict[str, dict]:
    """Learner name to algorithm, candidate features and selection step of a stack."""
    columns = list(columns)
    chosen = {**SELECTED, **(BOOSTED_SELECTED if stack == "boosted" else {})}
    return {name: {"algorithm": algorithm, "features": [c for c in columns if rule(c)],
                   "select": chosen.get(name)}
            for name, (algorithm, rule) in _rules(stack, product).items()}
