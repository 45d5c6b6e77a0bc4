"""Declared schemas of the sources and of the score record."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(),
         "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}


def _struct(text: str) -> T.StructType:
    """Schema from "name type, ..." without needing a session."""
    fields = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


ACTIVITY = _struct(
    "user_id string, destination string, app_name string, page_name string, "
    "date_of_event date, event_ts timestamp, version_id string, episode_id string, "
    "series_id string, brand_id string, clip_id string, broadcast_type string, "
    "device_type string, browser_brand string, genre_names string, "
    "playback_time bigint, page_views bigint")
CATALOGUE = _struct(
    "version_id string, episode_id string, series_id string, brand_id string, "
    "media_type string, brand_title string, series_title string, programme_title string, "
    "episode_title string, presentation_title string, clip_title string, genre_names string, "
    "genre_list string, tx_date string, tx_start string, programme_duration string, "
    "format_names string, "
    "master_brand_id string, master_brand_name string, version_type string, content_kind string")
PROFILE = _struct(
    "user_id string, enable_personalisation string, mail_verified string, created_date date, "
    "age string, gender string, location string, status string")
PROFILE_EXTENSION = _struct(
    "user_id string, age_range string, nation string, barb_region string, "
    "acorn_type_description string, acorn_group_description string, "
    "acorn_category_description string, acorn_category string")
GENDER_PREDICTIONS = _struct("user_id string, predicted_gender string")
AGE_PREDICTIONS = _struct("user_id string, predicted_age string")
SEGMENTS = _struct(
    "user_id string, product string, date_of_segmentation date, segment string")
AUDIO_ACTIVATIONS = _struct("user_id string, week_beginning date, episode_id string")
VIDEO_ACTIVATIONS = _struct("user_id string, week_beginning date, version_id string")
USER_ACTIONS = _struct(
    "user_id string, action_date date, resource_type string, activity_type string, "
    "resource_domain string")
NEWSLETTER_ACTIONS = _struct(
    "user_id string, action_date date, server_time timestamp, action string, "
    "activity_type string, resource_type string, resource_domain string, resource_id string")
EMAIL_EVENTS = _struct("user_id string, send_id string, event_ts timestamp")
MODIFIERS = _struct("user_id string, mod_column string, method string, modifier string")
SCORES = _struct(
    "user_id string, target_week_start_date date, learner_type string, learner_name string, "
    "predicted_probability double, optimal_threshold double, optimal_classification int, "
    "score_datetime timestamp")


def item_factors(n: int) -> T.StructType:
    return _struct("content_id string, " + ", ".join(f"f{i} double" for i in range(n)))


SOURCES = {
    "activity": ACTIVITY,
    "catalogue": CATALOGUE,
    "profile": PROFILE,
    "profile_extension": PROFILE_EXTENSION,
    "gender_predictions": GENDER_PREDICTIONS,
    "age_predictions": AGE_PREDICTIONS,
    "segments": SEGMENTS,
    "audio_activations": AUDIO_ACTIVATIONS,
    "video_activations": VIDEO_ACTIVATIONS,
    "user_actions": USER_ACTIONS,
    "newsletter_actions": NEWSLETTER_ACTIONS,
    "email_opens": EMAIL_EVENTS,
    "email_clicks": EMAIL_EVENTS,
    "podcast_list": _struct("tleo_id string"),
    "mixes_list": _struct("episode_id string"),
    "mix_exceptions": _struct("episode_id string"),
}
