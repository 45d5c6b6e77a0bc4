"""Settings shared by all jobs: calendar, products, genres, business rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

FRESH_COHORT = -2
FEATURE_WEEKS = range(2, 15)
PIVOT_WEEKS = range(0, 15)
PRODUCTS = ("video", "audio")

# Genre suffix, prefix of the genre string, suffix used for release counts.
GENRES = (
    ("comedy", "Comedy", "comedies"),
    ("drama", "Drama", "dramas"),
    ("ents", "Entertainment", "ents"),
    ("childrens", "Children", "childrens"),
    ("factual", "Factual", "factual"),
    ("learning", "Learning", "learning"),
    ("music", "Music", "music"),
    ("news", "News", "news"),
    ("religion", "Religion & Ethics", "religion"),
    ("sport", "Sport", "sport"),
    ("weather", "Weather", "weather"),
)

# Listening types in order of preference when shares tie.
LISTENING_DETAIL = (
    ("live_radio", "live-radio"),
    ("od_app_podcasts", "app-podcasts"),
    ("od_app_mixes", "app-mixes"),
    ("od_radio_podcasts", "radio-podcasts"),
    ("od_linear_mixes", "linear-mixes"),
    ("od_radio", "radio"),
)
LISTENING_COARSE = (
    ("radio", "radio", ("live_radio", "od_radio")),
    ("od_podcasts", "podcasts", ("od_app_podcasts", "od_radio_podcasts")),
    ("od_mixes", "mixes", ("od_app_mixes", "od_linear_mixes")),
)

# Device types that are summed, in order of preference when shares tie.
DEVICE_TYPES = (
    ("desktop_web", "desktop-web"),
    ("app", "mobile-app"),
    ("mobile_web", "mobile-web"),
    ("smart_tv", "smart-tv"),
    ("other_web", "other-web"),
)

# Hour bands, first and last hour.
HOUR_BANDS = (
    ("breakfast", 6, 9),
    ("daytime", 10, 16),
    ("earlypeak", 17, 19),
    ("peak", 20, 21),
    ("late", 22, 23),
    ("overnight", 0, 5),
)

# Spark's weekday() numbers, Monday first.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# String sentinels that stand for a missing value, per use.
TITLE_SENTINELS = ("n/a", "", "null")
ID_SENTINELS = ("N/A", "", "null")
NULL_SENTINEL = ("null",)

# User action rules, (feature, resource types, activity, domains).
FOLLOW_RULES = (
    ("video_programme_follows", ("brand",), "FOLLOWS", ("tv",)),
    ("audio_subscribes", ("brand", "genre", "clip", "artist", "playlist", "series"),
     "FOLLOWS", ("music", "radio")),
    ("audio_bookmarks", ("track", "clip", "episode"), "FAVOURITES", ("music", "radio")),
)

SEGMENT_PRODUCTS = ("video", "audio", "news", "sport", "kids", "preschool", "weather", "all")
SEGMENT_DEFAULT = "X. Inactive"
ADULT_AGE_RANGES = ("16-19", "20-24", "25-29", "30-34")


@dataclass(frozen=True)
class ChurnConfig:
    """One weekly run. ``max_date`` is a Sunday, the last day of the newest full week."""

    max_date: date
    n_cohorts: int = 6
    salt: str = "cohort"
    destinations: dict = field(
        default_factory=lambda: {"VIDEO_APP": "video", "AUDIO_APP": "audio"})
    radio_app_names: dict = field(default_factory=lambda: {"VIDEO_APP": ("R",)})
    event_seconds: int = 180
    last_week_seconds: int = 600
    active_seconds: int = 180
    genre_week_floor: int = 2
    named_brands: tuple = ()
    podcast_master_brand: str = "app_podcasts"
    mixes_master_brand: str = "App Mixes"
    radio_master_brand: str = "Radio"
    schedule_since: date = date(2017, 1, 1)
    factors: dict = field(default_factory=lambda: {"video": 10, "audio": 20})

    @property
    def extract_min_date(self) -> date:
        return self.max_date - timedelta(days=7 * (self.n_cohorts + 17))

    @property
    def window_min_date(self) -> date:
        """Oldest first day of any cohort's feature window."""
        return self.max_date - timedelta(days=7 * (self.n_cohorts + 14) - 1)

    @property
    def window_max_date(self) -> date:
        """Newest last day of any cohort's feature window."""
        return self.max_date - timedelta(days=7 * FRESH_COHORT + 14)

    @property
    def max_week(self) -> date:
        """Monday of the newest full week: the target week end of cohort 0."""
        return self.max_date - timedelta(days=self.max_date.weekday())
