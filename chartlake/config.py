"""Run-time parameters of the warehouse and its marts.

Everything the marts treat as a constant (country, thresholds, bucket edges,
labels, period table, HAVING limits) lives here so a caller can change it
without touching an operator.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# Fixed values that must stay as they are for the results to agree with the
# reference behaviour (bucket edges, thresholds, note names, season months).
# ---------------------------------------------------------------------------
# Season by month: 12, 1, 2 -> winter; 3-5 -> spring; 6-8 -> summer;
# 9-11 -> autumn.
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)
# Note names for key codes 0..11.
NOTE_NAMES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")
# Mode suffix: minor (0) -> "m", major (1) -> "".
MINOR_SUFFIX = "m"
# Sunshine buckets (hours): == 0, < 4, < 8, < 12, else.
SUNSHINE_EDGES = (4.0, 8.0, 12.0)
# Acousticness: > 0.7 acoustic, < 0.3 electronic, else hybrid.
ACOUSTIC_HIGH = 0.7
ACOUSTIC_LOW = 0.3
# Day weather: precipitation > 5 mm rain, else sunshine > 8 h sun.
RAIN_MM = 5.0
SUN_HOURS = 8.0
# Week weather: rain > 5 mm, else sunshine > 12 h very sunny, else > 8 h sunny.
VERY_SUNNY_HOURS = 12.0
# Trend label thresholds (absolute change): features, weather.
FEATURE_TREND_THRESHOLD = 0.005
WEATHER_TREND_THRESHOLD = 0.5
# Validation limits.
MIN_WEATHER_ROWS = 300
MIN_TRACK_ROWS = 3000
MIN_FEATURE_COVERAGE = 0.90
MIN_WEATHER_LINKAGE = 0.99
# Chart size per week and fetch batch sizes.
TOP_N = 200
CHART_BATCH_WEEKS = 10
FEATURE_BATCH_SONGS = 50
MISSING_FEATURE_CAP = 200
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Labels:
    """Display labels; the marts group and sort on these."""

    winter: str = "Winter"
    spring: str = "Spring"
    summer: str = "Summer"
    autumn: str = "Autumn"
    sun_dark: str = "0h"
    sun_1_4: str = "1-4h"
    sun_4_8: str = "4-8h"
    sun_8_12: str = "8-12h"
    sun_12: str = "12h+"
    acoustic: str = "Acoustic"
    electronic: str = "Electronic"
    hybrid: str = "Hybrid"
    rain: str = "Rain"
    sun: str = "Sun"
    week_rain: str = "Rainy (>5mm)"
    week_sunny: str = "Sunny (8-12h)"
    week_very_sunny: str = "Very sunny (>12h)"
    up: str = "up"
    down: str = "down"
    flat: str = "flat"

    @property
    def season_order(self) -> tuple[str, ...]:
        return (self.spring, self.summer, self.autumn, self.winter)

    @property
    def week_weather_order(self) -> tuple[str, ...]:
        return (self.week_rain, self.week_sunny, self.week_very_sunny)


@dataclass(frozen=True)
class MartConfig:
    """Parameters of the analytical marts."""

    country: str | None = "de"
    top_limit: int = 3
    sunshine_min_count: int = 20
    acoustic_min_count: int = 10
    # Closed date ranges of the event periods and the baseline range.
    # No default: the period comparison needs both and says so.
    periods: tuple[tuple[_dt.date, _dt.date], ...] = ()
    baseline: tuple[_dt.date, _dt.date] | None = None
    labels: Labels = field(default_factory=Labels)
    # Reference parity: NULL sunshine falls in the last bucket.  Set to a label
    # to give NULL sunshine its own bucket instead.
    null_sunshine_bucket: str | None = None


@dataclass(frozen=True)
class LoadConfig:
    """Parameters of the loaders."""

    country: str = "de"
    default_name: str = "Unknown"
    top_n: int = TOP_N
    chart_batch_weeks: int = CHART_BATCH_WEEKS
    feature_batch_songs: int = FEATURE_BATCH_SONGS
    # One fetch run's budget; None: all missing features.
    missing_feature_cap: int | None = None


DEFAULT_MART = MartConfig()
DEFAULT_LOAD = LoadConfig()
