"""Fixed thresholds of the delay pipeline, as parameters with reference defaults.

Fixed values (they must equal the reference's for equal results):
  severe delay            >= 300 s
  cascade (moderate) delay >= 180 s
  minor delay             > 0 s
  cascade route share     >= 0.35
  slow route              average speed < 5.0 mph
  staging moderate band   60 .. 299 s
  staging sanity band     -120 .. 7200 s (inclusive)
  rush hours              7..9 and 16..19 (inclusive)
  m/s to mph factor       2.237, rounded to 2 places
  hotspot minimum events  5, over the last 7 days
  model gate              AUC >= 0.78, precision >= 0.70
  training lookback       30 days; profile lookback 12 weeks
  freshness               < 2 hours
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    severe_sec: int = 300
    cascade_sec: int = 180
    minor_sec: int = 0
    cascade_share: float = 0.35
    slow_mph: float = 5.0
    stg_moderate_low: int = 60
    stg_moderate_high: int = 299
    sanity_low: int = -120
    sanity_high: int = 7200
    rush_hours: tuple = ((7, 9), (16, 19))
    ms_to_mph: float = 2.237
    hotspot_min_events: int = 5
    hotspot_days: int = 7
    min_auc: float = 0.78
    min_precision: float = 0.70
    training_days: int = 30
    profile_weeks: int = 12
    max_freshness_hours: float = 2.0


DEFAULT = Thresholds()

# Severity labels, in the order the classifier tests them.
SEVERITIES = ("SEVERE", "MODERATE", "MINOR", "ON_TIME")

# Stop schedule relationship enum, protobuf number -> name.
SCHEDULE_RELATIONSHIP = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA"}

# Topic names.
TOPIC_VEHICLE_POSITIONS = "gtfs.vehicle_positions"
TOPIC_TRIP_UPDATES = "gtfs.trip_updates"

# Default event-time settings of the streaming jobs.
VEHICLE_WINDOW = ("5 minutes", "1 minute")
TRIP_WINDOW = ("10 minutes", "2 minutes")
VEHICLE_WATERMARK = "2 minutes"
TRIP_WATERMARK = "5 minutes"
