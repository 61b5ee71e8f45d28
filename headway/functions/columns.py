"""Column expressions shared by the operators.

All are built-in Spark SQL expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.thresholds import DEFAULT, Thresholds


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_dec(x, n: int) -> Column:
    """Round half away from zero on the decimal view of a double.

    Native ``round(double, n)`` decides ties on the binary value, which
    differs between engines in the last bit.  Going through a 12-place
    decimal first makes the result engine independent; it differs from the
    native round by one last digit at ties only.
    """
    return F.round(_c(x).cast("decimal(38,12)"), n).cast("double")


def safe_ratio(num, den) -> Column:
    """``num / nullif(den, 0)`` as double division."""
    d = _c(den)
    return _c(num).cast("double") / F.when(d != 0, d.cast("double"))


def delay_severity(max_delay, th: Thresholds = DEFAULT) -> Column:
    """Severity class, first match wins; a NULL delay falls to ON_TIME."""
    d = _c(max_delay)
    return (
        F.when(d >= th.severe_sec, "SEVERE")
        .when(d >= th.cascade_sec, "MODERATE")
        .when(d > th.minor_sec, "MINOR")
        .otherwise("ON_TIME")
    )


def is_rush_hour(hour, th: Thresholds = DEFAULT) -> Column:
    h = _c(hour)
    cond = None
    for lo, hi in th.rush_hours:
        c = h.between(lo, hi)
        cond = c if cond is None else (cond | c)
    return cond


def cascade_score(delayed_pct, total_trips) -> Column:
    """int(min(100, pct * 100 * total / 10)), truncated toward zero."""
    return F.least(
        F.lit(100.0), _c(delayed_pct) * 100 * (_c(total_trips) / 10)
    ).cast("int")


def clamp_score(x, null_score: str = "reference") -> Column:
    """greatest(0, least(100, x)).

    ``reference``: like the reference, a NULL x reads as 100 because
    greatest/least skip NULLs.  ``propagate``: NULL stays NULL.
    """
    v = _c(x)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), v))
    if null_score == "propagate":
        return F.when(v.isNotNull(), clamped)
    if null_score != "reference":
        raise ValueError(f"null_score must be 'reference' or 'propagate', not {null_score!r}")
    return clamped


def mph_from_ms(speed, th: Thresholds = DEFAULT) -> Column:
    """m/s to mph at 2 places; 0.0 when the speed is zero or unset."""
    s = _c(speed)
    return F.when(s.isNotNull() & (s != 0), F.round(s * th.ms_to_mph, 2)).otherwise(F.lit(0.0))


def iso_utc(ts) -> Column:
    """Timestamp to ISO-8601 text at whole seconds with an explicit offset
    (``+00:00`` under a UTC session), as the producer writes it."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")


def utc_literal(moment: dt.datetime) -> Column:
    """A timestamp literal; a naive datetime is UTC, whatever zone the driver's
    machine or the session is in."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def as_of_ts(as_of) -> Column:
    """``as_of`` as a timestamp: None is now, text is read in the session's zone."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, dt.datetime):
        return utc_literal(as_of)
    return F.lit(str(as_of)).cast("timestamp")


def as_of_date(as_of) -> Column:
    """``as_of`` as a date; of a naive datetime, its own date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, dt.datetime):
        moment = as_of if as_of.tzinfo is None else as_of.astimezone(dt.timezone.utc)
        return F.lit(moment.date())
    if isinstance(as_of, dt.date):
        return F.lit(as_of)
    return as_of_ts(as_of).cast("date")


def event_time(text) -> Column:
    """ISO text to event time; unparseable text gives NULL instead of failing."""
    return F.try_to_timestamp(_c(text))
