"""Row-local column expressions. All stay inside JVM code generation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0088
MIN_GAP_H = 1.0 / 60.0
NIGHT_HOURS = (0, 1, 2, 3, 4, 5)
DAYS_PER_YEAR = 365.25
MICROS_PER_HOUR = 3_600_000_000
HALF_PI = math.pi / 2


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def event_time(column) -> Column:
    """Event time as an instant; strings are parsed, zone-less timestamps are read in the session zone."""
    return _c(column).cast("timestamp")


def lenient_date(column) -> Column:
    """A date, or null where the text is not one."""
    return _c(column).try_cast("date")


def micros(column) -> Column:
    return F.unix_micros(event_time(column))


def hour_of_day(column) -> Column:
    return F.hour(event_time(column))


def day_of_week(column) -> Column:
    """0 is Monday."""
    return F.weekday(event_time(column))


def is_night(column, hours: Sequence[int] = NIGHT_HOURS) -> Column:
    return hour_of_day(column).isin(*hours).cast("int")


def age_days(ts, dob) -> Column:
    return F.datediff(event_time(ts), _c(dob))


def age_years(ts, dob) -> Column:
    """Whole days lived over 365.25, not rounded; null without a birth date."""
    return age_days(ts, dob) / F.lit(DAYS_PER_YEAR)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(nan_to_null(v)) for v in (lat1, lon1, lat2, lon2))
    chord = (F.pow(F.sin((lat2 - lat1) / 2.0), F.lit(2.0))
             + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2.0), F.lit(2.0)))
    # Rounding can push the chord of opposite points just above 1, where asin is NaN.
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.nanvl(F.asin(F.sqrt(chord)), F.lit(HALF_PI))


def implied_speed(dist_km, gap_h) -> Column:
    """Offline rule: no positive gap means no speed; gaps under a minute count as a minute."""
    dist_km, gap_h = _c(dist_km), _c(gap_h)
    speed = F.when(gap_h > 0, dist_km / F.greatest(gap_h, F.lit(MIN_GAP_H)))
    return number_or_zero(speed)


def number_or_zero(column) -> Column:
    return F.coalesce(F.nanvl(_c(column), F.lit(0.0)), F.lit(0.0))


def nan_to_null(column) -> Column:
    return F.nanvl(_c(column).cast("double"), F.lit(None).cast("double"))


def decision(p, threshold: float) -> Column:
    return F.when(_c(p) >= F.lit(float(threshold)), "fraud").otherwise("not_fraud")


def known_category(column, vocabulary: Sequence[str]) -> Column:
    """The value where training has seen it, else null."""
    value = _c(column)
    return F.when(value.isin(*vocabulary), value)


def category_code(column, vocabulary: Sequence[str]) -> Column:
    """Position in the sorted training vocabulary; -1 for null and unseen values."""
    value = _c(column)
    position = F.array_position(F.array(*[F.lit(v) for v in sorted(vocabulary)]), value)
    return F.coalesce(position.cast("int") - F.lit(1), F.lit(-1))


def clip(column, low, high) -> Column:
    value = _c(column)
    bounded = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), bounded)


def online_clock(unix_time, ts) -> Column:
    """Seconds since the epoch: the numeric clock where present, else the parsed timestamp."""
    return F.coalesce(_c(unix_time).cast("long"), F.unix_timestamp(event_time(ts)))


def half_even(column, digits: int) -> Column:
    return F.bround(_c(column), digits)


def uniform_from_id(*parts) -> Column:
    """Reproducible number in [0, 1) from the text of `parts`; the same in every engine with md5."""
    text = F.concat_ws(":", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
