"""Clock parsing, date-time assembly, time-zone moves, grid rounding.

All timestamps are ``timestamp_ntz`` (wall-clock values), so results do not
depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from windshear.functions.casts import _col


def hhmm_minutes(raw: Column | str, *, midnight_is_next_day: bool = False) -> Column:
    """C1 core: ``HHMM`` text (1-4 digits) to minutes since midnight.

    Short values are left-padded (``130`` is 01:30, ``5`` is 00:05; D1). Null,
    non-numeric, ``2400``, an hour above 23 or a minute above 59 give 0, i.e.
    00:00 (D2). With ``midnight_is_next_day`` the value ``2400`` gives 1440.
    """
    s = _col(raw)
    # Digits only (no sign, blank or trailing newline) with a valid minute and
    # hour, so the integer reading equals the left-padded HHMM reading (930 is
    # 09:30, 5 is 00:05) and each full hour counts 40 minutes too many.
    n = s.try_cast("int")
    minutes = F.when(s.rlike(r"^(?:(?:[01]?[0-9]|2[0-3])[0-5][0-9]|[0-5]?[0-9])\z"),
                     n - 40 * F.floor(n / F.lit(100)).cast("int"))
    if midnight_is_next_day:
        minutes = minutes.when(s == "2400", F.lit(1440))
    return minutes.otherwise(F.lit(0))


def minutes_to_clock(minutes: Column | str) -> Column:
    """Minutes since midnight to ``HH:MM``."""
    m = _col(minutes)
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), (m % 60).cast("int"))


def hhmm_to_clock(raw: Column | str) -> Column:
    """``HHMM`` text to ``HH:MM`` text with the D1/D2 rules."""
    return minutes_to_clock(hhmm_minutes(raw))


def at_minutes(date: Column | str, minutes: Column | str) -> Column:
    """A date plus minutes after its midnight, as ``timestamp_ntz``."""
    return F.timestamp_add("MINUTE", _col(minutes), _col(date).cast("timestamp_ntz"))


def combine_date_clock(date: Column | str, clock: Column | str) -> Column:
    """A date and an ``HH:MM`` text to a ``timestamp_ntz``."""
    c = _col(clock)
    minutes = F.substring(c, 1, 2).try_cast("int") * 60 + F.substring(c, 4, 2).try_cast("int")
    return at_minutes(date, minutes)


def utc_to_zone(ts: Column | str, zone: str | Column) -> Column:
    """C4: UTC wall time to wall time in ``zone``. No ambiguity in this direction."""
    z = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), z, _col(ts))


def zone_to_zone(ts: Column | str, source_zone: Column | str, target_zone: str) -> Column:
    """Wall time in a per-row zone to wall time in ``target_zone``.

    D8: an ambiguous local hour (autumn fall-back) resolves to standard time,
    a skipped hour (spring gap) is read with the offset before the gap. Spark
    alone picks the daylight offset on overlap, so the later of the two
    candidate instants (``t`` and ``t + 1h`` shifted back) is taken. A NULL
    zone (airport missing from the dimension, D9) gives NULL.
    """
    t = _col(ts)
    z = F.col(source_zone) if isinstance(source_zone, str) else source_zone
    direct = F.convert_timezone(z, F.lit("UTC"), t)
    shifted = F.timestamp_add(
        "HOUR", F.lit(-1), F.convert_timezone(z, F.lit("UTC"), F.timestamp_add("HOUR", F.lit(1), t))
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(target_zone), F.greatest(direct, shifted))


def round_to_grid(ts: Column | str, grid_seconds: int = 300) -> Column:
    """Round to the nearest grid step, halves up, sub-seconds dropped.

    Carries over midnight (23:57:30 -> next day 00:00). NULL stays NULL (D10).
    """
    t = _col(ts)
    second_of_day = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    snapped = F.floor((second_of_day + F.lit(grid_seconds / 2.0)) / F.lit(float(grid_seconds))) * grid_seconds
    return F.timestamp_add("SECOND", snapped, F.to_date(t).cast("timestamp_ntz"))


def timestamp_literal(value: str | _dt.datetime | _dt.date) -> Column:
    """A wall-clock literal, independent of the session time zone (D22: typed, no SQL text)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(value)).cast("timestamp_ntz")


def day_bounds(start: str | _dt.date, end: str | _dt.date, *, inclusive_end: bool = False) -> tuple[Column, Column]:
    """a day range to half-open time bounds ``[start 00:00, end 23:59)``.

    ``inclusive_end=True`` uses the next midnight, so the last minute counts.
    """
    s = _dt.date.fromisoformat(str(start))
    e = _dt.date.fromisoformat(str(end))
    lo = _dt.datetime.combine(s, _dt.time(0, 0))
    hi = (_dt.datetime.combine(e, _dt.time(0, 0)) + _dt.timedelta(days=1)) if inclusive_end \
        else _dt.datetime.combine(e, _dt.time(23, 59))
    return timestamp_literal(lo), timestamp_literal(hi)
