"""Dates: window resolution for parameters, week buckets for columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from paperloom import defaults


def iso_date(raw: str | dt.date) -> dt.date:
    """Parse a ``YYYY-MM-DD`` parameter; anything else is an error."""
    if isinstance(raw, dt.date):
        return raw
    return dt.datetime.strptime(raw, "%Y-%m-%d").date()


def parse_iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` column to date; malformed text fails the query under ANSI mode."""
    return F.to_date(text, "yyyy-M-d")


def try_parse_iso_date(text: Column) -> Column:
    """Like :func:`parse_iso_date`, with null for malformed text."""
    return F.try_to_date(text, "yyyy-M-d")


def resolve_window(
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    days: int = defaults.WINDOW_DAYS,
    as_of: dt.date | None = None,
) -> tuple[dt.date, dt.date]:
    """Inclusive date window: the given dates, or the ``days`` days up to ``end``.

    Without ``end`` the window closes on ``as_of``, or today when that is absent too.
    """
    last = iso_date(end) if end else (as_of or dt.date.today())
    if start:
        first = iso_date(start)
    elif days < 1:
        raise ValueError("a trailing window needs at least one day")
    else:
        first = last - dt.timedelta(days=days - 1)
    if first > last:
        raise ValueError(f"window starts on {first}, after its end {last}")
    return first, last


def day_after(day: dt.date) -> dt.date:
    return day + dt.timedelta(days=1)


def range_slug(start: dt.date, end: dt.date) -> str:
    return f"{start:%Y%m%d}_{end:%Y%m%d}"


def published_date(published: Column) -> Column:
    """The day of an ISO text; null unless year, month and day are all there."""
    full = published.rlike(r"^\d{4}-\d{2}-\d{2}")
    return F.when(full, F.left(published, F.lit(10)).try_cast("date"))


def year_part(published: Column) -> Column:
    return F.left(F.coalesce(published, F.lit("")), F.lit(4))


def month_part(published: Column) -> Column:
    return F.when(F.length(published) >= 7, F.substring(published, 6, 2)).otherwise("")


def day_part(published: Column) -> Column:
    return F.when(F.length(published) >= 10, F.substring(published, 9, 2)).otherwise("")


def week_of_month(day: Column) -> Column:
    """1 for days 1-7 of the month, 2 for 8-14, up to 5."""
    return F.floor((F.dayofmonth(day) - 1) / 7).cast("int") + 1


def week_start(day: Column) -> Column:
    return F.date_add(F.trunc(day, "MM"), (week_of_month(day) - 1) * 7)


def week_end(day: Column) -> Column:
    """Six days after the start, or the last day of the month if that is sooner."""
    return F.least(F.date_add(week_start(day), 6), F.last_day(day))


def week_slug(day: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy_MMM"), F.lit("_Wk"), week_of_month(day))
