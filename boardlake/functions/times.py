"""Times as epoch seconds in UTC, with no use of the session's time zone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardlake.functions.columns import let

DAY = 86400


def utc_date(ts: Column) -> Column:
    """The UTC date of epoch seconds."""
    return F.date_add(F.lit(date(1970, 1, 1)), F.floor(ts / DAY).cast("int"))


def year_of(ts: Column) -> Column:
    return F.year(utc_date(ts))


def month_key(ts: Column) -> Column:
    """YYYY-MM."""
    return F.date_format(utc_date(ts), "yyyy-MM")


def day_key(ts: Column) -> Column:
    return F.date_format(utc_date(ts), "yyyy-MM-dd")


def minute_text(ts: Column) -> Column:
    """YYYY-MM-DD HH:MM."""
    of_day = F.pmod(ts, F.lit(DAY))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.concat(day_key(ts), F.lit(" "), two(of_day / 3600), F.lit(":"), two(of_day % 3600 / 60))


def bucket_key(ts: Column, by: str) -> Column:
    """The bucket of a count by day, month, year or total; null for undated."""
    if by == "total":
        return F.lit("total")
    return {"day": day_key, "month": month_key, "year": lambda t: F.date_format(utc_date(t), "yyyy")}[by](ts)


def day_seconds(day: Column) -> Column:
    """Epoch seconds of a date's midnight in UTC."""
    return F.datediff(day, F.lit(date(1970, 1, 1))).cast("long") * DAY


def parse_bound(text: str, end: bool = False) -> int:
    """Epoch seconds of YYYY, YYYY-MM or YYYY-MM-DD; an end bound is the first second after the unit it names."""
    parts = text.split("-")
    if not 1 <= len(parts) <= 3 or len(parts[0]) != 4 or any(len(p) != 2 for p in parts[1:]) or not all(p.isascii() and p.isdigit() for p in parts):
        raise ValueError(f"not a date: {text!r}")
    y, m, d = (int(p) for p in (parts + ["01", "01"])[:3])
    try:
        at = date(y, m, d)
        if end:
            at = date(y + 1, 1, 1) if len(parts) == 1 else date(y + m // 12, m % 12 + 1, 1) if len(parts) == 2 else at + timedelta(1)
    except ValueError as e:
        raise ValueError(f"no such date: {text!r}") from e
    return (at - date(1970, 1, 1)).days * DAY


def bound_column(text: Column, end: bool = False) -> Column:
    """parse_bound for a column; null where the text is no date."""
    whole = F.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01"))).when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01"))).when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text)
    day = F.try_to_date(whole, "yyyy-MM-dd")
    if end:
        day = F.when(F.length(text) == 4, F.add_months(day, 12)).when(F.length(text) == 7, F.add_months(day, 1)).otherwise(F.date_add(day, 1))
    return day_seconds(day)


def ny_wall_to_utc(wall: Column) -> Column:
    """UTC epoch seconds of a New York wall time that is written as epoch seconds.

    In the hour that spring skips, the wall time is read with the offset after the change; in the hour that autumn repeats,
    the first one is meant.
    """
    return let(wall, lambda w: let(F.year(utc_date(w)), lambda y: w + F.when(_is_summer(w, y), 4 * 3600).otherwise(5 * 3600)))


def _is_summer(wall: Column, y: Column) -> Column:
    """United States rules: from 2007 second Sunday of March to first of November; 1987-2006 first of April to last of October."""

    def sunday(month: int, nth: int) -> Column:
        first = F.make_date(y, F.lit(month), F.lit(1))
        return F.date_add(first, F.pmod(F.lit(8) - F.dayofweek(first), F.lit(7)) + 7 * (nth - 1))

    def last_sunday(month: int) -> Column:
        last = F.last_day(F.make_date(y, F.lit(month), F.lit(1)))
        return F.date_sub(last, F.dayofweek(last) - 1)

    begin = day_seconds(F.when(y >= 2007, sunday(3, 2)).otherwise(sunday(4, 1))) + 2 * 3600
    end = day_seconds(F.when(y >= 2007, sunday(11, 1)).otherwise(last_sunday(10))) + 2 * 3600
    # wall times in the hour that spring skips have no offset of their own
    return (wall >= begin) & (wall < end)


def _wall_seconds(day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """The epoch seconds that a wall time is written as; null where a part is none."""
    fine = day.isNotNull() & (hour < 24) & (minute < 60) & (second < 60)
    return F.when(fine, day_seconds(day) + hour * 3600 + minute * 60 + second)


def parse_mysql_datetime(text: Column) -> Column:
    """UTC epoch seconds of a New York wall time YYYY-MM-DD[ T]HH:MM:SS; null for the zero date and for anything else."""
    parts = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$"), F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)))
    n = lambda p, k: F.get(p, F.lit(k)).try_cast("long")
    wall = let(parts, lambda p: _wall_seconds(F.try_to_date(F.concat_ws("-", F.slice(p, 1, 3)), "yyyy-MM-dd"), n(p, 3), n(p, 4), n(p, 5)))
    return ny_wall_to_utc(wall)


def parse_display_date(text: Column) -> Column:
    """UTC epoch seconds of MM/DD/YY(Day)HH:MM[:SS], a New York wall time of this century; null for anything else."""
    found = F.nullif(F.regexp_extract(text, r"\d{2}/\d{2}/\d{2}\([A-Za-z]{3}\)\d{2}:\d{2}(:\d{2})?", 0), F.lit(""))
    parts = F.regexp_extract_all(found, F.lit(r"\d+"), F.lit(0))
    n = lambda p, k: F.get(p, F.lit(k)).try_cast("long")
    day = lambda p: F.try_to_date(F.concat(F.lit("20"), F.get(p, F.lit(2)), F.lit("-"), F.get(p, F.lit(0)), F.lit("-"), F.get(p, F.lit(1))), "yyyy-MM-dd")
    wall = let(parts, lambda p: _wall_seconds(day(p), n(p, 3), n(p, 4), F.coalesce(n(p, 5), F.lit(0))))
    return ny_wall_to_utc(wall)
