"""Times: text and epoch forms to UTC, and flooring. The session runs in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col, or_empty

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Numbers below this are seconds, others milliseconds; the range that
# four-digit years cover, in seconds.
SECONDS_BELOW = 10_000_000_000
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def iso(ts: Column | str) -> Column:
    """Timestamp to ``2024-01-31T13:30:00Z``; null stays null."""
    return F.date_format(col(ts), ISO)


def epoch_number(c: Column | str) -> Column:
    """Number in a text, else null.

    JSON numbers with a fraction or exponent arrive as ``1.7E12`` and are cut to whole
    numbers.
    """
    text = col(c)
    # a failing cast is slow, so text that is no number is told apart first
    whole = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint"))
    decimal = F.when(
        text.rlike(r"^-?[0-9]+\.[0-9]+(E-?[0-9]+)?$"), text.try_cast("double").try_cast("bigint"))
    return F.coalesce(whole, decimal)


def number_seconds(n: Column | str) -> Column:
    """Epoch seconds of a number in seconds or milliseconds; null outside four-digit years."""
    n = col(n)
    seconds = F.when(n < SECONDS_BELOW, n).otherwise(F.call_function("div", n, F.lit(1000)))
    return F.when(n.between(FIRST_SECOND, LAST_SECOND * 1000 + 999), seconds)


def epoch_seconds(c: Column | str) -> Column:
    return number_seconds(epoch_number(c))


def epoch_to_iso(c: Column | str, seconds: Column | str | None = None) -> Column:
    """Epoch text to ISO text; other text is kept, cut to 64; null gives ``""``.

    ``seconds`` may hold the number if it is known already.
    """
    c = col(c)
    known = epoch_seconds(c) if seconds is None else col(seconds)
    return F.coalesce(iso(F.timestamp_seconds(known)), F.substring(c, 1, 64), F.lit(""))


def ms_to_iso(ms: Column | str) -> Column:
    """Epoch milliseconds (bigint) to ISO text; null, 0 or out of range gives ``""``."""
    ms = col(ms)
    usable = (ms != 0) & ms.between(FIRST_SECOND * 1000, LAST_SECOND * 1000 + 999)
    return or_empty(iso(F.timestamp_millis(F.when(usable, ms))))


def history_ts(c: Column | str) -> Column:
    """History-server time (optional fraction, optional ``GMT``) to ISO text."""
    c = or_empty(c)
    shape = (
        r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"
        r"(\.[0-9]{1,6})?(GMT)?$"
    )
    parsed = F.try_to_timestamp(
        F.nullif(F.regexp_extract(c, shape, 1), F.lit("")), F.lit("yyyy-M-d'T'H:m:s"))
    return F.coalesce(
        iso(parsed),
        F.when(F.length(c) >= 19, F.concat(F.left(c, F.lit(19)), F.lit("Z"))).otherwise(c))


def safe_ts(c: Column | str) -> Column:
    """Cut a text with a ``T`` to whole seconds and close it with ``Z``."""
    c = or_empty(c)
    return F.when(
        c.contains("T") & (F.length(c) >= 19), F.concat(F.left(c, F.lit(19)), F.lit("Z"))
    ).otherwise(c)


def parse_iso(c: Column | str) -> Column:
    """Text of the form ``2024-01-31T13:30:00Z`` to a timestamp; anything else is null.

    Fields after the year may have one digit.
    """
    c = col(c)
    shape = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}Z$"
    return F.try_to_timestamp(F.when(c.rlike(shape), c), F.lit("yyyy-M-d'T'H:m:s'Z'"))


def date_to_ms(c: Column | str) -> Column:
    """``YYYYMMDD`` to epoch milliseconds at midnight UTC."""
    return F.unix_millis(F.try_to_timestamp(col(c), F.lit("yyyyMMdd")))


def yyyymmdd(c: Column | str) -> Column:
    return F.try_to_date(col(c), "yyyyMMdd")


def day(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd")


def floor_minutes(ts: Column | str, n: int) -> Column:
    """Floor to ``n`` minutes counted from the full hour.

    Unlike a time window this restarts every hour, so 45 gives :00 and :45.
    """
    seconds = F.unix_seconds(col(ts))
    into_hour = F.pmod(seconds, F.lit(3600))
    if n < 60:
        # seconds past the last mark, marks being counted from the full hour
        return F.timestamp_seconds(seconds - F.pmod(into_hour, F.lit(60 * n)))
    return F.timestamp_seconds(seconds - into_hour)


# text form of each dependency window
DEP_WINDOW_FORMATS = {
    "daily": "yyyy-MM-dd", "monthly": "yyyy-MM", "1h": ISO, "6h": ISO, "30m": ISO, "exact": ISO,
}


def dep_window_start(ts: Column | str, unit: str) -> Column:
    """Start of the dependency window as a timestamp (null for ``none``).

    ``30m`` floors to half hours; ``exact`` keeps the second.
    """
    ts = col(ts)
    if unit == "none":
        return F.lit(None).cast("timestamp")
    if unit == "daily":
        return F.date_trunc("day", ts)
    if unit == "monthly":
        return F.date_trunc("month", ts)
    if unit == "1h":
        return floor_minutes(ts, 60)
    if unit == "6h":
        seconds = F.unix_seconds(ts)
        return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(6 * 3600)))
    if unit == "30m":
        return floor_minutes(ts, 30)
    if unit == "exact":
        return F.date_trunc("second", ts)
    raise ValueError(f"unknown dependency window: {unit}")


def dep_window_text(start: Column | str, unit: str) -> Column:
    """Text of a window start; ``""`` where there is none."""
    if unit == "none":
        return F.lit("")
    return or_empty(F.date_format(col(start), DEP_WINDOW_FORMATS[unit]))


def dep_window(ts: Column | str, unit: str) -> Column:
    return dep_window_text(dep_window_start(ts, unit), unit)
