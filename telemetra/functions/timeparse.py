"""ISO-8601 parsing to epoch milliseconds and UTC labels."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted text: date, optional time with optional seconds/fraction and offset.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)


DAY_MS = 86_400_000


def _normalised(col: Column) -> Column:
    """An accepted text with ``.`` before a fraction, seconds and always an offset: a naive time is UTC
    whatever the session's time zone. Accepted texts have fixed places, so no pattern is matched again,
    and each part is taken from the text itself (``$`` has let one line end pass)."""
    c = F.rtrim(F.translate(col, ",", "."), F.lit("\r\n"))
    seconds = F.when(F.substring(c, 17, 1) == ":", F.lit("")).otherwise(F.lit(":00"))
    zoned = F.endswith(c, F.lit("Z")) | F.substring(c, -6, 1).isin("+", "-") | F.substring(c, -5, 1).isin("+", "-")
    time = F.concat(F.substring(c, 1, 16), seconds, F.substring(c, 17, 64), F.when(zoned, F.lit("")).otherwise(F.lit("Z")))
    return F.when(F.length(col) == 10, F.concat(col, F.lit("T00:00:00Z"))).otherwise(time)


def parse_iso(col: Column) -> Column:
    """TIMESTAMP for an accepted ISO text, else NULL. Never raises."""
    ok = col.rlike(ISO_PATTERN)
    return F.when(ok, F.try_to_timestamp(_normalised(col)))


def is_iso_datetime(col: Column) -> Column:
    """Predicate: text is an accepted ISO date/time (NULL input -> false)."""
    return F.coalesce(parse_iso(col).isNotNull(), F.lit(False))


def iso_to_millis(col: Column) -> Column:
    """Epoch milliseconds (BIGINT) of an ISO text; naive times are read as UTC."""
    return F.unix_millis(parse_iso(col))


# UTC calendar parts of epoch milliseconds by integer arithmetic: no session time zone is involved.

def _days(ms: Column) -> Column:
    return F.floor(ms / F.lit(DAY_MS)).cast("int")


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def utc_hour(ms: Column) -> Column:
    return F.floor(F.pmod(ms, F.lit(DAY_MS)) / 3_600_000).cast("int")


def utc_weekday(ms: Column) -> Column:
    """Monday = 0 (day 0 of the epoch was a Thursday)."""
    return F.pmod(_days(ms) + 3, F.lit(7))


def _hms(ms: Column) -> Column:
    sec = F.floor(F.pmod(ms, F.lit(DAY_MS)) / 1000)
    return F.concat_ws(":", _two(F.floor(sec / 3600)), _two(F.floor(sec / 60) % 60), _two(sec % 60))


def millis_to_iso(ms: Column) -> Column:
    """ISO text with millisecond precision and explicit +00:00 offset."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), _days(ms)).cast("string")
    return F.concat(day, F.lit("T"), _hms(ms), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"),
                    F.lit("+00:00"))


def micros_to_iso(us: Column) -> Column:
    """ISO text with microsecond precision and explicit +00:00 offset."""
    ms = F.floor(us / 1000)
    day = F.date_add(F.lit("1970-01-01").cast("date"), _days(ms)).cast("string")
    return F.concat(day, F.lit("T"), _hms(ms), F.lit("."), F.lpad(F.pmod(us, F.lit(1_000_000)).cast("string"), 6, "0"),
                    F.lit("+00:00"))


def hms_label(start_ms: Column, end_ms: Column) -> Column:
    """Window label 'HH:MM:SS - HH:MM:SS' in UTC."""
    return F.concat(_hms(start_ms), F.lit(" - "), _hms(end_ms))
