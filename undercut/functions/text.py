"""Column expressions that produce text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest header text and the sign for a missing cell.
HEADER_MAX = 500
MISSING = "—"
# Fixed value: the last epoch millisecond that still has a date.
MAX_DATE_MS = 8_640_000_000_000_000

DAY_MS = 86_400_000


def truncate(text: Column, limit: int = HEADER_MAX) -> Column:
    """At most ``limit`` characters plus ``...``; null reads ``null``."""
    short = F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("...")))
    return F.coalesce(short, text, F.lit("null"))


def iso_millis(epoch_ms: Column) -> Column:
    """ISO-8601 UTC text with milliseconds, whatever the session's time zone.

    Years beyond four digits get a sign and six digits; a time no calendar of that
    form holds is shown as the plain number.
    """
    within = F.pmod(epoch_ms, F.lit(DAY_MS))
    day = epoch_day(epoch_ms).cast("string")
    signed = F.concat(F.left(day, F.lit(1)), F.lpad(F.regexp_extract(day, r"^[+-](\d+)", 1), 6, "0"), F.right(day, F.lit(6)))
    parts = ((3_600_000, 24, 2), (60_000, 60, 2), (1000, 60, 2), (1, 1000, 3))
    hour, minute, second, milli = (
        F.lpad(F.pmod(F.floor(within / unit), F.lit(turn)).cast("string"), width, "0") for unit, turn, width in parts
    )
    date = F.when(day.rlike(r"^[+-]"), signed).otherwise(day)
    text = F.concat(date, F.lit("T"), F.concat_ws(":", hour, minute, second), F.lit("."), milli, F.lit("Z"))
    return F.when(epoch_ms.between(-MAX_DATE_MS, MAX_DATE_MS), text).otherwise(epoch_ms.cast("string"))


def epoch_day(epoch_ms: Column) -> Column:
    """The UTC date of an epoch time, whatever the session's time zone; null beyond all dates."""
    known = F.when(epoch_ms.between(-MAX_DATE_MS, MAX_DATE_MS), epoch_ms)
    days = (known - F.pmod(known, F.lit(DAY_MS))) / DAY_MS
    return F.date_from_unix_date(days.cast("int"))


def fixed1(value: Column) -> Column:
    """One decimal, rounding the exact binary value with ties away from zero.

    Ten times the fraction is taken in two parts (the fraction as float plus the
    rest), so each product is exact and so is the comparison with one half.
    """
    size = F.abs(value)
    # From 2^53 on a double has no fraction; there the digits are those of the number itself.
    large = size >= float(1 << 53)
    size = F.when(~large, size)
    whole = F.floor(size)
    part = size - whole.cast("double")
    high = part.cast("float").cast("double")
    tenths = F.floor(part * 10.0)
    up = (high * 10.0 - tenths.cast("double") - 0.5) + (part - high) * 10.0 >= 0.0
    total = whole * 10 + tenths + F.when(up, 1).otherwise(0)
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    shown = (total.cast("decimal(38,0)") / 10).cast("decimal(38,1)").cast("string")
    digits = F.concat(F.abs(value).try_cast("decimal(38,0)").cast("string"), F.lit(".0"))
    return F.concat(sign, F.when(large, F.coalesce(digits, F.abs(value).cast("string"))).otherwise(shown))


def percent1(share: Column) -> Column:
    shown = F.concat(fixed1(share * 100.0), F.lit("%"))
    return F.when(share.isNull() | F.isnan(share), F.lit(MISSING)).otherwise(shown)


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("yes")).when(~flag, F.lit("no")).otherwise(F.lit(MISSING))
