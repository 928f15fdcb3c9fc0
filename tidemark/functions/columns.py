"""Column -> Column functions. All of them stay in JVM code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date precisions a record may carry (year, month, day, or a
# day with a time of day). Year 0000 is not a date.
DATE_GUARD = (
    r"^(?!0000)[0-9]{4}(-[0-9]{2}(-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?)?)?$"
)

MS_PER_SECOND = 1_000
MS_PER_MINUTE = 60_000
MS_PER_HOUR = 3_600_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pick_nth_field(array: Column | str, index: int, field: str) -> Column:
    """``field`` of element ``index`` (from 0), NULL if the array is NULL or too short."""
    return F.get(_col(array), F.lit(index)).getField(field)


def parse_mixed_date(text: Column | str, extra_formats: Sequence[str] = ()) -> Column:
    """Parse ``yyyy``, ``yyyy-MM``, ``yyyy-MM-dd`` or an ISO date-time; anything else is NULL.

    ``extra_formats`` are further datetime patterns, tried in order.
    """
    text = _col(text)
    # The guard keeps out what a bare cast would accept (year 0, year 12345).
    parsed = F.when(text.rlike(DATE_GUARD), text.try_cast("timestamp_ntz"))
    fallbacks = [
        F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in extra_formats
    ]
    return F.coalesce(parsed, *fallbacks) if fallbacks else parsed


def format_mm_ss(ms: Column | str) -> Column:
    """Milliseconds as ``MM:SS``: seconds truncate, hours wrap, NULL stays NULL.

    Integer arithmetic on the time within the hour, so neither the session
    time zone nor the sign of ``ms`` matters.
    """
    ms = _col(ms).cast("bigint")

    def two_digits(within: int, unit: int) -> Column:
        value = F.floor(F.pmod(ms, F.lit(within)) / unit)
        return F.lpad(value.cast("string"), 2, "0")

    return F.concat(
        two_digits(MS_PER_HOUR, MS_PER_MINUTE), F.lit(":"), two_digits(MS_PER_MINUTE, MS_PER_SECOND)
    )
