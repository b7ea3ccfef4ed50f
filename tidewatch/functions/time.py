"""Time arithmetic on TIMESTAMP_NTZ columns, independent of the session zone.

``unix_micros`` and ``timestampdiff`` would cast an NTZ value to a zoned time
(wrong inside a daylight-saving change), so the distance to the epoch is put
together from the date and the time of day, which read the wall clock as it
is.  ``timestampadd`` keeps NTZ values as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_micros(col) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ wall-clock value."""
    c = _c(col)
    days = F.date_diff(F.to_date(c), F.to_date(F.expr(_EPOCH))).cast("long")
    seconds = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long")
    micros = (F.extract(F.lit("SECOND"), c) * MICROS_PER_SECOND).cast("long")
    return days * MICROS_PER_DAY + seconds * MICROS_PER_SECOND + micros


def micros_to_ntz(col) -> Column:
    """Inverse of :func:`ntz_micros`."""
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(_EPOCH))


def millis_to_ntz(col) -> Column:
    """Epoch milliseconds → TIMESTAMP_NTZ, exact to the millisecond.

    (The reference divides by ``1000.0`` and keeps one decimal, i.e. rounds to
    0.1 s; we keep the exact value.)
    """
    return F.timestamp_add("MILLISECOND", _c(col), F.expr(_EPOCH))


_OFFSET = r"[Tt ].*(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def iso_to_ntz(col, strict: bool = False) -> Column:
    """ISO-8601 text → UTC wall clock as TIMESTAMP_NTZ.

    Text with an offset (``Z``, ``+02:00``) is moved to UTC; text without one
    is taken as UTC already.  Neither depends on the session zone.  Text that
    is no time gives null, or with ``strict`` fails the job.
    """
    c = _c(col)

    def parsed(kind: str) -> Column:
        return c.cast(kind) if strict else c.try_cast(kind)

    return F.when(c.rlike(_OFFSET), micros_to_ntz(F.unix_micros(parsed("timestamp")))) \
        .otherwise(parsed("timestamp_ntz"))


def iso_utc_text(instant: Column) -> Column:
    """A zoned instant as ISO-8601 text in UTC, whatever the session zone."""
    utc = micros_to_ntz(F.unix_micros(instant))
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def ceil_to_grid_micros(micros: Column, grid: int) -> Column:
    """Smallest multiple of ``grid`` that is >= ``micros`` (both in micros)."""
    return -F.floor(-micros / F.lit(grid)).cast("long") * F.lit(grid)


def floor_to_grid_micros(micros: Column, grid: int) -> Column:
    return F.floor(micros / F.lit(grid)).cast("long") * F.lit(grid)


# Hour partitions, zero-padded; Spark pattern and strftime code.
PART_FORMATS = {"year": ("yyyy", "%Y"), "month": ("MM", "%m"), "day": ("dd", "%d"),
                "hour": ("HH", "%H")}


def partition_parts(col) -> dict[str, Column]:
    """Zero-padded ``year / month / day / hour`` strings of a timestamp."""
    return {name: F.date_format(_c(col), pattern)
            for name, (pattern, _) in PART_FORMATS.items()}


def partition_of(when: dt.datetime) -> dict[str, str]:
    """The same partition values of a clock value (UTC if it has no zone)."""
    utc = when if when.tzinfo is None else when.astimezone(dt.timezone.utc)
    return {name: utc.strftime(code) for name, (_, code) in PART_FORMATS.items()}
