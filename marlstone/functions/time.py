"""Time conversions whose results do not depend on the session's zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ending of the canonical ingestion time, a UTC text with six
# fraction digits, e.g. 2026-03-01T05:17:08.433794+00:00.
UTC_SUFFIX = "+00:00"

CANONICAL_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}\+00:00$"

_SECONDS_PER_DAY = 86_400


def utc_wall_clock(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ showing the UTC wall clock."""
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return epoch + F.expr("INTERVAL '0.000001' SECOND") * F.unix_micros(ts)


def from_utc_wall_clock(ntz: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC -> TIMESTAMP."""
    hours = F.unix_date(ntz.cast("date")).cast("bigint") * 24 + F.hour(ntz)
    seconds = (hours * 60 + F.minute(ntz)) * 60
    micros = (F.extract(F.lit("SECOND"), ntz) * 1_000_000).cast("bigint")
    return F.timestamp_micros(seconds * 1_000_000 + micros)


def iso_utc(ts: Column) -> Column:
    """Canonical text of a TIMESTAMP."""
    return iso_wall_clock(utc_wall_clock(ts))


def iso_wall_clock(ntz: Column) -> Column:
    """Canonical text of a TIMESTAMP_NTZ that shows the UTC wall clock."""
    text = ntz.cast("string")
    return F.concat(
        F.substring(text, 1, 10),
        F.lit("T"),
        F.substring(text, 12, 8),
        F.lit("."),
        F.rpad(F.substring(text, 21, 6), 6, "0"),
        F.lit(UTC_SUFFIX),
    )


def from_iso(text: Column | str) -> Column:
    """TIMESTAMP of an ISO-8601 text that carries its own offset."""
    return F.to_timestamp(text)


def utc_date(ts: Column) -> Column:
    """UTC calendar day of a TIMESTAMP."""
    days = F.floor(F.unix_seconds(ts) / _SECONDS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def iso_date(text: Column) -> Column:
    """Calendar day of a canonical UTC text."""
    return F.substring(text, 1, 10).cast("date")


def epoch_millis(ms: Column) -> Column:
    """TIMESTAMP of a number of milliseconds since 1970, to the nearest one."""
    return F.timestamp_millis(F.floor(ms + 0.5).cast("bigint"))
