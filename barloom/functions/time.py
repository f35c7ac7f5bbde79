"""Session times: provider epochs, local dates and strict local cut-offs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def session_date(epoch: Column, zone: str) -> Column:
    """Local date of a provider's epoch seconds."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(epoch), zone))


def strict_utc(local: Column, zone: str) -> Column:
    """UTC of a local timestamp; null where the clock skips it or shows it twice.

    A skipped time doesn't come back from UTC; of a repeated one, the UTC an
    hour to either side shows the same clock.  The session time zone is UTC.
    """
    utc = F.to_utc_timestamp(local, zone)
    hour = F.expr("INTERVAL '1' HOUR")
    back = lambda t: F.from_utc_timestamp(t, zone)
    return F.when((back(utc) == local) & (back(utc + hour) != local) & (back(utc - hour) != local), utc)


def eligible_after(session: Column, cutoff: str, zone: str, delay_minutes: int = 0) -> Column:
    """UTC from which a session's bar can be expected: its local cut-off and a delay."""
    local = F.to_timestamp(F.concat(session.cast("string"), F.lit(f" {cutoff}:00")))
    return strict_utc(local, zone) + F.make_dt_interval(mins=F.lit(delay_minutes))


def measurement(value: Column, unit: str) -> Column:
    """(value, unit), null where the value is."""
    return F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(unit).alias("unit")))
