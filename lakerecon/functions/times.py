"""Run times. Nothing here reads a clock: the caller passes the moment of the run."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone of audit timestamps and the zone of alert texts.
AUDIT_ZONE = "EST5EDT"
ALERT_ZONE = "America/New_York"


def eastern_time(at: Column) -> Column:
    """UTC moment to audit wall-clock time, whole seconds."""
    return F.date_trunc("second", F.from_utc_timestamp(at, AUDIT_ZONE))


def eastern_text(at: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") -> Column:
    """UTC moment to the wall-clock text used in alerts."""
    return F.date_format(F.from_utc_timestamp(at, ALERT_ZONE), pattern)


def recon_window(as_of: datetime, hours: int = 24) -> tuple[datetime, datetime]:
    """Bounds of the reconciliation window, lower inclusive, upper exclusive."""
    return as_of - timedelta(hours=hours), as_of


def recon_dates(as_of: datetime, hours: int = 24) -> list[date]:
    """The partition dates a reconciliation window touches, oldest first."""
    low, high = recon_window(as_of, hours)
    last = (high - timedelta(microseconds=1)).date()
    return [low.date() + timedelta(days=i) for i in range((last - low.date()).days + 1)]
