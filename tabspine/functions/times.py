"""Time expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def job_time(as_of: datetime | str | None = None) -> Column:
    """The job's clock: a fixed ``as_of`` makes a run repeatable, none reads the clock."""
    if as_of is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(str(as_of)))


def iso_text(col: Column) -> Column:
    """ISO-8601 text with microseconds."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def run_stamp(col: Column) -> Column:
    """DDMMYY-HHMMSS stamp."""
    return F.date_format(col, "ddMMyy-HHmmss")
