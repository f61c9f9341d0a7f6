"""Column expressions for cleaning raw order data.

Raw text is converted with ``try_cast``: a value that does not convert becomes
NULL and is reported by the contract's NOT NULL rule instead of ending the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Silver and Gold tables are laid out in this many buckets.
BUCKETS = 100


def try_int(name: str) -> Column:
    """Integer, or NULL when the text is no 32-bit integer."""
    return F.col(name).try_cast("int").alias(name)


def try_double(name: str) -> Column:
    return F.col(name).try_cast("double").alias(name)


def try_bool(name: str) -> Column:
    """E5: 1/0, t/f, true/false in any case, or NULL."""
    return F.col(name).try_cast("boolean").alias(name)


def filled(name: str, value: float) -> Column:
    """A missing number becomes ``value``; one that does not convert becomes NULL."""
    given = F.col(name)
    return F.when(given.isNull(), F.lit(value)).otherwise(given.try_cast("double")).alias(name)


def bucket_of(id_column: Column) -> Column:
    """Bucket 0..99. Taken after the integer cast, and never negative."""
    return F.pmod(id_column.try_cast("int"), F.lit(BUCKETS))


def event_instant(name: str) -> Column:
    """ISO-8601 text such as 2024-01-15T14:32:00Z, or NULL."""
    return F.try_to_timestamp(F.col(name))


def utc_date(instant: Column) -> Column:
    """Calendar date in UTC, whatever the session's time zone is."""
    return F.to_date(F.to_utc_timestamp(instant, F.current_timezone()))
