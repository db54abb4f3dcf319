"""Run clock, effective dates and date-hour arithmetic on zone-less timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession, functions as F

# The day that stands for "no end", and the lag of an hourly folder.
OPEN_END = "31-12-4712"
OPEN_END_FORMAT = "dd-MM-yyyy"
FOLDER_LAG_HOURS = 3


def run_clock(spark: SparkSession) -> datetime:
    """Now, to the second, in the session's time zone; take it once per run."""
    return spark.range(1).select(F.localtimestamp()).first()[0].replace(microsecond=0)


def instant(as_of: datetime | str | Column) -> Column:
    """A zone-less timestamp column from a datetime, its text, or a column."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def whole_seconds(ts: Column) -> Column:
    """Drops the fraction of a second, as a ``TIMESTAMP(0)`` column would."""
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECOND"), ts) % 1)


def open_end() -> Column:
    return F.to_date(F.lit(OPEN_END), OPEN_END_FORMAT).cast("timestamp_ntz")


def is_effective(as_of: datetime | str | Column, start: Column, end: Column) -> Column:
    """True while ``as_of`` lies in ``[start, end]``, a NULL end meaning open."""
    return instant(as_of).between(start, F.coalesce(end, open_end()))


def date_hour(ts: Column) -> Column:
    """``yyyyMMddHH`` as a whole number."""
    return (F.year(ts).cast("bigint") * 1_000_000 + F.month(ts) * 10_000
            + F.dayofmonth(ts) * 100 + F.hour(ts))


def parse_date_hour(value: int | str | Column) -> Column:
    """The timestamp that a ``yyyyMMddHH`` number or text stands for."""
    text = value.cast("string") if isinstance(value, Column) else F.lit(str(value))
    return F.to_timestamp_ntz(text, F.lit("yyyyMMddHH"))


def folder_ready_at(date: Column, hour: Column, lag_hours: int = FOLDER_LAG_HOURS) -> Column:
    """When the folder ``date=/hour=`` counts as complete."""
    zero = F.lit(0)
    return date.cast("timestamp_ntz") + F.make_dt_interval(zero, hour.cast("int") + lag_hours)


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
