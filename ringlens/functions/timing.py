"""Naive timestamps: parsing, second counts and day windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86_400

DATED_TEXT = r"^\s*\d{4,}-\d{1,2}-\d{1,2}"


def naive_time(col: Column, dtype: T.DataType) -> Column:
    """TIMESTAMP_NTZ, NULL where the value is not a timestamp."""
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return col.cast("timestamp_ntz")
    if isinstance(dtype, T.StringType):
        return F.when(col.rlike(DATED_TEXT), col.try_cast("timestamp_ntz"))
    return F.lit(None).cast("timestamp_ntz")


def naive_literal(moment: datetime) -> Column:
    """A naive time as it is; a datetime literal would be shifted by the zones of Python and the session."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_second(col: Column) -> Column:
    """Whole seconds since 1970 of a naive time, independent of the session zone.

    The difference of two such values counts second boundaries. The fast
    function rounds towards zero, so times before 1970 are assembled by hand.
    """
    clock = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    early = F.unix_date(col.cast("date")).cast("bigint") * DAY + clock
    return F.when(col < naive_literal(datetime(1970, 1, 1)), early).otherwise(F.unix_timestamp(col))


def second_of_day(second: Column) -> Column:
    return F.pmod(second, F.lit(DAY))


def day_number(second: Column) -> Column:
    """Days since 1970 of an epoch second."""
    return ((second - second_of_day(second)) / DAY).cast("int")


def weekday(second: Column) -> Column:
    """0 for Monday to 6 for Sunday; 1970 began on a Thursday."""
    return F.pmod(day_number(second) + 3, F.lit(7))


@dataclass(frozen=True)
class DayWindow:
    """``days`` whole days that end with, and include, ``as_of``."""

    as_of: date
    days: int

    @classmethod
    def ending_today(cls, days: int, zone: str = "Asia/Ho_Chi_Minh") -> DayWindow:
        return cls(datetime.now(ZoneInfo(zone)).date(), days)

    @property
    def start(self) -> date:
        return self.as_of - timedelta(days=self.days - 1)

    def label(self) -> str:
        return f"last_{self.days}d_{self.start.isoformat()}_to_{self.as_of.isoformat()}"

    def contains(self, col: Column, dtype: T.DataType) -> Column:
        """Predicate on the raw column; a half-open range so that Parquet can skip row groups."""
        first = datetime.combine(self.start, datetime.min.time())
        end = first + timedelta(days=self.days)
        time = naive_time(col, dtype)
        return (time >= naive_literal(first)) & (time < naive_literal(end))
