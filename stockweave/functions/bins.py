"""Time bins as integers, so a grid is an integer sequence for every frequency.

Days and sub-daily bins carry their start as label; weeks end on Sunday, months
and years carry their last day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequency names and the width of the sub-daily ones in seconds.
SUB_DAILY_SECONDS = {"H": 3600, "30min": 1800, "15min": 900, "10min": 600, "5min": 300, "1min": 60}
FREQUENCIES = ("Y", "M", "W", "D", *SUB_DAILY_SECONDS)


def bin_index(ts: Column, freq: str) -> Column:
    """Number of the bin that holds ``ts``; consecutive bins have consecutive numbers."""
    if freq == "D":
        return F.unix_date(F.to_date(ts)).cast("bigint")
    if freq in SUB_DAILY_SECONDS:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(SUB_DAILY_SECONDS[freq]))
    if freq == "W":
        # 1970-01-01 was a Thursday; +3 makes bin 0 end on Sunday 1970-01-04.
        return F.floor((F.unix_date(F.to_date(ts)) + 3) / F.lit(7))
    if freq == "M":
        return (F.year(ts) * 12 + F.month(ts) - 1).cast("bigint")
    if freq == "Y":
        return F.year(ts).cast("bigint")
    raise ValueError(f"unknown frequency {freq!r}, expected one of {FREQUENCIES}")


def bins_after(start: Column, step: Column, freq: str) -> Column:
    """Label of the bin ``step`` bins after the one that holds ``start``."""
    return bin_label(bin_index(start, freq) + step, freq)


def bin_label(index: Column, freq: str) -> Column:
    """Timestamp that names a bin number."""
    if freq in SUB_DAILY_SECONDS:
        return F.timestamp_seconds(index * SUB_DAILY_SECONDS[freq])
    number = index.cast("int")
    if freq == "D":
        day = F.date_from_unix_date(number)
    elif freq == "W":
        day = F.date_from_unix_date(number * 7 + 3)
    elif freq == "M":
        day = F.last_day(
            F.make_date(F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)) + 1, F.lit(1))
        )
    elif freq == "Y":
        day = F.make_date(number, F.lit(12), F.lit(31))
    else:
        raise ValueError(f"unknown frequency {freq!r}, expected one of {FREQUENCIES}")
    return day.cast("timestamp")
