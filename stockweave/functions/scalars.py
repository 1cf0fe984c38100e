"""Calendar parts, text formats, value recoding and stable hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recodings of the campaign table.
TARGETING_CODES = {"Automatic targeting": 0, "Manual targeting": 1, "context": 2}
STATUS_CODES = {"PAUSED": 0, "ENABLED": 1}

# Text forms of timestamps in written files.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
DATE_TEXT = "yyyy-MM-dd"


def calendar_parts(ts: Column) -> dict[str, Column]:
    """year, weekday (Monday = 0), day, month."""
    return {
        "year": F.year(ts),
        "weekday": F.weekday(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
    }


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_TEXT)


def date_text(ts: Column) -> Column:
    return F.date_format(ts, DATE_TEXT)


def recode(value: Column, codes: dict[str, int]) -> Column:
    """Replace known texts by their code; unknown texts pass through unchanged."""
    known = F.create_map(*[F.lit(x) for text, code in codes.items() for x in (text, str(code))])
    return F.coalesce(F.try_element_at(known, value), value)


def flag_text(mean_flag: Column) -> Column:
    """Averaged boolean of a bin as text; bins without observation say 'False'."""
    return F.coalesce(mean_flag.cast("string"), F.lit("False"))


def not_nan(value: Column) -> Column:
    """NaN counts as missing."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def row_text(columns: list[str]) -> Column:
    """One text for the values of a row: each with its length, so that different rows differ."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat_ws(
        "|", *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("null")) for t in texts]
    )


def key_hash(seed: int, *keys: str) -> Column:
    """First 32 bits of md5(seed|key|…) as a number: the same on every run and partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
