"""Durations, event times in milliseconds, and rounding that two engines agree on."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds of each unit.
UNITS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def parse_duration(text: str) -> int:
    """'5s', '1m', '2h', '1d' or '250ms' in milliseconds."""
    m = re.fullmatch(r"\s*(\d+)\s*(ms|s|m|h|d)\s*", text)
    if not m:
        raise ValueError(f"not a duration: {text!r}")
    return int(m[1]) * UNITS[m[2]]


def is_duration(text: str) -> bool:
    return re.fullmatch(r"\s*\d+\s*(ms|s|m|h|d)\s*", text) is not None


def millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp without time zone, whatever the session's zone is."""
    part = lambda name: F.extract(F.lit(name), ts)
    days = F.unix_date(F.to_date(ts)).cast("long") * 86_400_000
    return days + part("HOUR").cast("long") * 3_600_000 + part("MINUTE").cast("long") * 60_000 + F.floor(part("SECOND") * 1000).cast("long")


def round_half_up(x: Column, scale: int = 4) -> Column:
    """``x`` rounded half up through a decimal, as a double."""
    return F.round(x.cast("double").cast("decimal(28,10)"), scale).cast("double")


def wire_time(text: Column) -> Column:
    """Epoch milliseconds of 'yyyyMMddHHmmss' text (taken as UTC); null where it is no time."""
    whole = F.regexp_extract(text, r"^(\d{14})$", 1)
    date = F.try_to_date(F.substring(whole, 1, 8), "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(F.substring(whole, 1, 8), F.lit("yyyyMMdd")))
    n = lambda a: F.substring(whole, a, 2).try_cast("long")
    return F.unix_date(date).cast("long") * 86_400_000 + n(9) * 3_600_000 + n(11) * 60_000 + n(13) * 1000


def time_text(ms: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of epoch milliseconds, in UTC whatever the session's zone is."""
    day = F.date_from_unix_date(F.floor(ms / 86_400_000).cast("int"))
    rest = F.pmod(ms, F.lit(86_400_000))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit(" "), two(rest / 3_600_000), F.lit(":"), two(F.pmod(rest, F.lit(3_600_000)) / 60_000), F.lit(":"), two(F.pmod(rest, F.lit(60_000)) / 1000))
