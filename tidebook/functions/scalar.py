"""Scalar expressions: clocks, sides, commands, safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidebook.schemas import COMMANDS, DAY_US, DEPTH_EPOCH_US, SESSION, SPLITS


def micros(clock: str) -> int:
    """Microseconds from midnight of an HH:MM:SS text."""
    h, m, s = (int(x) for x in clock.split(":"))
    return ((h * 60 + m) * 60 + s) * 1_000_000


def us(ts: str | Column) -> Column:
    """Microseconds since 1970 of the clock reading, for timestamps with and without a zone (sessions run in UTC)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * F.lit(DAY_US) + micros_of_day(ts)


def micros_of_day(ts: str | Column) -> Column:
    whole = (F.hour(ts) * 60 + F.minute(ts)).cast("long") * F.lit(60_000_000)
    return whole + (F.date_part(F.lit("SECOND"), F.col(ts) if isinstance(ts, str) else ts) * 1_000_000).cast("long")


def ms_from_midnight(ts: str | Column) -> Column:
    return F.floor(micros_of_day(ts) / 1000).cast("long")


def in_session(ts: str | Column, start: str = SESSION[0], end: str = SESSION[1]) -> Column:
    """Whether the time of day is inside the session, both ends included."""
    return micros_of_day(ts).between(micros(start), micros(end))


def session_split(ts: str | Column, splits=SPLITS) -> Column:
    """Name of the intraday split whose [start, end) holds the time of day, or null."""
    at, out = micros_of_day(ts), F.lit(None).cast("string")
    for name, lo, hi in reversed(splits):
        out = F.when((at >= micros(lo)) & (at < micros(hi)), F.lit(name)).otherwise(out)
    return out


def depth_time(raw: str | Column) -> Column:
    """Timestamp of a depth record: microseconds since 1899-12-30, 0 for the epoch."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.when(raw == 0, F.timestamp_micros(F.lit(0))).otherwise(F.timestamp_micros(raw - F.lit(DEPTH_EPOCH_US)))


def command_name(code: str | Column) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    names = F.array(*[F.lit(x) for x in COMMANDS])
    return F.coalesce(F.get(names, code.cast("int")), F.concat(F.lit("UNKNOWN_"), code.cast("string")))


def side(bid: str | Column, ask: str | Column) -> Column:
    """Aggressor side from the volumes at bid and ask: buy, sell, or null where they cannot tell."""
    bid, ask = (F.col(x) if isinstance(x, str) else x for x in (bid, ask))
    return F.when(ask > bid, "buy").when(bid > ask, "sell")


def strict_side(bid: str | Column, ask: str | Column) -> Column:
    """As side, but prints with volume on both sides cannot tell."""
    bid, ask = (F.col(x) if isinstance(x, str) else x for x in (bid, ask))
    return F.when((ask > 0) & (bid <= 0), "buy").when((bid > 0) & (ask <= 0), "sell")


def trade_time(date: str | Column, time: str | Column) -> Column:
    """Timestamp of 'Y/M/D' or 'Y-M-D' and ' H:MM:SS[.fff]' texts; null where they do not parse."""
    date, time = (F.col(x) if isinstance(x, str) else x for x in (date, time))
    text = F.concat_ws(" ", F.translate(F.trim(date), "/", "-"), F.trim(time))
    return F.try_to_timestamp(text, F.lit("yyyy-M-d H:mm:ss[.SSSSSS][.SSS]"))


def number(x: str | Column) -> Column:
    """Double of anything that looks like a number; null, NaN and other text become 0."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.nanvl(x.try_cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def ratio(a: Column, b: Column, other: float | None = 0.0) -> Column:
    """a / b, or other where b is 0 or null."""
    return F.when(b != 0, a / b).otherwise(F.lit(other).cast("double"))
