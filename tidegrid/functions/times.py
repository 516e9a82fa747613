"""Time helpers on TIMESTAMP_NTZ: independent of the session time zone."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

Duration = timedelta | str
Moment = datetime | str | Column

# Unit suffixes of duration text, in microseconds.
_UNIT_MICROS = {
    "ns": Decimal("0.001"),
    "us": Decimal(1),
    "µs": Decimal(1),
    "μs": Decimal(1),
    "ms": Decimal(1_000),
    "s": Decimal(1_000_000),
    "m": Decimal(60_000_000),
    "h": Decimal(3_600_000_000),
}
_TERM = re.compile(r"(\d+\.?\d*|\.\d+)(ns|us|µs|μs|ms|s|m|h)")


def parse_duration(text: str) -> timedelta:
    """Duration text such as ``48h``, ``1h30m``, ``-1.5s`` or ``0``; finer than 1 µs is cut."""
    body = text[1:] if text[:1] in ("-", "+") else text
    if body == "0":
        return timedelta(0)
    terms = _TERM.findall(body)
    if not terms or "".join(n + u for n, u in terms) != body:
        raise ValueError(f"not a duration: {text!r}")
    micros = int(sum(Decimal(n) * _UNIT_MICROS[u] for n, u in terms))
    return timedelta(microseconds=-micros if text[0] == "-" else micros)


def as_timedelta(duration: Duration) -> timedelta:
    return parse_duration(duration) if isinstance(duration, str) else duration


def micros_of(duration: Duration) -> int:
    return as_timedelta(duration) // timedelta(microseconds=1)


def whole_millis(step: Duration) -> int:
    """A step as milliseconds; one below or between whole milliseconds is refused."""
    micros = micros_of(step)
    if micros % 1000 or micros <= 0:
        raise ValueError(f"steps are whole milliseconds, not {step}")
    return micros // 1000


def step_millis(resolution: Duration) -> int:
    """A resolution as whole milliseconds, truncated."""
    micros = micros_of(resolution)
    return micros // 1000 if micros >= 0 else -(-micros // 1000)


def interval(duration: Duration) -> Column:
    return F.make_dt_interval(secs=F.lit(Decimal(micros_of(duration)) / 1_000_000))


def window_text(duration: Duration) -> str:
    """The spelling ``F.window`` takes."""
    return f"{micros_of(duration)} microseconds"


def moment(at: Moment) -> Column:
    """A time argument as a TIMESTAMP_NTZ column."""
    if isinstance(at, Column):
        return at
    if isinstance(at, str):
        at = datetime.fromisoformat(at)
    if at.tzinfo is not None:
        raise ValueError("times carry no zone; pass UTC wall time")
    return F.expr(f"TIMESTAMP_NTZ '{at.isoformat(sep=' ')}'")


def epoch() -> Column:
    return moment("1970-01-01")


def from_millis(millis: Column) -> Column:
    """Epoch milliseconds to a time."""
    return F.timestamp_add("MILLISECOND", millis, epoch())


def to_millis(ts: Column) -> Column:
    """A time to epoch milliseconds, truncated toward zero also before 1970."""
    return whole_steps(ts - epoch(), timedelta(milliseconds=1))


def to_micros(ts: Column) -> Column:
    """A time to epoch microseconds."""
    return whole_steps(ts - epoch(), timedelta(microseconds=1))


def whole_steps(length: Column, step: Duration) -> Column:
    """How many whole steps fit in an interval, as BIGINT.  Dividing intervals stays clear
    of time zones, which ``timestamp_diff`` does not."""
    return F.call_function("div", length, interval(step))


def step_index(ts: Column, start: Moment, step: Duration) -> Column:
    """Which step of the grid ``start, start+step, ..`` holds ``ts`` (``ts >= start``)."""
    whole_millis(step)
    return whole_steps(ts - moment(start), step)


def step_time(index: Column, start: Moment, step: Duration) -> Column:
    """Time of step ``index``; steps are whole milliseconds."""
    return F.timestamp_add("MILLISECOND", index * F.lit(whole_millis(step)), moment(start))


def tumbling(ts: Column, size: Duration) -> Column:
    """Epoch-aligned window struct (start, end), both null for a null time.

    Arithmetic, as ``F.window`` drops rows without a time; streams use that one, for its
    watermark (:func:`stream_window`).
    """
    width = F.lit(micros_of(size))
    into = F.pmod(to_micros(ts), width)
    return F.struct(F.timestamp_add("MICROSECOND", -into, ts).alias("start"),
                    F.timestamp_add("MICROSECOND", width - into, ts).alias("end"))


def stream_window(ts: Column, size: Duration) -> Column:
    """The same window in a form that a watermark can close; a null time has none."""
    return F.window(ts, window_text(size))
