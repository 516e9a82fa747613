"""Pieces shared by the catalogue: ranges, and the points tables spelled in SQL."""

from __future__ import annotations

START, END = "2024-01-05", "2024-01-25"
FIRST, LAST = "2024-01-01", "2024-01-31"

EVENT_KEY = "('event_type=' || event_type || ',user_id=' || user_id || ',')"
LINE_KEY = ("('linestatus=' || l_linestatus || ',returnflag=' || l_returnflag "
            "|| ',suppkey=' || l_suppkey || ',')")

# the events as points, for FROM clauses
EVENTS = f"(SELECT *, {EVENT_KEY} AS series_key FROM events)"
LINES = (f"(SELECT *, {LINE_KEY} AS series_key, l_shipdate AS ts, l_quantity AS value "
         "FROM lineitem)")

SAMPLE_COLUMNS = ["event_id", "series_key", "ts", "value"]


def bucket(width: str, ts: str = "ts") -> str:
    """Epoch-aligned window start."""
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"


def fnv(text: str) -> str:
    """32-bit FNV-1a of a text expression."""
    return (f"list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda h: ('0x' || h)::BIGINT), "
            "lambda a, x: (xor(a, x) * 16777619) & 4294967295, 2166136261::BIGINT)")


def between(start: str = START, end: str = END) -> str:
    return f"ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}'"
