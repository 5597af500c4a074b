"""Extracts that arrive over time, conformed and counted as a stream."""

from landfall.streaming.arrivals import (
    EVENT_TIME,
    arrival_windows,
    conform_arrivals_stream,
    run_available,
    stream_extracts,
    with_event_time,
)

__all__ = [
    "EVENT_TIME",
    "arrival_windows",
    "conform_arrivals_stream",
    "run_available",
    "stream_extracts",
    "with_event_time",
]
