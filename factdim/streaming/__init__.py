"""Structured Streaming jobs."""

from .intake import accepted_events, accounts, refused_events, start_intake
from .keyed_table import KeyedTable
from .sessions import (
    foreach_batch_writer,
    latest_sessions,
    session_table,
    sessionize_stream,
    start_session_stream,
)

__all__ = [
    "KeyedTable",
    "accepted_events",
    "accounts",
    "foreach_batch_writer",
    "latest_sessions",
    "refused_events",
    "session_table",
    "sessionize_stream",
    "start_intake",
    "start_session_stream",
]
