"""Readers, and views of the practice tables in the shapes the operators expect."""

from .events import decode_web_events, parse_web_events, read_web_events
from .files import read_csv, read_table

__all__ = ["decode_web_events", "parse_web_events", "read_csv", "read_table", "read_web_events"]
