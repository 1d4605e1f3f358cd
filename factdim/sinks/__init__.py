"""Table writers."""

from .history import HistoryTable
from .hot import HOT_SHARE, heavy_hitters, write_bucketed_hot
from .tables import compare_layouts, layout_sizes, upsert, upsert_partitions, write_bucketed, write_layout, write_period

__all__ = [
    "HOT_SHARE",
    "HistoryTable",
    "compare_layouts",
    "heavy_hitters",
    "layout_sizes",
    "upsert",
    "upsert_partitions",
    "write_bucketed",
    "write_bucketed_hot",
    "write_layout",
    "write_period",
]
