from .reports import (
    BusyReport,
    ItemsetReport,
    busy_report,
    category_report,
    exploration_report,
    itemset_report,
)

__all__ = [
    "BusyReport",
    "ItemsetReport",
    "busy_report",
    "category_report",
    "exploration_report",
    "itemset_report",
]
