from .readers import (
    BUSINESS_SCHEMA,
    REVIEW_SCHEMA,
    read_baskets,
    read_businesses,
    read_reviews,
    read_words,
)
from .writers import (
    write_busy_report,
    write_category_report,
    write_itemsets,
    write_report,
    write_similar_pairs,
)

__all__ = [
    "BUSINESS_SCHEMA",
    "REVIEW_SCHEMA",
    "read_baskets",
    "read_businesses",
    "read_reviews",
    "read_words",
    "write_busy_report",
    "write_category_report",
    "write_itemsets",
    "write_report",
    "write_similar_pairs",
]
