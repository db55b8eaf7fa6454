from .counts import (
    busy_keys,
    distinct_count,
    key_counts,
    row_count,
    top_keys,
    top_words,
    word_counts,
    year_count,
)
from .averages import category_averages, top_categories
from .itemsets import frequent_itemsets, item_levels, son_candidates, son_itemsets
from .layout import hash_layout, partition_layout
from .minhash import lsh_buckets, minhash_signatures
from .pairs import pairs_within
from .recommend import item_model, mean_ratings, predict_ratings
from .similarity import similar_pairs, similar_pairs_lsh

__all__ = [
    "busy_keys",
    "category_averages",
    "distinct_count",
    "frequent_itemsets",
    "hash_layout",
    "item_levels",
    "item_model",
    "key_counts",
    "lsh_buckets",
    "mean_ratings",
    "minhash_signatures",
    "pairs_within",
    "partition_layout",
    "predict_ratings",
    "row_count",
    "similar_pairs",
    "similar_pairs_lsh",
    "son_candidates",
    "son_itemsets",
    "top_categories",
    "top_keys",
    "top_words",
    "word_counts",
    "year_count",
]
