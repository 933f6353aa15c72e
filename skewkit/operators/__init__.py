"""Batch operators: counts, Top-N, salted and broadcast joins."""

from skewkit.operators.topn import (  # noqa: F401
    add_salt, count_per_key, distinct_keys, plain_topn, salt_column, salted_count,
    salted_topn, topn_distinct_counts, topn_per_group,
)
from skewkit.operators.joins import (  # noqa: F401,E402
    broadcast_if_bounded, broadcast_left_join, broadcast_lookup_join, fits_broadcast, heavy_keys,
    join_topn, latest_per_key, matched_pairs, replicate, salted_join,
)
