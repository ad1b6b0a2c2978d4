"""Reusable relational operators built from DataFrame primitives."""

from mercato.operators.distinct import distinct_rollup
from mercato.operators.relational import (bucketize, distinct_rows,
                                          latest_per_key, share_of_total, topk,
                                          topk_semi_join, using_left)
from mercato.operators.ranking import global_rank, global_ranks, ntile_from_rank

__all__ = [
    "bucketize", "distinct_rollup", "distinct_rows", "latest_per_key", "share_of_total",
    "topk", "topk_semi_join", "using_left", "global_rank", "global_ranks", "ntile_from_rank",
]
