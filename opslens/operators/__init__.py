"""DataFrame operators."""

from opslens.operators.aggregates import (
    categories,
    distribution_stats,
    histogram,
    null_census,
    pivot_fill,
    value_share,
)
from opslens.operators.bitmaps import distinct_counts, merge_sets, number_values, set_counts, value_sets
from opslens.operators.joins import full_merge, left_detail, look_up
from opslens.operators.network import hop_network
from opslens.operators.ranking import global_rank, grand_total, running_counts, share_of_total, top_k
from opslens.operators.rows import (
    dedup_exact,
    dedup_first,
    distinct_groups,
    drop_null_subset,
    ref_filter,
    reject_incomplete,
)

__all__ = [
    "categories",
    "dedup_exact",
    "dedup_first",
    "distinct_counts",
    "distinct_groups",
    "distribution_stats",
    "drop_null_subset",
    "full_merge",
    "global_rank",
    "grand_total",
    "histogram",
    "hop_network",
    "left_detail",
    "look_up",
    "merge_sets",
    "null_census",
    "number_values",
    "pivot_fill",
    "ref_filter",
    "reject_incomplete",
    "running_counts",
    "set_counts",
    "share_of_total",
    "top_k",
    "value_sets",
    "value_share",
]
