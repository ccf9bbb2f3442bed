"""Generic relational operators; every one takes column names, so it runs
on any table, not only on bulletin data."""

from patchlens.operators.aggregates import (collect_distinct, independent_max_in_place, independent_max_match,
                                            latest_value_per_item, max_per_pair)
from patchlens.operators.joins import left_join_with_defaults, range_join, type_default
from patchlens.operators.windows import latest_per_key, top_n_per_group

__all__ = [
    "collect_distinct", "independent_max_in_place", "independent_max_match", "latest_value_per_item", "max_per_pair",
    "left_join_with_defaults", "range_join", "type_default",
    "latest_per_key", "top_n_per_group",
]
