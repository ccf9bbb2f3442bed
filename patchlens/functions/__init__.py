"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from patchlens.functions.arrays import pairs_to_text, suffix_slice
from patchlens.functions.dates import (day_text, epoch_to_timestamp, month_label,
                                       parse_day, parse_month_label, recent_filter,
                                       same_month)
from patchlens.functions.strings import (digits_or_empty, empty_if_null, normalise_contains,
                                         normalise_prefix, strip_chars_to_int)

__all__ = [
    "pairs_to_text",
    "suffix_slice", "day_text", "epoch_to_timestamp", "month_label", "parse_day",
    "parse_month_label", "recent_filter", "same_month", "digits_or_empty", "empty_if_null",
    "normalise_contains", "normalise_prefix", "strip_chars_to_int",
]
