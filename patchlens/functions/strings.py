"""String rules: character-set strip, rule-list normalisation, digit tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chars_to_int(c, chars: str) -> Column:
    """Strip every leading character that is in ``chars`` (a set, not a
    prefix) and read the rest as a bigint; NULL when it is not a number."""
    return F.ltrim(_col(c), F.lit(chars)).try_cast("bigint")


def _fold_rules(c, rules: Sequence[tuple[str, str]], test, py_test) -> Column:
    """Rules apply one after the other to the value the previous rule left.

    The first rule that matches the input decides; its target then passes
    the later rules.  That tail is a constant, so it is folded here on the
    driver, and the column expression is one flat CASE with one branch per
    rule (no nesting, so its size stays linear in the number of rules).
    """
    v = _col(c)
    out = None
    for i, (needle, target) in enumerate(rules):
        final = target
        for later_needle, later_target in rules[i + 1:]:
            if py_test(final, later_needle):
                final = later_target
        cond = test(v, F.lit(needle))
        out = F.when(cond, F.lit(final)) if out is None else out.when(cond, F.lit(final))
    return v if out is None else out.otherwise(v)


def normalise_prefix(c, rules: Sequence[tuple[str, str]]) -> Column:
    """Value starting with a rule's prefix becomes the rule's target."""
    return _fold_rules(c, rules, lambda v, p: v.startswith(p), lambda v, p: v.startswith(p))


def normalise_contains(c, rules: Sequence[tuple[str, str]]) -> Column:
    """Value containing a rule's substring becomes the rule's target."""
    return _fold_rules(c, rules, lambda v, p: v.contains(p), lambda v, p: p in v)


def digits_or_empty(c) -> Column:
    """The text itself when it is one or more ASCII digits, else ''."""
    v = _col(c)
    return F.when(v.rlike(r"^[0-9]+\z"), v).otherwise(F.lit(""))


def empty_if_null(c) -> Column:
    """NULL (or a missing join partner) becomes ''."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))
