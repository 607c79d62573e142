"""Array columns."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerloom.functions.text import _col


def as_array(value):
    """Wrap a value."""
    return F.array(_col(value))


def flatten_lists(value):
    """One level of nesting less."""
    return F.flatten(_col(value))


def first_item(value):
    """The first element, null for an empty or missing array."""
    return F.get(_col(value), 0)


def joined(value, separator="-"):
    """Elements as text, null for a missing array."""
    value = _col(value)
    return F.when(value.isNotNull(), F.concat_ws(separator, value))


def union_names(*values):
    """Distinct elements of several arrays in order of first sight."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(
        reduce(F.array_union, [F.coalesce(_col(value), empty) for value in values])
    )


def has_topic(topics, wanted, without=None):
    """Membership flag, with an optional topic that must be absent."""
    topics = F.coalesce(_col(topics), F.array().cast("array<string>"))
    flag = F.array_contains(topics, wanted)
    return flag & ~F.array_contains(topics, without) if without else flag
