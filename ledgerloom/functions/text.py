"""Strings: cleaning, pure names, null sentinels, joined texts."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerloom.functions import fixed


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value):
    """Strings of nothing but spaces become null; others stay as they are."""
    value = _col(value)
    return F.when(F.trim(value) != "", value)


def sentinel_to_null(value, sentinels=tuple(fixed.NULL_SENTINELS)):
    """Texts that stand for "no value" become null."""
    value = _col(value)
    return F.when(~value.isin(*sentinels), value)


def clean_text(value):
    """One pass of whitespace and punctuation repair; empty becomes null."""
    cleaned = reduce(
        lambda text, rule: F.regexp_replace(text, *rule), fixed.CLEANING_RULES, _col(value)
    )
    return F.nullif(F.trim(cleaned), F.lit(""))


def pure_name(value):
    """Lower case, letters, digits and single spaces only."""
    kept = F.regexp_replace(F.trim(F.lower(_col(value))), r"[^\p{L}\p{N}\s]", "")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def quote_regex(text):
    """Escape regex metacharacters so that Java and RE2 read them literally."""
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-" else ch for ch in text)


def suffix_pattern(suffixes=None):
    """One pattern for all suffixes, grouped by first letter for fewer attempts.

    The search takes the leftmost start and the end is fixed, so the longest
    suffix matches whatever the order of the alternatives.
    """
    tails = {}
    for form in fixed.legal_suffixes() if suffixes is None else suffixes:
        tails.setdefault(form.lower()[0], []).append(form.lower()[1:])
    groups = [
        f"{quote_regex(first)}(?:{'|'.join(quote_regex(tail) for tail in rest)})"
        for first, rest in sorted(tails.items())
    ]
    return " (?:" + "|".join(groups) + ")$"


def prefix_pattern(prefixes=None):
    forms = fixed.legal_prefixes() if prefixes is None else prefixes
    return "^(?:" + "|".join(quote_regex(form.lower()) for form in forms) + ") "


def strip_legal_form(value, suffixes=None, prefixes=None):
    """A struct of ``regexed_name`` and ``pure_name_replaced_by``.

    The longest suffix goes first; a prefix goes only where no suffix went.
    """
    value = _col(value)
    without_suffix = F.regexp_replace(value, suffix_pattern(suffixes), "")
    without_prefix = F.regexp_replace(value, prefix_pattern(prefixes), "")
    cut_suffix = without_suffix != value
    return F.struct(
        F.when(cut_suffix, without_suffix).otherwise(without_prefix).alias("regexed_name"),
        F.when(cut_suffix, "suffix")
        .when(without_prefix != value, "prefix")
        .alias("pure_name_replaced_by"),
    )


def join_address(*parts, separator=", "):
    """The parts that are there, null only where none is."""
    parts = [_col(part) for part in parts]
    if not parts:
        return F.lit(None).cast("string")
    return F.when(F.coalesce(*parts).isNotNull(), F.concat_ws(separator, *parts))


def describe(labelled):
    """``label: value`` lines for (label, column) pairs, empty for null."""
    return F.concat_ws(
        "\n",
        *[
            F.concat(F.lit(f"{label}: "), F.coalesce(_col(value), F.lit("")))
            for label, value in labelled
        ],
    )


def split_provenance(value):
    """``source;link`` as a struct of ``data_source`` and ``link``."""
    parts = F.split(_col(value), ";", 2)
    return F.struct(F.get(parts, 0).alias("data_source"), F.get(parts, 1).alias("link"))


def first_name_last_name(value):
    """A struct of first, last and middle name from a full name."""
    words = F.split(_col(value), " ")
    count = F.size(words)
    return F.struct(
        F.get(words, 0).alias("first_name"),
        F.get(words, count - 1).alias("last_name"),
        F.when(
            count > 2, F.concat_ws(" ", F.slice(words, 2, F.greatest(count - 2, F.lit(0))))
        ).alias("middle_name"),
    )


def person_name(value):
    """Letters, space, dot and hyphen only, capitalised also after the first dot."""
    name = F.initcap(F.regexp_replace(F.lower(_col(value)), "[^a-zA-Z .-]", ""))
    halves = F.split(name, "[.]", 2)
    tail = F.get(halves, 1)
    return F.when(
        tail.isNotNull(), F.concat(F.get(halves, 0), F.lit("."), F.initcap(tail))
    ).otherwise(name)
