"""Code columns and dictionary translation."""

from itertools import chain

from pyspark.sql import functions as F

from ledgerloom.functions import fixed
from ledgerloom.functions.text import _col


def literal_map(entries):
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(entries.items())])


def translate(value, entries, keep_unmapped=True):
    """Dictionary lookup; unmapped values stay, or become null."""
    value = _col(value)
    found = literal_map(entries)[value]
    return F.coalesce(found, value) if keep_unmapped else found


def untranslated(df, column, entries):
    """B11 strict: the distinct values a dictionary lacks (empty when complete)."""
    value = F.col(column)
    return df.where(value.isNotNull() & literal_map(entries)[value].isNull()).select(column).distinct()


def require_translation(df, column, entries):
    """B11 strict inside the plan: a value the dictionary lacks fails the job."""
    value = F.col(column)
    found = literal_map(entries)[value]
    message = F.concat(F.lit(f"no translation of {column}: "), value)
    return df.withColumn(
        column, F.when(value.isNull(), value).otherwise(F.coalesce(found, F.raise_error(message)))
    )


def contains_override(value, text, replacement, otherwise):
    """A fixed value wherever the text occurs."""
    return F.when(_col(value).contains(text), F.lit(replacement)).otherwise(otherwise)


def keep_listed(value, allowed):
    """Values outside a list become null."""
    value = _col(value)
    return F.when(value.isin(*allowed), value)


def keep_if(condition, value):
    """A value that only counts together with another."""
    return F.when(condition, _col(value))


def role_position(caption, rules=tuple(fixed.ROLE_RULES)):
    """A struct of position and position code by words in a role caption."""
    caption = _col(caption)
    lowered = F.lower(caption)
    position = code = None
    for words, name, number in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | lowered.contains(word)
        position = F.when(hit, name) if position is None else position.when(hit, name)
        code = F.when(hit, number) if code is None else code.when(hit, number)
    return F.struct(
        position.otherwise(caption).alias("position"), code.otherwise(0).alias("position_code")
    )


def status_code(status):
    """0 active, 1 inactive, 3 anything else."""
    status = _col(status)
    return (
        F.when(status.isin(*fixed.ACTIVE_STATUSES), 0)
        .when(status.isin(*fixed.INACTIVE_STATUSES), 1)
        .otherwise(3)
    )


def unspecified(value):
    """Missing and world-wide jurisdictions share one name."""
    value = _col(value)
    known = value.isNotNull() & ~value.isin(*fixed.UNSPECIFIED_JURISDICTIONS)
    return F.when(known, value).otherwise("unspecified")


def has_regnum(registration_number="registration_number"):
    """V8: 1 with a registration number, else 0."""
    return F.when(_col(registration_number).isNotNull(), 1).otherwise(0)
