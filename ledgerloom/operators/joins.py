"""Joins that Spark's planner does not already give by ``DataFrame.join``."""

from functools import reduce

from pyspark.sql import functions as F

BROADCAST_LIMIT = 32 * 1024 * 1024
BUILD_LIMIT = 4 * 1024 * 1024
ISIN_LIMIT = 10


def plan_bytes(df):
    """Spark's own size estimate of a frame, from its optimised plan (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(df, limit=BROADCAST_LIMIT):
    """Hint a broadcast only while the estimated size is within the limit.

    Beyond it the frame goes unhinted: Spark then shuffles both sides, and
    splits skewed partitions at run time.
    """
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def build_side(df, limit=BUILD_LIMIT):
    """A side with few rows per key: broadcast while small, beyond that shuffled into hash tables.

    The other side streams past the tables and is never sorted, so a task holds rows of this side alone.
    """
    return F.broadcast(df) if plan_bytes(df) <= limit else df.hint("shuffle_hash")


def keys_equal(left, right, keys, null_safe=True):
    """Join condition over equally named keys of two aliased frames."""
    pairs = [(F.col(f"{left}.{key}"), F.col(f"{right}.{key}")) for key in keys]
    return reduce(
        lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    )


def anti(df, other, keys, null_safe=True):
    """Rows without a partner; nulls count as equal by default."""
    return df.alias("l").join(
        other.select(*keys).alias("r"), keys_equal("l", "r", keys, null_safe), "left_anti"
    )


def semi(df, other, keys, null_safe=False):
    """Rows with a partner, never multiplied."""
    return df.alias("l").join(
        other.select(*keys).alias("r"), keys_equal("l", "r", keys, null_safe), "left_semi"
    )


def outer_compare(left, right, keys, null_safe=True):
    """Full outer join, both sides as structs ``l`` and ``r`` (null when absent)."""
    a = left.select(*[F.col(k).alias(f"l_{k}") for k in keys], F.struct("*").alias("l"))
    b = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.struct("*").alias("r"))
    pairs = [(F.col(f"l_{key}"), F.col(f"r_{key}")) for key in keys]
    condition = reduce(
        lambda x, y: x & y, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs]
    )
    return a.join(b, condition, "full_outer").select(
        *[
            F.when(F.col("l").isNotNull(), F.col(f"l_{k}")).otherwise(F.col(f"r_{k}")).alias(k)
            for k in keys
        ],
        "l",
        "r",
    )


def on_folded_text(df, other, left_column, right_column, how="left"):
    """Equality after trimming and lower-casing both sides."""
    fold = lambda column: F.lower(F.trim(F.col(column)))
    return df.join(other, fold(left_column) == fold(right_column), how)


def on_prefix(df, other, code, prefix, length, how="left"):
    """A code against the table of its first ``length`` characters."""
    return df.join(other, F.substring(F.col(code), 1, length) == F.col(prefix), how)


def on_either(df, other, first, second, key):
    """``first = key OR second = key`` as one equi-join, each pair once.

    A row goes once with each of its different keys, so ``df`` is computed once; ``other`` has few rows per key.
    """
    keys = F.explode(F.array_distinct(F.array(first, second))).alias("_either")
    return df.select("*", keys).join(build_side(other, BROADCAST_LIMIT), F.col("_either") == F.col(key)).drop("_either")


def or_sentinel(value, sentinel="CANT MAP"):
    """What a left join did not find, as a fixed text."""
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(sentinel))


def role_play(df, dimension, roles, key, columns, limit=BROADCAST_LIMIT):
    """One dimension joined once per role.

    ``roles`` maps a prefix to the column that holds the role's key; the
    dimension must have one row per key.
    """
    for prefix, column in roles.items():
        role = dimension.select(
            F.col(key).alias(f"{prefix}__key"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in columns],
        )
        df = df.join(
            small_side(role, limit), F.col(column) == F.col(f"{prefix}__key"), "left"
        ).drop(f"{prefix}__key")
    return df


def keep_values(df, column, values):
    """a few values by ``isin``, many by a semi join with a value table."""
    if len(values) < ISIN_LIMIT:
        return df.where(F.col(column).isin(list(values)))
    table = df.sparkSession.createDataFrame(
        [(value,) for value in values], df.select(column).schema
    )
    return df.join(table, column, "left_semi")
