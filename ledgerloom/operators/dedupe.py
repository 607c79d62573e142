"""One row per key, and groups folded into one row. Every order is total."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType


def total_order(df, keys, first=()):
    """The given order, then every other column, so that ties are equal rows."""
    rest = [
        F.to_json(f.name) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in keys
    ]
    return [*first, *[column.asc_nulls_last() for column in rest]]


def first_per_key(df, keys, order=(), complete=True):
    """The first row of every key.

    Spark keeps one row per key in every map task before the shuffle
    (WindowGroupLimit), so a key with most of the rows costs no single task.
    """
    order = total_order(df, keys, order) if complete else list(order)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def most_complete_per_key(df, keys, preferred, order=()):
    """The row whose preferred columns are filled, in that order of weight."""
    filled = [F.col(name).isNull().asc() for name in preferred]
    return first_per_key(df, keys, [*filled, *order])


def name_quality(name="name", hash_key="dv_hashkey_company"):
    """Plain spelling first, then the longer name, then the text and its key."""
    plain = F.regexp_replace(name, "[^a-zA-Z0-9&,. ]", "") == F.col(name)
    return [
        F.when(plain, 0).otherwise(1).asc(),
        F.length(name).desc(),
        F.col(name).asc(),
        F.col(hash_key).asc(),
    ]


def first_value_by(column, order):
    """A2: first non-null value by an order, mergeable before the shuffle."""
    column = F.col(column) if isinstance(column, str) else column
    return F.min_by(column, F.when(column.isNotNull(), F.struct(*order)))


def distinct_items(df, keys, column):
    """A1: the distinct elements of all arrays of a key, sorted, one row per key that has any.

    Elements are made distinct one by one, in every map task before the
    shuffle, so no task holds the arrays of a key; only what is left comes together.
    """
    items = df.select(*keys, F.explode(column).alias("__item")).distinct()
    held = F.array_sort(F.collect_list(F.struct(F.isnull("__item").alias("__last"), "__item")))
    return items.groupBy(*keys).agg(F.transform(held, lambda x: x["__item"]).alias(column))


def consolidate(df, keys, order, rules=None, include=None, exclude=()):
    """A1: one row per key by type.

    Arrays give their distinct elements, sorted; booleans whether any is true;
    all else the first non-null value by ``order``. ``rules`` maps a column to
    an aggregate of its own. Values need not be orderable, so maps are allowed.
    """
    rules = rules or {}
    chosen = [
        f
        for f in df.schema.fields
        if f.name not in keys and f.name not in exclude and (not include or f.name in include)
    ]
    arrays = [f for f in chosen if isinstance(f.dataType, ArrayType) and f.name not in rules]
    folded = [_folded(f, order, rules).alias(f.name) for f in chosen if f not in arrays]
    out = df.groupBy(*keys).agg(*folded) if folded else df.select(*keys).distinct()
    for field in arrays:
        items = distinct_items(df, keys, field.name).withColumnsRenamed({k: f"__{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        none = F.array().cast(field.dataType)
        out = out.join(items, same, "left").drop(*[f"__{k}" for k in keys])
        out = out.withColumn(field.name, F.coalesce(field.name, none))
    return out.select(*keys, *[f.name for f in chosen])


def _folded(field, order, rules):
    if field.name in rules:
        return rules[field.name](field.name)
    if isinstance(field.dataType, BooleanType):
        return F.max(field.name)
    return first_value_by(field.name, order)


def first_non_null(df, keys, columns, order):
    """A2 over many columns in one aggregation."""
    return df.groupBy(*keys).agg(*[first_value_by(c, order).alias(c) for c in columns])


def latest_version(df, version, keys=()):
    """The row of the highest version, of all or of every key."""
    chosen = F.max_by(F.struct(*df.columns), F.col(version)).alias("row")
    return (df.groupBy(*keys).agg(chosen) if keys else df.agg(chosen)).select("row.*")
