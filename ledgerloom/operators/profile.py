"""Profiles of a frame and comparison of two (Q7, Q9, A10)."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, FloatType, NumericType, StringType, TimestampNTZType, TimestampType,
)

from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.joins import outer_compare, small_side
from ledgerloom.sources.staging import staged


def _statistics(field):
    """(statistic, aggregate) pairs of one column by its type."""
    column = F.col(f"`{field.name}`")
    count_if = lambda test: F.count(F.when(test, 1)).cast("double")
    statistics = {
        "null_count": count_if(column.isNull()),
        "null_percentage": F.try_divide(count_if(column.isNull()) * 100, F.count("*")),
    }
    if isinstance(field.dataType, NumericType):
        statistics |= {
            "count": F.count(column),
            "mean": F.avg(column),
            "stddev": F.stddev(column),
            "min": F.min(column),
            "max": F.max(column),
            "zero_count": count_if(column == 0),
            "negative_count": count_if(column < 0),
        }
    elif isinstance(field.dataType, StringType):
        statistics |= {
            "empty_count": count_if(F.length(column) == 0),
            "min_length": F.min(F.length(column)),
            "max_length": F.max(F.length(column)),
            "avg_length": F.avg(F.length(column)),
        }
    elif isinstance(field.dataType, BooleanType):
        statistics |= {"true_count": count_if(column), "false_count": count_if(~column)}
    elif isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
        day = F.to_date(column)
        epoch = F.lit("1970-01-01").cast("date")
        statistics |= {
            "min_epoch_day": F.date_diff(F.min(day), epoch),
            "max_epoch_day": F.date_diff(F.max(day), epoch),
        }
    return statistics


def _cells(df, columns):
    """(column, value) of every value, as text: one narrow row per cell."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (FloatType, DoubleType))}
    value = lambda name: F.col(f"`{name}`") + F.lit(0.0) if name in floating else F.col(f"`{name}`")
    cells = [F.struct(F.lit(c).alias("column"), value(c).cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def _distinct_statistic(field):
    if isinstance(field.dataType, NumericType):
        return "distinct"
    return "distinct_dates" if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)) else None


def _distinct_counts(df, fields):
    """Distinct values per column, from cells that are made distinct before they move."""
    cells = _cells(df, [f.name for f in fields]).where(F.col("value").isNotNull()).distinct()
    counts = cells.groupBy(F.col("column").alias("__column")).agg(F.count("*").alias("n"))
    asked = [F.struct(F.lit(f.name).alias("column"), F.lit(_distinct_statistic(f)).alias("statistic")) for f in fields]
    names = df.sparkSession.range(1).select(F.explode(F.array(*asked)).alias("x")).select("x.*")
    return names.join(counts, F.col("column") == F.col("__column"), "left").select(
        "column", "statistic", F.coalesce("n", F.lit(0)).cast("double").alias("value")
    )


def profile(df, columns=None):
    """One row per column and statistic; distinct values are counted apart from the rest."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    entries = [(f.name, name, value) for f in fields for name, value in _statistics(f).items()]
    row = df.agg(*[value.cast("double").alias(f"s{i}") for i, (_, _, value) in enumerate(entries)])
    cells = [
        F.struct(
            F.lit(column).alias("column"), F.lit(name).alias("statistic"),
            F.col(f"s{i}").alias("value"),
        )
        for i, (column, name, _) in enumerate(entries)
    ]
    rows = row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    counted = [f for f in fields if _distinct_statistic(f)]
    return rows.unionByName(_distinct_counts(df, counted)) if counted else rows


def top_values(df, columns, k=5):
    """A10: the k most frequent values of every column, from one grouping.

    Counting is per column and value before any ranking, and each task ranks
    its own counts down to k before they move.
    """
    from pyspark.sql import Window

    cells = [
        F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("value"))
        for name in columns
    ]
    counts = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*")
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )
    window = Window.partitionBy("column").orderBy(
        F.col("count").desc(), F.col("value").asc_nulls_last()
    )
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def compare(left, right, keys):
    """Q9: per common column, how often both sides agree.

    Rows meet by key in a full outer join. Totals of both sides repeat on
    every row; a column that only one side has is listed with nulls.
    """
    common = [c for c in left.columns if c in right.columns and c not in keys]
    lonely = [c for c in left.columns if c not in right.columns] + [
        c for c in right.columns if c not in left.columns
    ]
    both = outer_compare(left, right, keys, null_safe=False)
    count_if = lambda test: F.count(F.when(test, 1))

    def figures(name):
        a, b = F.col(f"l.`{name}`"), F.col(f"r.`{name}`")
        return [
            count_if(a == b), count_if(a != b),
            count_if(a.isNull() & b.isNotNull()), count_if(a.isNotNull() & b.isNull()),
            count_if(F.col("l").isNotNull() & a.isNull()),
            count_if(F.col("r").isNotNull() & b.isNull()),
        ]

    labels = ["matching", "different", "null_in_left", "null_in_right", "left_nulls", "right_nulls"]
    totals = {
        "left_rows": count_if(F.col("l").isNotNull()),
        "right_rows": count_if(F.col("r").isNotNull()),
        "total_rows": F.count("*"),
    }
    row = both.agg(
        *[value.alias(name) for name, value in totals.items()],
        *[
            figure.alias(f"f{i}_{j}")
            for i, name in enumerate(common)
            for j, figure in enumerate(figures(name))
        ],
    )
    none = F.lit(None).cast("bigint")
    cells = [
        F.struct(
            F.lit(name).alias("column"), *totals,
            *[F.col(f"f{i}_{j}").alias(label) for j, label in enumerate(labels)],
        )
        for i, name in enumerate(common)
    ] + [
        F.struct(F.lit(name).alias("column"), *totals, *[none.alias(label) for label in labels])
        for name in lonely
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def bucket_sums(df, keys, columns, buckets):
    """One row per bucket of keys: rows, and of each column two order-free checksums and the values that are not null.

    Rows with a null key are in bucket -1. Only these sums move, one row a task and bucket.
    """
    return _bucketed(df, keys, buckets).groupBy("__bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            agg.alias(f"{kind}{i}")
            for i, name in enumerate(columns)
            for kind, agg in (
                ("x", F.bit_xor(F.xxhash64(*keys, F.col(f"`{name}`")))),
                ("s", F.sum(F.xxhash64(F.col(f"`{name}`"), *keys) % F.lit(1 << 31))),
                ("n", F.count(F.col(f"`{name}`"))),
            )
        ],
    )


def _bucketed(df, keys, buckets):
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    number = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    return df.withColumn("__bucket", F.when(whole, number).otherwise(F.lit(-1)))


def compare_buckets(left, right, keys, buckets=4096):
    """Q9: ``compare``, joining only the rows of buckets whose checksums differ.

    Keys must be unique on either side, as a frame's key is. A bucket whose
    rows, checksums and numbers of values agree for every common column is
    equal but for a collision of two 64-bit sums; its figures follow from its sums. So two
    loads of a table that differ in a few places move a few buckets, not the table.
    Common columns need the same type on both sides, else every bucket differs.
    """
    common = [c for c in left.columns if c in right.columns and c not in keys]
    sums = [staged(bucket_sums(df, keys, common, buckets), "bucket-sums") for df in (left, right)]
    names = [c for c in sums[0].columns if c != "__bucket"]
    theirs = sums[1].select(F.col("__bucket").alias("__other"), *[F.col(c).alias(f"__{c}") for c in names])
    agree = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names])
    pairs = sums[0].join(theirs, F.col("__bucket") == F.col("__other"), "full_outer").withColumn(
        "__equal", F.coalesce(agree & (F.col("__bucket") >= 0), F.lit(False))
    )
    pairs = staged(pairs, "bucket-pairs")
    open_buckets = small_side(pairs.where("not __equal").select(F.coalesce("__bucket", "__other").alias("__bucket")))
    rest = [_bucketed(df, keys, buckets).join(open_buckets, "__bucket", "left_semi").drop("__bucket") for df in (left, right)]
    found = compare(*rest, keys)

    same = pairs.where("__equal").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(common))],
    )
    cells = [F.struct(F.lit(name).alias("__column"), "rows", F.col(f"n{i}").alias("values")) for i, name in enumerate(common)]
    lonely = [c for c in [*left.columns, *right.columns] if (c in left.columns) != (c in right.columns)]
    cells += [F.struct(F.lit(name).alias("__column"), "rows", F.lit(None).cast("bigint").alias("values")) for name in lonely]
    settled = same.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    nulls = F.col("rows") - F.col("values")
    more = {
        "left_rows": F.col("rows"), "right_rows": F.col("rows"), "total_rows": F.col("rows"), "matching": F.col("values"),
        "left_nulls": nulls, "right_nulls": nulls,
    }
    both = found.join(settled, F.col("column") == F.col("__column"))
    return both.select(*[(F.col(c) + more[c]).alias(c) if c in more else F.col(c) for c in found.columns])


def differences(left, right, keys, samples=5):
    """Q9: per column up to ``samples`` differing rows, the first by key."""
    common = [c for c in left.columns if c in right.columns and c not in keys]
    both = outer_compare(left, right, keys, null_safe=False)
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"l.`{name}`").cast("string").alias("left_value"),
            F.col(f"r.`{name}`").cast("string").alias("right_value"),
            (F.col(f"l.`{name}`") != F.col(f"r.`{name}`")).alias("differs"),
        )
        for name in common
    ]
    rows = (
        both.select(*keys, F.explode(F.array(*cells)).alias("cell"))
        .where("cell.differs")
        .select(*keys, "cell.column", "cell.left_value", "cell.right_value")
    )
    if samples == 1:
        return first_per_key(rows, ["column"], [F.col(k).asc() for k in keys])
    from pyspark.sql import Window

    window = Window.partitionBy("column").orderBy(*keys)
    return (
        rows.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= samples)
        .drop("rank")
    )
