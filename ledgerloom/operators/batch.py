"""Running sums in two levels, balanced groups of partition values, and runs over them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import small_side
from ledgerloom.sources.staging import staged

#: ``monotonically_increasing_id`` numbers the rows of a partition in its low 33 bits.
ROW_BITS = 33
#: Staged bytes up to which the totals of the parts are broadcast.
OFFSET_LIMIT = 2 * 1024 * 1024


def in_order(df, order, name="ordered"):
    """The rows sorted over all tasks and staged, with ``part`` and ``place``, which follow the order.

    Range partitioning deals the rows, so no task sorts them all; ``running_sum``
    over the parts gives ranks and totals.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = dealt.withColumn("place", F.monotonically_increasing_id())
    return staged(placed.withColumn("part", F.shiftright("place", ROW_BITS)), name)


def running_sum(df, value, part, order, within=(), name="before"):
    """The sum of ``value`` over the rows before each one, by group and order, as column ``name``.

    ``part`` numbers consecutive stretches of the order. Sums of the parts are
    taken in every map task; only they, one row a part, are added up in a row,
    and each part adds its own rows. So no task reads a group as a whole.
    """
    keys = [*within, part]
    sums = staged(df.groupBy(*keys).agg(F.sum(value).alias("__sum")), "parts")
    earlier = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset")
    )
    offsets = staged(offsets, "offsets")
    own = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    summed = df.withColumn("__own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    total = F.col("__own") + F.col("__offset")
    return (
        summed.join(small_side(offsets, OFFSET_LIMIT), same).withColumn(name, total)
        .drop("__own", "__offset", *[f"__{k}" for k in keys])
    )


def running_total(counts, count="cnt"):
    """Running sum of counts by size; equal counts share their sum.

    The sum depends on the count alone, so it runs over distinct counts, of
    which N rows have fewer than sqrt(2 N), in two levels.
    """
    return _running(counts, count).drop("__total")


def _running(counts, count):
    by_size = counts.groupBy(count).agg(F.sum(count).alias("size_total"))
    placed = in_order(by_size, [F.col(count)], "sizes")
    total = placed.agg(F.sum("size_total")).first()[0]
    sums = running_sum(placed, "size_total", "part", ["place"], name="earlier").select(
        F.col(count).alias("__size"),
        (F.col("earlier") + F.col("size_total")).alias("running_sum"),
        F.lit(total).cast("bigint").alias("__total"),
    )
    return counts.join(sums, F.col(count) == F.col("__size")).drop("__size")


def balanced_groups(df, n_groups, column="jurisdiction"):
    """A group number per partition value, by running row count."""
    counts = df.groupBy(column).agg(F.count("*").alias("cnt"))
    share = F.col("running_sum") / (F.col("__total") / n_groups)
    return (
        _running(counts, "cnt")
        .withColumn("group_number", F.least(F.floor(share) + 1, F.lit(n_groups)))
        .select(column, "cnt", "running_sum", "group_number")
    )


def group_summary(groups, column="jurisdiction"):
    """Values and rows per group, and its first and last value; ``balanced_groups`` has the rest as rows."""
    return groups.groupBy("group_number").agg(
        F.count("*").alias("num_values"),
        F.sum("cnt").alias("total_cnt"),
        F.min(column).alias("first_value"),
        F.max(column).alias("last_value"),
    )


def run_in_groups(df, n_groups, transform, column="jurisdiction"):
    """A transform over all groups as one plan, laid out for bounded writes.

    The group number becomes a column. The rebalance hint gathers a group for
    writing, and lets Spark split a large one by the sizes it measured.
    """
    groups = balanced_groups(df, n_groups, column).select(
        F.col(column).alias("__value"), "group_number"
    )
    placed = df.join(groups, F.col(column).eqNullSafe(F.col("__value")), "left").drop("__value")
    return transform(placed).hint("rebalance", "group_number")
