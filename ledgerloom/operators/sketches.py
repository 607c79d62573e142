"""Profiles that merge (Q7, A10): one small row per column and load, from which the profile of any union of loads follows.

Row counts, nulls and extremes are exact. Distinct values, quantiles and frequent
values are sketches, whose size does not follow the data: distinct counts are
off by at most ``DISTINCT_ERROR`` of themselves, quantiles by ``RANK_ERROR`` of the rows
(three standard errors each), and a value's count by the rows over ``ITEMS``, not at all
in a column of fewer values than that.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Registers of a distinct sketch as a power of two, values that an item sketch tracks, and the errors they leave.
REGISTERS, ITEMS = 12, 1024
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03


def profile_state(df, columns=None):
    """One row per column: what a load leaves of it, from one pass over the load."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    cells = []
    for f in fields:
        column, text = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").cast("string")
        number = column.cast("double") if isinstance(f.dataType, NumericType) else F.lit(None).cast("double")
        cells.append([
            F.count(F.lit(1)).alias("rows"), F.count(F.when(column.isNull(), 1)).alias("nulls"),
            F.min(number).alias("least"), F.max(number).alias("most"),
            F.hll_sketch_agg(text, F.lit(REGISTERS)).alias("distinct_sketch"),
            F.kll_sketch_agg_double(number).alias("quantile_sketch"),
            F.expr(f"approx_top_k_accumulate(cast(`{f.name}` as string), {ITEMS})").alias("item_sketch"),
        ])
    names = ["rows", "nulls", "least", "most", "distinct_sketch", "quantile_sketch", "item_sketch"]
    row = df.agg(*[value.alias(f"{name}{i}") for i, own in enumerate(cells) for name, value in zip(names, own)])
    each = [
        F.struct(F.lit(f.name).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in names]) for i, f in enumerate(fields)
    ]
    return row.select(F.explode(F.array(*each)).alias("cell")).select("cell.*")


def merge_states(states):
    """One row per column from the rows of several loads, as if they had been one load."""
    return states.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.expr(f"approx_top_k_combine(item_sketch, {ITEMS})").alias("item_sketch"),
    )


def profile_of(states, shares=(0.25, 0.5, 0.75), k=5):
    """Statistics of merged states: rows, nulls, least, most, distinct_values, quantiles (null where not of numbers), top."""
    numbers = F.col("most").isNotNull()
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(s)) for s in shares])
    return states.select(
        "column", "rows", "nulls", "least", "most",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        F.when(numbers, quantiles).alias("quantiles"),
        F.expr(f"approx_top_k_estimate(item_sketch, {int(k)})").alias("top"),
    )
