"""Collections nested per key (A3-A5), in a declared number of parts per key."""

from pyspark.sql import functions as F

PARTS = 1


def child_rows(df, keys, fields):
    """A3 as a table of its own: (keys, item, copies), one row per distinct item of a key."""
    return df.groupBy(*keys, F.struct(*fields).alias("item")).agg(F.count("*").alias("copies"))


def nest(df, keys, fields, alias, parts=PARTS):
    """A3: the rows of a key as sorted arrays of structs, one per ``part``.

    Equal rows are counted before the shuffle. A row goes to a part by its hash,
    equal rows to as many parts as there are, so each of the ``parts`` arrays of a
    key has a like share. ``parts`` is chosen for the table, never from the data: the key of the
    result is (keys, part) at every size. Parts without rows are left out here;
    ``attach_nested`` gives every key all of them.
    """
    counted = child_rows(df, keys, fields)
    spread = counted.withColumn("turn", F.explode(F.sequence(F.lit(0), F.least(F.col("copies"), F.lit(parts)).cast("int") - 1)))
    placed = spread.select(
        *keys,
        "item",
        F.pmod(F.xxhash64("item") + F.col("turn"), F.lit(parts)).cast("int").alias("part"),
        F.floor((F.col("copies") - F.col("turn") + parts - 1) / parts).cast("int").alias("copies"),
    )
    repeated = F.struct("item", "copies")
    return placed.groupBy(*keys, "part").agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(repeated)),
                lambda x: F.array_repeat(x["item"], x["copies"]),
            )
        ).alias(alias)
    )


def attach_nested(spine, keys, nested, parts=PARTS):
    """Left-join nested collections: each key of the spine has ``parts`` rows, 0 to parts - 1.

    Every part has the attributes of the key and its own share of the arrays.
    """
    merged = nested[0]
    for other in nested[1:]:
        merged = merged.join(other, [*keys, "part"], "full_outer")
    numbered = spine.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return numbered.join(merged, [*keys, "part"], "left")


def struct_of_firsts(df, keys, columns, order, alias):
    """A4: a struct of the first non-null values per key."""
    from ledgerloom.operators.dedupe import first_value_by

    return df.groupBy(*keys).agg(
        F.struct(*[first_value_by(c, order).alias(c) for c in columns]).alias(alias)
    )


def joined_values(column, separator="; "):
    """A5: distinct values as one sorted text; copies merge before the shuffle."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def value_rows(df, keys, columns):
    """A5 as a table of its own: (keys, column, value), each value of a key once, in as many rows as there are."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    rows = df.select(*keys, F.explode(F.array(*cells)).alias("cell")).select(*keys, "cell.*")
    return rows.where(F.col("value").isNotNull()).distinct()
