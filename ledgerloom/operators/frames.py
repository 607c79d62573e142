"""Shape of a frame: declared schema, column names, nesting, unions."""

import re
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ledgerloom.functions import text


def enforce_schema(df, schema, keep_new=False):
    """B1: declared columns, types and order in one projection.

    What cannot be cast becomes null, what is absent a typed null.
    """
    present = set(df.columns)
    columns = [
        (
            F.col(f"`{field.name}`").try_cast(field.dataType)
            if field.name in present
            else F.lit(None).cast(field.dataType)
        ).alias(field.name)
        for field in schema.fields
    ]
    declared = set(schema.fieldNames())
    extra = [f"`{name}`" for name in df.columns if name not in declared] if keep_new else []
    return df.select(*columns, *extra)


def snake_case(name):
    """B2 for one name."""
    joined = re.sub(r"[\s.]", "_", re.sub(r"\s+", " ", name.strip()))
    return re.sub("(?<=[a-z0-9])(?=[A-Z])", "_", joined).lower()


def snake_case_columns(df):
    """B2: all column names in snake case."""
    return df.toDF(*[snake_case(name) for name in df.columns])


def _map_strings(df, builder):
    return df.select(
        *[
            builder(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def clean_strings(df):
    """B3 on every string column."""
    return _map_strings(df, text.clean_text)


def blanks_to_null(df):
    """B6 on every string column."""
    return _map_strings(df, text.blank_to_null)


def sentinels_to_null(df, sentinels=tuple(text.fixed.NULL_SENTINELS)):
    """B7 on every string column."""
    return _map_strings(df, lambda c: text.sentinel_to_null(c, sentinels))


def _leaves(schema, path=(), name=()):
    for field in schema.fields:
        here = (path + (f"`{field.name}`",), name + (field.name,))
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, *here)
        else:
            yield F.col(".".join(here[0])).alias("_".join(here[1]))


def flatten_structs(df):
    """Struct fields at any depth as ``parent_child`` columns, one projection."""
    return df.select(*_leaves(df.schema))


def flatten_properties(df, column="properties", explode=()):
    """Lift a struct's fields; explode the arrays that are asked for.

    Each exploded array multiplies the rows of the others, so only name
    arrays that belong together with every other one.
    """
    kept = [F.col(name) for name in df.columns if name != column]
    lifted = df.select(*kept, f"{column}.*")
    for name in explode:
        lifted = lifted.withColumn(name, F.explode_outer(name))
    return lifted


def project_paths(df, paths):
    """Nested paths as top-level columns, by mapping of name to path."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def with_load_date(df, load_date=None):
    """A constant load date, or today's."""
    return df.withColumn("load_date", F.current_date() if load_date is None else F.lit(load_date))


def columns_to_rows(df, columns, value, drop_nulls=False):
    """Repeated columns as one row each."""
    kept = [name for name in df.columns if name not in columns]
    rows = df.select(*kept, F.explode(F.array(*columns)).alias(value))
    return rows.where(F.col(value).isNotNull()) if drop_nulls else rows


def reshape(df, rename=None, constants=None, drop=(), select=None, prefix=None):
    """Rename, add constants, drop, choose and prefix in one projection."""
    rename = rename or {}
    constants = constants or {}
    columns = {
        rename.get(name, name): F.col(f"`{name}`") for name in df.columns if name not in drop
    }
    columns.update(
        {name: value if hasattr(value, "alias") else F.lit(value) for name, value in constants.items()}
    )
    chosen = select or list(columns)
    return df.select(*[columns[name].alias(f"{prefix}_{name}" if prefix else name) for name in chosen])


def union_all(*frames):
    """Union by name, what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
