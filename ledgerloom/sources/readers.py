"""Scans (S1, S3-S5, S7, S8, S14)."""

from pyspark.sql import functions as F

from ledgerloom.operators.joins import small_side


def read_source(spark, spec):
    """One input as a frame. A bad path, option or filter raises."""
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    df = reader.load(spec.location)
    return df.where(spec.filter) if spec.filter else df


def read_sources(spark, specs, only=None):
    """Inputs by name, or just the named ones."""
    chosen = {spec.name: spec for spec in specs if only is None or spec.name in only}
    absent = set(only or ()) - set(chosen)
    if absent:
        raise KeyError(f"undeclared inputs: {sorted(absent)}")
    return {name: read_source(spark, spec) for name, spec in chosen.items()}


def read_csv(spark, path, schema=None, **options):
    """S3: csv with header; quoted fields may span lines when asked for.

    Without a schema all columns are text, to be cast by contract; guessing
    types would read the source once more.
    """
    settings = {"header": True, "quote": '"', "escape": '"', **options}
    return spark.read.csv(path, schema=schema, **settings)


def read_json(spark, path, schema=None, **options):
    """Json by path or glob."""
    return spark.read.options(**options).json(path, schema=schema)


def read_path_sql(spark, path, fmt="parquet"):
    """A path as a table in SQL."""
    return spark.sql(f"select * from {fmt}.`{path}`")


def read_parts(spark, pattern, schema=None, **options):
    """All csv parts in one scan, each row with the file it came from."""
    return read_csv(spark, pattern, schema, **options).withColumn(
        "source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    )


def read_lookup(spark, path):
    """A lookup csv, all text; "NA" stays a value. Broadcast while small."""
    return small_side(spark.read.csv(path, header=True, inferSchema=False))


def read_since(df, load_ts=None, load_date=None):
    """Rows loaded since a timestamp or date; a partition column is pruned."""
    if load_ts is not None:
        df = df.where(F.col("dv_loaddts") >= F.lit(load_ts).cast("timestamp"))
    if load_date is not None:
        df = df.where(F.col("load_date") >= F.lit(load_date))
    return df
