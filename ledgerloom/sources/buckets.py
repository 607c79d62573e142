"""Tables whose rows lie in buckets by key (M1-M6), so that merges and key joins move no row of them.

A bucketed table is an ordinary folder of parquet files; the session's catalogue
only has to know how its files are dealt. Keys must not be null, as hash keys
never are: joins on them then are plain equalities, which is what Spark matches
with the buckets.
"""

import hashlib

from pyspark.sql import functions as F

from ledgerloom.operators.frames import enforce_schema
from ledgerloom.operators.merge import new_rows, satellite_rows

#: A bucket is one task of every merge and join: choose some multiple of the cores.
BUCKETS = 256


def table_name(contract):
    return f"{contract.name}_{hashlib.md5(contract.location.encode()).hexdigest()[:12]}"


def bucketed(spark, contract, keys, buckets=BUCKETS):
    """The table at the contract's location, known to this session as dealt by ``keys`` to ``buckets``.

    Every load and every reader has to name the same keys and number.
    """
    schema = contract.struct_type
    if contract.partition_by:
        raise ValueError("a table is dealt by buckets or by partitions, not by both")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    dealt = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"create table if not exists {table_name(contract)} ({fields}) using parquet "
        f"clustered by ({dealt}) into {int(buckets)} buckets location '{contract.location}'"
    )
    return spark.table(table_name(contract))


def append_bucketed(df, contract, keys, buckets=BUCKETS):
    """Add rows to a bucketed table, one file per bucket and load; rows with a null key are refused."""
    base = bucketed(df.sparkSession, contract, keys, buckets)
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    rows = enforce_schema(df, contract.struct_type).where(F.when(whole, True).otherwise(F.raise_error("a key is null").cast("boolean")))
    rows.select(*base.columns).repartition(buckets, *keys).write.insertInto(table_name(contract))


def merge_hub(spark, contract, updates, keys, buckets=BUCKETS, order=()):
    """M1 / M2 / M6: the rows of a load that a bucketed hub, link or bridge does not have yet, to be appended."""
    return new_rows(bucketed(spark, contract, keys, buckets), updates, keys, order, null_safe=False)


def merge_satellite(spark, contract, updates, parent, buckets=BUCKETS):
    """M4: the rows of a load that a satellite, dealt by its parent's key, does not have yet, to be appended."""
    base = bucketed(spark, contract, [parent], buckets)
    return satellite_rows(base, updates, contract.struct_type, ["dv_hashdiff"], parent, null_safe=False)
