"""Sinks (S9, S11-S13) and the high-water log (M9)."""

import logging

from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerloom.operators import merge
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.frames import enforce_schema
from ledgerloom.sources.staging import staged

LOG = logging.getLogger(__name__)


def roots_read(df):
    """The folders that a frame reads, from its plan (no job)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation" and "location" in dir(leaf.relation()):
            paths = leaf.relation().location().rootPaths()
            found.update(str(paths.apply(i).toString()) for i in range(paths.size()))
    return found


def _not_its_own(df, contract):
    """Refuse to replace a table by a frame that reads it; log what replaces it."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(contract.location)
    target = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    read = roots_read(df)
    if any(f"{root}/".startswith(f"{target}/") for root in read):
        raise ValueError(f"the frame reads {target}, which it is to replace; stage it first")
    LOG.info("replacing %s by rows of %s", target, sorted(read))


def table_state(spark, contract):
    """The table as it is, empty by its declared schema before the first load.

    Files are read by the declared schema where there is one, so a column that
    was declared later is there, null in older files.
    """
    reader = spark.read.format(contract.format)
    if contract.struct_type is not None and contract.format in ("parquet", "orc", "json"):
        reader = reader.schema(contract.struct_type)
    try:
        return reader.load(contract.location)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], contract.struct_type)


def _for_layout(df, partition_by):
    """Gather rows by partition values; Spark splits values that are large."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df, contract, schema=None):
    """Append after casting to the table's, else the declared schema."""
    schema = schema or contract.struct_type
    shaped = enforce_schema(df, schema) if schema is not None else df
    (
        _for_layout(shaped, contract.partition_by)
        .write.format(contract.format)
        .mode("append")
        .partitionBy(*contract.partition_by)
        .options(**contract.options)
        .save(contract.location)
    )


def replace_partitions(df, contract):
    """Overwrite only the partitions that the frame holds.

    The frame must not read from the location it replaces; stage it first.
    """
    _not_its_own(df, contract)
    (
        _for_layout(df, contract.partition_by)
        .write.format(contract.format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*contract.partition_by)
        .options(**contract.options)
        .save(contract.location)
    )


def merge_write(spark, contract, updates, keys, step, version=None, committed=None):
    """M3 / M5 / M8 in one call: merge the updates into a table and give the changes.

    Only partitions that the updates reach are read. ``step(base, updates)`` is
    what the merge does to that part, as ``merge.Changes`` (``merge.upsert_changes``,
    ``merge.scd2_changes``), or its next state. With changes only partitions that
    really change are rewritten, none where nothing does, and the feed is
    the changes; a next state is compared with the part. What replaces a partition is
    staged first, and its location logged, so a broken write can be repeated
    from there. A key must not move between partitions.
    """
    base = table_state(spark, contract)
    reached = merge.touched(base, updates, contract.partition_by) if contract.partition_by else base
    replace = replace_partitions if contract.partition_by else replace_all
    result = step(reached, updates)
    if not isinstance(result, merge.Changes):
        before = staged(reached, "before")
        after = staged(enforce_schema(step(before, updates), contract.struct_type or before.schema), "after")
        replace(after, contract)
        return merge.change_feed(before, after, keys, version, committed=committed)
    changes = result.staged()
    changed = changes.changed()
    if not changed.isEmpty():
        kept = merge.touched(changes.kept, changed, contract.partition_by) if contract.partition_by else changes.kept
        after = kept.unionByName(changed, allowMissingColumns=True)
        replace(staged(enforce_schema(after, contract.struct_type or base.schema), "after"), contract)
    return changes.feed(version, committed)


def replace_all(df, contract):
    """Truncate and insert; the frame must not read the table."""
    _not_its_own(df, contract)
    (
        _for_layout(df, contract.partition_by)
        .write.format(contract.format)
        .mode("overwrite")
        .partitionBy(*contract.partition_by)
        .options(**contract.options)
        .save(contract.location)
    )


def write_jdbc(df, url, table, mode="append", batch_size=10_000, connections=8, **properties):
    """A table in a database, over a bounded number of connections."""
    (
        df.write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .options(**properties)
        .save()
    )


def search_documents(entities):
    """Search documents of trade companies, one per id, the first by its columns."""
    rows = (
        entities.where("is_trade and id is not null")
        .select("id", "name", "description", "jurisdiction", F.col("country_name").alias("country"))
    )
    return first_per_key(rows, ["id"])


def export_search_documents(entities, location, partition_by="country"):
    """The documents as json lines, for a search index to read."""
    documents = search_documents(entities).withColumn("partition", F.col(partition_by))
    documents.hint("rebalance", "partition").write.partitionBy("partition").json(location)


def last_version(spark, log_location):
    """M9: the highest processed version, None before the first run."""
    try:
        log = spark.read.parquet(log_location)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.agg(F.max("version")).first()[0]


def unprocessed(feed, processed):
    """M9: changes above the high-water mark (all of them at first)."""
    return feed if processed is None else feed.where(F.col("_commit_version") > processed)


def advance(spark, log_location, version):
    """M9: note a version as processed; False when there is nothing new."""
    known = last_version(spark, log_location)
    if known is not None and version <= known:
        return False
    spark.createDataFrame([(version,)], "version bigint").coalesce(1).write.mode("append").parquet(
        log_location
    )
    return True
