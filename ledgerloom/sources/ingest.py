"""Files that came since the last run, each taken once (S7, S14, M9), by a file stream that stops when it has caught up."""

from pyspark.sql import functions as F

FORMATS = ("csv", "json", "parquet", "orc", "text")


def ingest_new(spark, source, target, checkpoint, schema, source_format="parquet", transform=None, partition_by=(),
               files_per_batch=None, **options):
    """Append the rows of all files below ``source`` that no earlier run has taken, and give how many there were.

    The stream's checkpoint is the high-water mark: it lists files before they
    are read and batches once they are written, and the target keeps a log of
    committed batches, so a run that dies between the two is repeated without doubling
    a row. Readers see committed files only, if they read the target as one table.
    ``transform`` is a frame-to-frame function that keeps to one row at a time.
    ``files_per_batch`` bounds what one batch reads after a long pause. A file
    that changes after it was taken is not taken again; new parts need new names.
    """
    if source_format not in FORMATS:
        raise ValueError(f"no file format: {source_format}")
    reader = spark.readStream.format(source_format).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source)
    rows = transform(rows) if transform else rows
    query = (
        rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).partitionBy(*partition_by).start(target)
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def stamped(source_version=None):
    """A ``transform`` that adds the file a row came from and the load's version."""

    def add(df):
        version = F.lit(source_version).cast("string")
        return df.withColumns({"dv_file": F.col("_metadata.file_name"), "dv_source_version": version})

    return add
