"""Intermediate results in a folder all executors share."""

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OWN_FOLDER = []
_WRITTEN = {}
_SHARED = {}


def shared_folder(spark):
    """The session's checkpoint folder, ``spark.checkpoint.dir``.

    On a cluster it has to be set, since executors must share it. Only a session
    of one process (``local[n]``) may do without: it gets a folder of its
    own, which goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="ledgerloom-"))
        atexit.register(shutil.rmtree, _OWN_FOLDER[0], ignore_errors=True)
    return _OWN_FOLDER[0]


def new_location(spark, name):
    """A path in the shared folder that nothing has used before; ``release`` removes it."""
    location = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(location)
    return location


def staged(df, name="stage", partition_by=()):
    """Write and re-read; the plan ends here and survives lost executors."""
    location = new_location(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


def staged_once(spark, key, build, name="shared"):
    """The result of ``build()``, written the first time an application asks for ``key``."""
    key = (spark.sparkContext.applicationId, key)
    if key not in _SHARED:
        df = build()
        location = new_location(spark, name)
        df.write.parquet(location)
        _SHARED[key] = location, df.schema
    location, schema = _SHARED[key]
    return spark.read.schema(schema).parquet(location)


def unstage(df):
    """Remove what ``staged`` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark):
    """Within, a query's shuffle files go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def release(spark):
    """Remove all that this application has staged; call it when its results have been written."""
    application = spark.sparkContext.applicationId
    for key in [k for k in _SHARED if k[0] == application]:
        del _SHARED[key]
    for location in _WRITTEN.pop(application, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
