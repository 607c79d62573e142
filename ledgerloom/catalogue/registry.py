"""Registry of queries and their SQL."""

import functools

from ledgerloom.sources.staging import staged_once

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under a name, with its SQL."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def built_once(build):
    """A table ``build(spark, sf_dir)`` that all queries of an application share, written at its first use."""

    @functools.wraps(build)
    def once(spark, sf_dir):
        return staged_once(spark, (build.__name__, sf_dir.rstrip("/")), lambda: build(spark, sf_dir), build.__name__)

    return once


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
