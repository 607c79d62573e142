"""Source and target figures side by side (Q5, Q6)."""

from functools import reduce

from pyspark.sql import functions as F


def _figures(frame, value):
    """A one-row frame as (metric, value) rows."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(f"`{name}`").cast("double").alias(value))
        for name in frame.columns
    ]
    return frame.select(F.explode(F.array(*pairs)).alias("f")).select("f.*")


def reconcile_pair(spark, name, source_sql, target_sql):
    """Q5: per figure of both queries its values, difference and status.

    Figures are matched by column name; one that only a side has fails.
    """
    source = _figures(spark.sql(source_sql), "source_value")
    target = _figures(spark.sql(target_sql), "target_value")
    return source.join(target, "metric", "full_outer").select(
        F.lit(name).alias("test"),
        "metric",
        "source_value",
        "target_value",
        (F.col("target_value") - F.col("source_value")).alias("diff"),
        F.coalesce(F.col("source_value") == F.col("target_value"), F.lit(False)).alias("status"),
    )


def reconcile_suite(spark, suite):
    """Q6: all pairs. A pair that cannot be planned gives one failed row."""
    parts = []
    for item in suite:
        try:
            parts.append(
                reconcile_pair(spark, item["name"], item["source_sql"], item["target_sql"])
            )
        except Exception as problem:  # analysis errors of user-written SQL
            parts.append(
                spark.createDataFrame(
                    [(item["name"], f"error: {type(problem).__name__}", None, None, None, False)],
                    "test string, metric string, source_value double, target_value double, "
                    "diff double, status boolean",
                )
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


def reconcile_summary(results):
    """Q6: tests, successes, percent and overall status."""
    per_test = results.groupBy("test").agg(F.bool_and("status").alias("status"))
    passed = F.count(F.when(F.col("status"), 1))
    return per_test.agg(
        F.bool_and("status").alias("status"),
        F.count("*").alias("total_test"),
        passed.alias("success"),
        F.round(passed / F.count("*") * 100, 2).alias("success_percent"),
    )
