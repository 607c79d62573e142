"""Constraint suites, frame validation and orphan checks."""

import operator
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StructType

from ledgerloom.functions.keys import _written_out
from ledgerloom.functions.text import _col
from ledgerloom.operators.joins import anti

PREDICATES = {
    "==": operator.eq, "!=": operator.ne, ">=": operator.ge, "<=": operator.le,
    ">": operator.gt, "<": operator.lt,
}


def suite_from_contract(contract):
    """Q1: the ``tests`` of a contract's columns as a list of checks."""
    suite = []
    for column in contract.columns:
        for test in column.get("tests", ()):
            check = {"check": test["check"], "column": column["name"]}
            if test.get("params"):
                key = "values" if test["check"] == "isContainedIn" else "predicate"
                check[key] = test["params"][0]
            suite.append(check)
    return suite


def _label(check):
    columns = check.get("columns") or [check["column"]] if check["check"] != "hasSize" else []
    return f"{check['check']}({','.join(columns)})"


def _measure(check):
    """The value of a check as one aggregate; shares are of all rows."""
    kind = check["check"]
    if kind == "hasSize":
        return F.count("*").cast("double")
    column = F.col(f"`{check['column']}`")
    share = lambda test: F.avg(F.when(test, 1.0).otherwise(0.0))
    if kind == "isComplete":
        return share(column.isNotNull())
    if kind == "isContainedIn":
        return share(column.isNull() | column.isin(*check["values"]))
    if kind == "isNonNegative":
        return share(column.isNull() | (column.try_cast("double") >= 0))
    if kind == "hasMin":
        return F.min(column).try_cast("double")
    if kind == "hasMax":
        return F.max(column).try_cast("double")
    raise ValueError(f"unknown check: {kind}")


def run_suite(df, suite):
    """Q1: one row per constraint with value and status.

    All aggregates share one pass over the frame, and all uniqueness checks one
    grouping of their keys (``_unique_shares``); the one-row results are unpivoted
    and put together by union. A check on an absent column fails.
    """
    present = set(df.columns)
    needs = lambda check: check.get("columns") or (
        [check["column"]] if "column" in check else []
    )
    single, unique = [], []
    for position, check in enumerate(suite):
        label = F.lit(_label(check)).alias("constraint")
        rule = check.get("predicate", ("==", 1.0))
        tagged = (position, label, rule)
        if not set(needs(check)) <= present:
            single.append((tagged, F.lit(None).cast("double")))
        elif check["check"] == "isUnique":
            unique.append((tagged, needs(check)))
        else:
            single.append((tagged, _measure(check)))
    measured = []
    if single:
        measured.append((df.agg(*[value.alias(f"v{i}") for i, (_, value) in enumerate(single)]), [t for t, _ in single]))
    if unique:
        measured.append((_unique_shares(df, [keys for _, keys in unique]), [t for t, _ in unique]))
    parts = [
        row.select(F.explode(F.array(*[_result(t, F.col(f"v{i}")) for i, t in enumerate(tags)])).alias("result"))
        for row, tags in measured
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows.select("result.*").orderBy("position").drop("position")


def _unique_shares(df, checks):
    """One row with v0, v1, ...: of each check's keys, the share of rows whose key occurs once.

    A row gives one cell per check, its number and its key written out with
    lengths, so the frame is read once however many checks there are, and
    keys are counted in every map task before they move. Rows whose keys are all null do not count.
    """
    fields = {f.name: f for f in df.schema.fields}
    cells = [
        F.when(
            reduce(operator.or_, [F.col(f"`{k}`").isNotNull() for k in keys]),
            F.struct(F.lit(i).alias("check"), F.concat_ws(";", *[_written_out(_key_text(fields[k])) for k in keys]).alias("key")),
        )
        for i, keys in enumerate(checks)
    ]
    counted = (
        df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.check", "cell.key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    shares = counted.groupBy("check").agg(
        F.try_divide(F.count(F.when(F.col("n") == 1, 1)), F.sum("n")).alias("share")
    )
    return shares.agg(*[F.max(F.when(F.col("check") == i, F.col("share"))).alias(f"v{i}") for i in range(len(checks))])


def _key_text(field):
    """A key as text, equal for equal values: both zeros of a float are one."""
    if isinstance(field.dataType, (DoubleType, FloatType)):
        return (F.col(f"`{field.name}`") + F.lit(0.0)).cast("string")
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return F.to_json(F.col(f"`{field.name}`"))
    return F.col(f"`{field.name}`").cast("string")


def _result(tagged, value):
    position, label, (symbol, expected) = tagged
    passes = F.coalesce(PREDICATES[symbol](value, F.lit(float(expected))), F.lit(False))
    return F.struct(
        F.lit(position).alias("position"),
        label,
        value.cast("double").alias("value"),
        F.lit(f"{symbol} {float(expected)}").alias("expected"),
        F.when(passes, "Success").otherwise("Failure").alias("constraint_status"),
    ).alias("result")


def summarise(results, by=()):
    """Total, successes and percent per run, zero-filled."""
    counts = (
        results.groupBy(*by).pivot("constraint_status", ["Success", "Failure"]).agg(F.count(F.lit(1)))
        if by
        else results.groupBy(F.lit(1).alias("__all"))
        .pivot("constraint_status", ["Success", "Failure"])
        .agg(F.count(F.lit(1)))
        .drop("__all")
    )
    success = F.coalesce(F.col("Success"), F.lit(0))
    total = success + F.coalesce(F.col("Failure"), F.lit(0))
    return counts.select(
        *by,
        total.alias("total"),
        success.alias("success"),
        F.round(success / total * 100, 2).alias("success_percent"),
    )


def validate_frame(df, contract):
    """Q4: one row per declared column: present, of its type, tests passed."""
    declared = contract.struct_type
    actual = {f.name.lower(): f for f in df.schema.fields}
    facts = [
        (
            field.name,
            field.name.lower() in actual,
            field.name.lower() in actual
            and actual[field.name.lower()].dataType.simpleString()
            == field.dataType.simpleString(),
        )
        for field in declared.fields
    ]
    shape = df.sparkSession.createDataFrame(
        facts, "column string, present boolean, type_matches boolean"
    )
    suite = [
        check
        for check in suite_from_contract(contract)
        if check["check"] in ("isComplete", "isUnique") and check["column"] in df.columns
    ]
    if not suite:
        return shape.withColumn("failed_tests", F.lit(0).cast("bigint"))
    failures = (
        run_suite(df, suite)
        .withColumn("column", F.regexp_extract("constraint", r"\((.*)\)", 1))
        .groupBy("column")
        .agg(F.count(F.when(F.col("constraint_status") == "Failure", 1)).alias("failed_tests"))
    )
    return shape.join(failures, "column", "left").withColumn(
        "failed_tests", F.coalesce("failed_tests", F.lit(0))
    )


def orphans(links, hub, link_key, hub_key):
    """Link rows whose key is not in the hub."""
    keyed = links.where(_col(link_key).isNotNull())
    return anti(
        keyed, hub.select(F.col(hub_key).alias(link_key)), [link_key], null_safe=False
    )
