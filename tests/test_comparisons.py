"""Uniqueness in one grouping, frames compared by checksums, running totals and ingest of new files."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import batch, profile, quality, sketches
from ledgerloom.sources.ingest import ingest_new, stamped
from ledgerloom.sources.staging import new_location


def as_text(df, *columns):
    return sorted(repr(tuple(r)) for r in (df.select(*columns) if columns else df).collect())


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# --- Q1 -----------------------------------------------------------------------------------------


def unique(*columns):
    return {"check": "isUnique", "columns": list(columns)} if len(columns) > 1 else {"check": "isUnique", "column": columns[0]}


def test_uniqueness_of_many_keys_in_one_grouping(spark):
    generator = random.Random(4)
    pick = lambda *values: generator.choice(values)
    data = [(i, pick(None, "a", "a;1:b", "b"), pick(None, 1, 2, 3), pick(0.0, -0.0, 1.5, float("nan"), None), pick([1], [1, 2], None)) for i in range(60)]
    df = spark.createDataFrame(data, "id int, s string, n int, x double, l array<int>")
    checks = [("id",), ("s",), ("s", "n"), ("n", "s", "x"), ("x",), ("l",), ("id", "x")]
    got = quality.run_suite(df, [unique(*c) for c in checks])
    values = [r["value"] for r in got.collect()]
    for keys, value in zip(checks, values):
        groups = df.where(F.coalesce(*[F.col(k).isNotNull().cast("string") for k in keys]).isNotNull())
        groups = df.where(" or ".join(f"{k} is not null" for k in keys)).groupBy(*keys).count()
        want = groups.agg(F.count(F.when(F.col("count") == 1, 1)) / F.sum("count")).first()[0]
        assert value == pytest.approx(want), keys
    folder = new_location(spark, "suite")
    df.write.parquet(folder)
    suite = [unique(*c) for c in checks] + [{"check": "isComplete", "column": "s"}]
    plan = plan_of(quality.run_suite(spark.read.parquet(folder), suite))
    assert plan.count("Relation [") == 2  # one scan for all uniqueness checks, one for all else
    nothing = quality.run_suite(df.limit(0), [unique("id"), unique("gone")]).collect()
    assert [(r["value"], r["constraint_status"]) for r in nothing] == [(None, "Failure")] * 2


# --- Q9 -----------------------------------------------------------------------------------------


def two_frames(spark, changed):
    generator = random.Random(6)
    pick = lambda *values: generator.choice(values)
    rows = {i: (i, i % 5, pick("a", "b", None), pick(1.5, -0.0, None)) for i in range(500)}
    other = dict(rows)
    for i in generator.sample(range(500), changed):
        kind = generator.randrange(4)
        if kind == 0:
            del other[i]
        elif kind == 1:
            other[1000 + i] = (1000 + i, 0, "new", None)
        else:
            other[i] = (i, i % 5, pick("a", "c", None), pick(0.0, None))
    schema = "id int, j int, s string, x double"
    left = spark.createDataFrame([*rows.values(), (None, 1, "n", 1.0)], schema).withColumn("mine", F.lit(1))
    right = spark.createDataFrame([*other.values(), (None, 1, "n", 1.0)], schema).withColumn("theirs", F.lit(1))
    return left, right


@pytest.mark.parametrize("changed", [0, 7, 200])
@pytest.mark.parametrize("keys", [["id"], ["id", "j"]])
def test_buckets_give_the_figures_of_the_whole_comparison(spark, changed, keys):
    left, right = two_frames(spark, changed)
    got = profile.compare_buckets(left, right, keys, 64)
    assert as_text(got) == as_text(profile.compare(left, right, keys))
    assert as_text(profile.compare_buckets(left.limit(0), right, keys, 64)) == as_text(profile.compare(left.limit(0), right, keys))


def test_equal_buckets_are_not_joined(spark, monkeypatch):
    moved = []
    whole = profile.compare
    monkeypatch.setattr(profile, "compare", lambda a, b, keys: moved.append((a.count(), b.count())) or whole(a, b, keys))
    left, right = two_frames(spark, 3)
    profile.compare_buckets(left, right, ["id"], 256).collect()
    assert max(moved[0]) < 40  # a few rows of a few buckets, of 500


# --- W6 -----------------------------------------------------------------------------------------


def test_running_totals_without_a_window_over_all(spark):
    counts = spark.range(400).selectExpr("id as k", "pmod(hash(id), 17) + 1 as cnt").withColumn("cnt", F.col("cnt").cast("long"))
    got = batch.running_total(counts)
    rows = {r["k"]: r["cnt"] for r in counts.collect()}
    for r in got.collect():
        assert r["running_sum"] == sum(n for n in rows.values() if n <= r["cnt"])
    assert "Window" not in plan_of(got.select("k", "cnt")) and got.count() == 400
    assert batch.running_total(counts.limit(0)).count() == 0


# --- ingest -------------------------------------------------------------------------------------


def test_files_are_taken_once(spark):
    source, target, log = (new_location(spark, name) for name in ("in", "out", "log"))
    part = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "id % 3 as k").coalesce(1).write.mode("append")
    take = lambda **more: ingest_new(spark, source, target, log, "id long, k long", **more)
    part(0, 50).parquet(source)
    assert take() == 50 and take() == 0
    part(50, 80).parquet(source)
    part(80, 90).parquet(source)
    assert take(files_per_batch=1) == 40 and take() == 0
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(90))


def test_a_run_that_was_broken_is_repeated_without_doubling(spark):
    source, target, log = (new_location(spark, name) for name in ("in", "out", "log"))
    spark.range(20).write.parquet(source)

    def broken(df):
        return df.withColumn("id", F.when(F.col("id") == 13, F.raise_error("lost").cast("long")).otherwise(F.col("id")))

    with pytest.raises(Exception, match="lost"):
        ingest_new(spark, source, target, log, "id long", transform=broken)
    assert ingest_new(spark, source, target, log, "id long") == 20
    assert spark.read.parquet(target).count() == 20


def test_ingest_of_text_formats(spark):
    source, target, log = (new_location(spark, name) for name in ("in", "out", "log"))
    spark.createDataFrame([("a", 1), ("b", None)], "s string, n int").coalesce(1).write.option("header", True).csv(source)
    taken = ingest_new(spark, source, target, log, "s string, n int", "csv", stamped("v1"), ["dv_source_version"], header=True)
    got = spark.read.parquet(target)
    assert taken == 2 and as_text(got, "s", "n", "dv_source_version") == ["('a', 1, 'v1')", "('b', None, 'v1')"]
    assert all(r["dv_file"].endswith(".csv") for r in got.collect())
    with pytest.raises(ValueError, match="no file format"):
        ingest_new(spark, source, target, log, "s string", "jdbc")


# --- Q7 -----------------------------------------------------------------------------------------


def test_profiles_of_loads_merge_into_that_of_their_union(spark):
    generator = random.Random(12)
    rows = [(i, generator.choice([None, generator.gauss(0, 50)]), generator.choice(["a"] * 5 + ["b", "c", None])) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, x double, s string")
    loads = [sketches.profile_state(df.where(f"id % 4 = {i}")) for i in range(4)]
    loads.append(sketches.profile_state(df.limit(0)))  # an empty load changes nothing
    states = loads[0]
    for more in loads[1:]:
        states = states.unionByName(more)
    got = {r["column"]: r for r in sketches.profile_of(sketches.merge_states(states), (0.1, 0.5, 0.9), 3).collect()}
    values = {"id": [r[0] for r in rows], "x": [r[1] for r in rows], "s": [r[2] for r in rows]}
    for name, own in values.items():
        known = [v for v in own if v is not None]
        r = got[name]
        assert (r["rows"], r["nulls"]) == (6000, 6000 - len(known))
        assert abs(r["distinct_values"] - len(set(known))) <= max(1, sketches.DISTINCT_ERROR * len(set(known)))
        if name == "s":
            assert r["least"] is None and r["quantiles"] is None
            assert {(t["item"], t["count"]) for t in r["top"] if t["item"] is not None} >= {("a", own.count("a"))}
        else:
            assert (r["least"], r["most"]) == (min(known), max(known))
            for share, q in zip((0.1, 0.5, 0.9), r["quantiles"]):
                assert abs(sum(v <= q for v in known) / len(known) - share) <= sketches.RANK_ERROR
