"""Merges: no update is lost, one current row per key, doubled keys, added columns, partitions."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.contract import TableContract
from ledgerloom.operators import merge
from ledgerloom.sources import buckets, writers
from ledgerloom.sources.staging import new_location

SCHEMA = "id int, a string, b string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def columns(**kinds):
    return tuple({"name": name, "type": kind} for name, kind in kinds.items())


@pytest.mark.parametrize(
    "old,new", [((1, "x", None), (1, None, "x")), ((1, "x;y", None), (1, "x", "y")), ((1, "", None), (1, None, "")),
                ((1, None, "-"), (1, "-", None))],
)
def test_a_value_that_moves_is_a_change(spark, old, new):
    base = merge.upsert(None, frame(spark, [old]), ["id"])
    after = merge.upsert(base, frame(spark, [new]), ["id"])
    assert [tuple(r)[:3] for r in after.collect()] == [new]
    feed = merge.change_feed(frame(spark, [old]), frame(spark, [new]), ["id"], 3, committed="2024-01-01 00:00:00")
    assert {r["_change_type"] for r in feed.collect()} == {"update_preimage", "update_postimage"}
    upserts, deletes = merge.split_feed(feed)
    assert upserts.columns == ["id", "a", "b"] and upserts.count() == 1 and deletes.count() == 0


def test_a_base_row_without_hash_is_updated(spark):
    base = merge.upsert(None, frame(spark, [(1, "x", "y")]), ["id"]).withColumn("dv_hashdiff", F.lit(None).cast("string"))
    after = merge.upsert(base, frame(spark, [(1, "z", "y")]), ["id"])
    assert after.first()["a"] == "z"


def test_upsert_takes_in_an_added_column(spark):
    base = merge.upsert(None, frame(spark, [(1, "x", "y"), (2, "x", "y")]), ["id"])
    after = merge.upsert(base, frame(spark, [(1, "x", "y", 5)], SCHEMA + ", c int"), ["id"])
    assert sorted((r["id"], r["c"]) for r in after.collect()) == [(1, 5), (2, None)]


STATUS = TableContract("s", "", ["id"], columns(id="integer", a="string", b="string"))


def test_one_batch_leaves_one_current_row_per_key(spark):
    two = frame(spark, [(1, "x", "1"), (1, "y", "2"), (2, "z", "3")])
    state = merge.scd2(None, two, STATUS.struct_type, ["id"], "2024-01-01", order=[F.col("b").desc()])
    assert sorted((r["id"], r["a"]) for r in state.where("dv_status = 1").collect()) == [(1, "y"), (2, "z")]
    later = merge.scd2(state, two, STATUS.struct_type, ["id"], "2024-02-01", order=[F.col("b")])
    assert sorted((r["id"], r["a"]) for r in later.where("dv_status = 1").collect()) == [(1, "x"), (2, "z")]


def test_doubled_update_keys_do_not_multiply_rows(spark):
    base, updates = frame(spark, [(1, "x", "y")]), frame(spark, [(1, "u", "1"), (1, "v", "2")])
    got = merge.conditional_merge(
        base, updates, ["id"], [(F.lit(True), {"a": F.col("updates.a")})], order=[F.col("b").desc()]
    )
    assert [tuple(r) for r in got.collect()] == [(1, "v", "y")]


def test_a_column_declared_later_is_read_from_old_and_new_files(spark):
    location = new_location(spark, "added")
    old = TableContract("t", location, ["id"], columns(id="integer", a="string"))
    new = TableContract("t", location, ["id"], columns(id="integer", a="string", b="string"))
    writers.append(spark.createDataFrame([(1, "x")], "id int, a string"), old)
    writers.append(frame(spark, [(2, "x", "y")]), new)
    assert sorted(tuple(r) for r in writers.table_state(spark, new).collect()) == [(1, "x", None), (2, "x", "y")]


def test_merge_write_replaces_only_reached_partitions(spark):
    location = new_location(spark, "merged")
    contract = TableContract(
        "t", location, ["id"], columns(id="integer", a="string", dv_hashdiff="string", b="string"), ["b"]
    )
    step = lambda base, updates: merge.upsert(base, updates, ["id", "b"])
    first = frame(spark, [(1, "x", "p"), (2, "x", "p"), (3, "x", "q")])
    feed = writers.merge_write(spark, contract, first, ["id", "b"], step, 1)
    assert {r["_change_type"] for r in feed.collect()} == {"insert"} and feed.count() == 3
    kept = {f for f in spark.read.parquet(location).inputFiles() if "b=q" in f}
    feed = writers.merge_write(spark, contract, frame(spark, [(1, "y", "p"), (4, "n", "p")]), ["id", "b"], step, 2)
    assert sorted((r["id"], r["_change_type"]) for r in feed.collect()) == [
        (1, "update_postimage"), (1, "update_preimage"), (4, "insert"),
    ]
    assert {f for f in spark.read.parquet(location).inputFiles() if "b=q" in f} == kept
    assert sorted((r["id"], r["a"]) for r in writers.table_state(spark, contract).collect()) == [
        (1, "y"), (2, "x"), (3, "x"), (4, "n"),
    ]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


UPSERTS = [
    (1, "x", "p", "2024-01-01"), (2, "x", "p", "2024-01-01"), (3, None, "q", "2024-01-01"), (None, "n", "q", "2024-01-01"),
    (5, "e", "q", None),
]
STAMPED = SCHEMA + ", created_at string"


def fed(feed):
    return sorted(((r["_change_type"], r["id"], r["a"], r["b"], r["created_at"]) for r in feed.collect()), key=repr)


@pytest.mark.parametrize("updates", [
    [], UPSERTS, [(1, "y", "p", "2024-02-02"), (2, "x", "p", "2024-02-02"), (4, "z", "q", "2024-02-02"), (None, None, "q", "2024-02-02")],
    [(1, "y", "p", "2024-02-02"), (1, "y", "p", "2024-02-02"), (3, "", "q", "2024-02-02")],
])
def test_feed_of_an_upsert_equals_the_difference_of_its_states(spark, updates):
    base = merge.upsert(None, frame(spark, UPSERTS, STAMPED), ["id"])
    changes = merge.upsert_changes(base, frame(spark, updates, STAMPED), ["id"])
    state = changes.state()
    diff = merge.change_feed(base, state, ["id"], 2, committed="2024-02-02 00:00:00")
    feed = changes.feed(2, "2024-02-02 00:00:00")
    assert sorted(feed.columns) == sorted(diff.columns)
    assert fed(feed) == fed(diff)
    assert {r["_commit_version"] for r in feed.collect()} <= {2}
    for df in (state, feed, changes.kept):
        assert "FullOuter" not in plan_of(df)


def test_feed_of_versions_equals_the_difference_of_their_states(spark):
    """Closing a version is a change too, though its payload stays."""
    first = frame(spark, [(1, "x", "1"), (2, "z", "3"), (3, "k", "k")])
    state = merge.scd2(None, first, STATUS.struct_type, ["id"], "2024-01-01")
    names = ["id", "a", "dv_valid_from", "dv_valid_to", "dv_status"]
    for day, rows in (("2024-02-01", [(1, "y", "2"), (2, "z", "3"), (4, "n", "n")]), ("2024-03-01", [(1, "x", "1"), (1, "x", "1")])):
        changes = merge.scd2_changes(state, frame(spark, rows), STATUS.struct_type, ["id"], day)
        after = changes.state()
        old, new = ({(r["id"], r["dv_valid_from"]): tuple(r) for r in df.select(*names).collect()} for df in (state, after))
        want = [("insert", new[k]) for k in new.keys() - old.keys()]
        want += [(kind, side[k]) for k in new.keys() & old.keys() if old[k] != new[k]
                 for kind, side in (("update_preimage", old), ("update_postimage", new))]
        got = [(r["_change_type"], tuple(r[n] for n in names)) for r in changes.feed(1).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) >= 3
        assert "FullOuter" not in plan_of(after)
        state = after
    assert sorted((r["id"], r["a"]) for r in state.where("dv_status = 1").collect()) == [(1, "x"), (2, "z"), (3, "k"), (4, "n")]


def test_only_keys_and_hashes_of_the_base_meet_the_updates(spark):
    location = new_location(spark, "wide")
    merge.upsert(None, frame(spark, UPSERTS, STAMPED), ["id"]).write.parquet(location)
    base = spark.read.parquet(location)
    changes = merge.upsert_changes(base, frame(spark, [(1, "y", "p", "d")], STAMPED), ["id"])
    assert "FullOuter" not in plan_of(changes.state())
    assert changes.inserts.isEmpty() and changes.before.count() == changes.after.count() == 1


def test_merge_write_with_changes_rewrites_what_changes(spark):
    location = new_location(spark, "changed")
    contract = TableContract(
        "t", location, ["id"], columns(id="integer", a="string", dv_hashdiff="string", b="string"), ["b"]
    )
    step = lambda base, updates: merge.upsert_changes(base, updates, ["id", "b"])
    first = frame(spark, [(1, "x", "p"), (2, "x", "p"), (3, "x", "q")])
    assert writers.merge_write(spark, contract, first, ["id", "b"], step, 1).count() == 3
    files = lambda part="": {f for f in spark.read.parquet(location).inputFiles() if part in f}
    all_files = files()
    assert writers.merge_write(spark, contract, first, ["id", "b"], step, 2).count() == 0
    assert files() == all_files  # nothing changed, nothing was written
    kept = files("b=q")
    feed = writers.merge_write(
        spark, contract, frame(spark, [(1, "y", "p"), (4, "n", "p"), (3, "x", "q")]), ["id", "b"], step, 3
    )
    assert sorted((r["id"], r["_change_type"]) for r in feed.collect()) == [
        (1, "update_postimage"), (1, "update_preimage"), (4, "insert"),
    ]
    assert files("b=q") == kept
    assert sorted((r["id"], r["a"]) for r in writers.table_state(spark, contract).collect()) == [
        (1, "y"), (2, "x"), (3, "x"), (4, "n"),
    ]


def test_a_table_is_not_replaced_by_itself(spark):
    location = new_location(spark, "itself")
    contract = TableContract("t", location, ["id"], columns(id="integer", a="string"))
    writers.append(spark.createDataFrame([(1, "x")], "id int, a string"), contract)
    with pytest.raises(ValueError, match="stage it first"):
        writers.replace_all(writers.table_state(spark, contract).where("id > 0"), contract)
    assert writers.table_state(spark, contract).count() == 1


# --- buckets ------------------------------------------------------------------------------------


HUB = dict(hk="string", name="string")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_are_merged_and_joined_without_moving_them(spark, no_broadcast):
    hub = TableContract("h", new_location(spark, "h"), ["hk"], columns(**HUB))
    facts = TableContract("s", new_location(spark, "s"), ["hk"], columns(hk="string", a="string", dv_hashdiff="string"))
    rows = spark.range(500).selectExpr("md5(cast(id as string)) as hk", "concat('n', id) as name")
    buckets.append_bucketed(rows, hub, ["hk"], 8)
    load = spark.range(400, 600).selectExpr("md5(cast(id as string)) as hk", "concat('n', id) as name")
    fresh = buckets.merge_hub(spark, hub, load, ["hk"], 8)
    assert physical(fresh).count("Exchange hashpartitioning") == 1 and fresh.count() == 100  # the load alone moves
    buckets.append_bucketed(fresh, hub, ["hk"], 8)
    assert buckets.bucketed(spark, hub, ["hk"], 8).count() == 600
    assert buckets.merge_hub(spark, hub, load, ["hk"], 8).count() == 0

    values = load.selectExpr("hk", "substring(hk, 1, 2) as a")
    for want in (200, 0):
        fresh = buckets.merge_satellite(spark, facts, values, "hk", 8)
        assert fresh.count() == want
        buckets.append_bucketed(fresh, facts, ["hk"], 8)
    joined = buckets.bucketed(spark, hub, ["hk"], 8).join(buckets.bucketed(spark, facts, ["hk"], 8), "hk")
    assert "Exchange hashpartitioning" not in physical(joined) and joined.count() == 200


def test_null_keys_are_refused_by_buckets(spark):
    hub = TableContract("h", new_location(spark, "h"), ["hk"], columns(**HUB))
    with pytest.raises(Exception, match="a key is null"):
        buckets.append_bucketed(spark.createDataFrame([(None, "x")], "hk string, name string"), hub, ["hk"], 4)
    with pytest.raises(ValueError, match="not by both"):
        buckets.bucketed(spark, TableContract("h", "/tmp/x", ["hk"], columns(**HUB), ["name"]), ["hk"], 4)
