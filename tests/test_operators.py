import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.contract import SourceSpec, TableContract, load_contract, merge_contracts
from ledgerloom.operators import batch, dedupe, joins, lookups, merge, nesting, quality, similarity
from ledgerloom.operators.history import versions_at
from ledgerloom.operators.similarity import levenshtein_match, similar_names
from ledgerloom.plans import golden
from ledgerloom.sources import readers, writers
from ledgerloom.sources.staging import new_location, staged


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def as_text(df, *columns):
    """Rows with nulls and arrays, in an order."""
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


# --- one row per key ----------------------------------------------------------------------------


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    kept = dedupe.first_per_key(df, ["k"], [F.col("v").desc()])
    assert rows(kept) == [(0, 999), (1, 997), (2, 998)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_ties_are_settled_by_all_columns(spark):
    data = [("k", 1, "b"), ("k", 1, "a"), ("k", 1, None)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, n int, s string").repartition(3)
        assert rows(dedupe.first_per_key(df, ["k"], [F.col("n").asc()])) == [("k", 1, "a")]


def test_consolidate_with_maps_nulls_and_a_hot_key(spark):
    rows = [("hot", i, [f"t{i % 3}", None], {"a": i}, i == 7) for i in range(3000)]
    rows += [(None, 1, None, None, None), ("none", 2, None, {"b": 1}, False)]
    df = spark.createDataFrame(rows, "k string, n int, tags array<string>, m map<string, int>, flag boolean")
    got = {r["k"]: r for r in dedupe.consolidate(df.repartition(6), ["k"], [F.col("n")]).collect()}
    assert set(got) == {"hot", None, "none"}
    assert tuple(got["hot"])[1:] == (0, ["t0", "t1", "t2", None], {"a": 0}, True)
    assert got[None]["tags"] == [] and got[None]["m"] is None and got["none"]["m"] == {"b": 1}


def test_consolidate_by_type(spark):
    df = spark.createDataFrame(
        [("k", 1, None, ["a"], False), ("k", 2, "x", ["b", "a"], True), ("k", 3, "y", None, None)],
        "k string, n int, s string, a array<string>, b boolean",
    )
    got = dedupe.consolidate(df, ["k"], [F.col("n")]).first()
    assert tuple(got) == ("k", 1, "x", ["a", "b"], True)


def test_completeness_outweighs_order(spark):
    df = spark.createDataFrame([("k", None, "z", 1), ("k", "a", None, 2)], "k string, a string, b string, n int")
    assert dedupe.most_complete_per_key(df, ["k"], ["a", "b"], [F.col("n").asc()]).first()["n"] == 2


# --- nesting ------------------------------------------------------------------------------------


def test_parts_share_the_rows_of_a_key_without_loss(spark):
    rows = [("hot", i % 700) for i in range(5000)] + [("same", 1)] * 1000 + [("one", 7), (None, 8)]
    df = spark.createDataFrame(rows, "k string, v int")
    for parts in (1, 8):
        spine = df.select("k").distinct()
        nested = nesting.nest(df, ["k"], ["v"], "items", parts)
        got = nesting.attach_nested(spine.where("k is not null"), ["k"], [nested], parts)
        assert got.count() == got.select("k", "part").distinct().count() == 3 * parts
        seen = got.select("k", F.explode("items").alias("x")).select("k", "x.v").groupBy("k", "v").count()
        want = df.where("k is not null").groupBy("k", "v").count()
        assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, want.collect()))
        sizes = [len(r["items"] or []) for r in got.where("k = 'same'").collect()]
        assert max(sizes) - min(sizes) <= 1


def test_documents_in_parts_go_through_merge_and_edges(spark):
    from ledgerloom.plans import marts

    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "id string, v int")
    spine = spark.createDataFrame(
        [("a", "A", "J", "EU"), ("b", "B", "J", "EU")], "id string, name string, jurisdiction string, continent string"
    )
    documents = nesting.attach_nested(spine, ["id"], [nesting.nest(df, ["id"], ["v"], "x", 4)], 4)
    stored = merge.insert_only(None, documents, marts.DOCUMENT_KEY)
    assert stored.count() == 8
    assert stored.agg(F.sum(F.coalesce(F.size("x"), F.lit(0)))).first()[0] == 51
    links = spark.createDataFrame(
        [("e", "a", "J", "b", "J")],
        "id string, from_entity_id string, from_jurisdiction string, to_entity_id string, to_jurisdiction string",
    )
    assert marts.entity_edges(links, stored, stored).count() == 1


# --- merges -------------------------------------------------------------------------------------


def test_insert_only_is_idempotent_with_null_keys(spark):
    base = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    batch_rows = spark.createDataFrame([("a", 9), (None, 9), ("b", 3), ("b", 3)], "k string, v int")
    once = merge.insert_only(base, batch_rows, ["k"])
    assert rows(once.where("k is not null")) == [("a", 1), ("b", 3)]
    assert once.count() == 3
    assert merge.new_rows(once, batch_rows, ["k"]).count() == 0
    assert merge.new_rows(base, batch_rows, ["k"], null_safe=False).count() == 2


def test_upsert_twice_changes_nothing(spark):
    first = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1")], "id int, v string, created_at string")
    second = spark.createDataFrame([(1, "a", "d2"), (2, "c", "d2"), (3, "e", "d2")], "id int, v string, created_at string")
    state = merge.upsert(merge.upsert(None, first, ["id"]), second, ["id"])
    want = [(1, "a", "d1"), (2, "c", "d1"), (3, "e", "d2")]
    assert rows(state, "id", "v", "created_at") == want
    assert rows(merge.upsert(state, second, ["id"]), "id", "v", "created_at") == want


HISTORY = TableContract(
    name="h", location="", unique_key="k",
    columns=tuple({"name": n, "type": t} for n, t in [
        ("k", "string"), ("v", "string"), ("dv_status", "integer"), ("dv_valid_from", "date"),
        ("dv_valid_to", "date"),
    ]),
)


def scd(spark, state, value, day, reopen=True):
    frame = spark.createDataFrame([("k", value)], "k string, v string")
    return merge.scd2(state, frame, HISTORY.struct_type, ["k"], day, reopen)


def test_history_returns_to_an_old_value(spark):
    state = scd(spark, None, "A", "2024-01-01")
    state = scd(spark, state, "B", "2024-02-01")
    again = scd(spark, state, "A", "2024-03-01")
    day = datetime.date
    assert rows(again, "v", "dv_status", "dv_valid_from", F.coalesce("dv_valid_to", F.lit(day(9999, 1, 1)))) == [
        ("A", 0, day(2024, 1, 1), day(2024, 1, 31)),
        ("A", 1, day(2024, 3, 1), day(9999, 1, 1)),
        ("B", 0, day(2024, 2, 1), day(2024, 2, 29)),
    ]
    assert scd(spark, again, "A", "2024-04-01").count() == 3
    assert scd(spark, state, "A", "2024-03-01", reopen=False).count() == 2
    for moment, value in (("2024-01-31", "A"), ("2024-02-29", "B"), ("2024-03-01", "A")):
        assert rows(merge.valid_at(again, moment), "v") == [(value,)]


def test_satellite_keeps_equal_attributes_of_two_parents(spark):
    schema = TableContract(name="s", location="", columns=(
        {"name": "dv_hub", "type": "string"}, {"name": "v", "type": "string"},
    )).struct_type
    df = spark.createDataFrame([("h1", "x"), ("h2", "x"), ("h1", "x")], "dv_hub string, v string")
    state = merge.satellite(None, df, schema, ["dv_hashdiff"], parent="dv_hub")
    assert state.count() == 2
    assert merge.satellite(state, df, schema, ["dv_hashdiff"], parent="dv_hub").count() == 2


def test_conditional_merge_takes_the_first_clause(spark):
    base = spark.createDataFrame([(1, "a", "a"), (2, "b", "a"), (3, "c", "d")], "id int, s string, b string")
    updates = spark.createDataFrame([(1, "a", "z"), (2, "a", "z")], "id int, k string, v string")
    key, value = F.col("updates.k"), F.col("updates.v")
    got = merge.conditional_merge(
        base, updates, ["id"],
        [(key == F.col("base.s"), {"s": value}), (key == F.col("base.b"), {"b": value})],
    )
    assert rows(got) == [(1, "z", "a"), (2, "b", "z"), (3, "c", "d")]


def test_feed_rebuilds_the_new_state(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "x"), (4, "n")], "id int, v string")
    feed = merge.change_feed(before, after, ["id"], 5)
    assert feed.count() == 4
    upserts, deletes = merge.split_feed(feed)
    rebuilt = merge.delete_keys(before, upserts.union(deletes), ["id"]).union(upserts)
    assert rows(rebuilt) == rows(after)
    assert all(f.count() == 0 for f in merge.split_feed(feed, after_version=5))


def test_delete_keeps_rows_with_unknown_predicate(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "n int")
    assert merge.delete_where(df, "n > 3").count() == 2


# --- matching -----------------------------------------------------------------------------------


MATCH_SCHEMA = (
    "dv_recsrc string, dv_source_version string, dv_hashkey_company string, name string, "
    "jurisdiction string, pure_name string, regexed_name string, registration_number string"
)


def harbour_rows(spark):
    """Two jurisdictions with the same names, a tie, names and jurisdictions that are null."""
    rows = []

    def add(key, name, jurisdiction, regexed, number):
        rows.append(("src", "v7", key, name, jurisdiction, (name or "").lower() or None, regexed, number))

    # BE: five rows of one number, two of them by the same name, and a second number
    for key, name in zip("abcde", ["Port Repair SA", "Port Repair NV", "Port Repair", "Port Repair NV", "Port, Repair"]):
        add(f"be-{key}", name, "BE", "port repair", "77")
    add("be-f", "Port Repair BV", "BE", "port repair", "78")
    # FR: the same name and number elsewhere is another company
    add("fr-a", "Port Repair SA", "FR", "port repair", "77")
    # without number: three in BE that a registered one has the name of, two in NL without such
    for key, name in zip("xyz", ["Port Repair Co", "Port Repair Sarl", "PORT REPAIR"]):
        add(f"be-{key}", name, "BE", "port repair", None)
    add("nl-a", "Quay Cranes", "NL", "quay cranes", None)
    add("nl-b", "Quay Cranes BV", "NL", "quay cranes", None)
    # nothing to match by
    add("no-name", None, "NL", None, None)
    add("nowhere", "Quay Cranes", None, "quay cranes", None)
    add("no-name-1", None, "BE", None, "79")
    return spark.createDataFrame(rows, MATCH_SCHEMA)


def by_key(frame):
    return {r["dv_hashkey_company"]: r for r in frame.collect()}


def test_registered_rows_match_within_number_and_jurisdiction(spark):
    from ledgerloom.operators import resolve

    got = by_key(resolve.match_registered(harbour_rows(spark).where("registration_number is not null")))
    assert set(got) == {"be-a", "be-b", "be-c", "be-d", "be-e", "be-f", "fr-a"}  # no name: no row
    winners = {got[f"be-{k}"]["verified_dv_hashkey_company"] for k in "abcde"}
    assert len(winners) == 1
    winner = got[winners.pop()]
    for k in "abcde":
        row = got[f"be-{k}"]
        assert row["verify_method"] == (None if row["name"] == winner["name"] else resolve.HAS_HAS)
    for alone in ("be-f", "fr-a"):
        assert got[alone]["verified_dv_hashkey_company"] == alone and got[alone]["verify_method"] is None


def test_unregistered_rows_all_stay(spark):
    from ledgerloom.operators import resolve

    got = by_key(resolve.match_unregistered(harbour_rows(spark).where("registration_number is null")))
    assert set(got) == {"be-x", "be-y", "be-z", "nl-a", "nl-b", "no-name", "nowhere"}
    assert sum(got[f"be-{k}"]["verify_method"] == resolve.NO_NO for k in "xyz") == 2
    assert sum(got[f"nl-{k}"]["verify_method"] == resolve.NO_NO for k in "ab") == 1
    for unmatched in ("no-name", "nowhere"):
        assert got[unmatched]["verify_method"] is None
        assert got[unmatched]["verified_dv_hashkey_company"] is None


def test_flow_sends_unregistered_groups_to_a_registered_winner(spark):
    from ledgerloom.operators import resolve

    df = harbour_rows(spark)
    flow = resolve.match_by_name(df)
    got = by_key(flow)
    assert flow.count() == len(got) == 14
    targets = {got[f"be-{k}"]["verified_dv_hashkey_company"] for k in "xyz"}
    assert len(targets) == 1 and targets.pop() in {f"be-{k}" for k in "abcdef"}
    assert {got[f"be-{k}"]["verify_method"] for k in "xyz"} == {resolve.CROSS}
    assert {got[f"nl-{k}"]["verify_method"] for k in "ab"} == {None, resolve.NO_NO}
    assert sorted(map(tuple, resolve.match_by_name(df.repartition(5)).collect()), key=repr) == sorted(
        map(tuple, flow.collect()), key=repr
    )
    assert resolve.match_by_name(df.limit(0)).count() == 0


def mutated(generator, text):
    letters = list(text)
    for _ in range(generator.choice([0, 1, 1, 2, 3, 5])):
        kind, place = generator.choice("ids"), generator.randrange(len(letters) + 1)
        if kind == "i":
            letters.insert(place, generator.choice("abc é"))
        elif place < len(letters):
            letters[place:place + 1] = [] if kind == "d" else [generator.choice("abc é")]
    return "".join(letters)


@pytest.mark.parametrize(
    "threshold,first,lengths,spaces", [(95, 6, 3, 3), (90, 2, 3, 3), (60, 0, 3, 3), (70, 3, 0, 9), (100, 1, 1, 1), (80, 0, 2, 9)]
)
def test_similar_names_equal_brute_force(spark, threshold, first, lengths, spaces):
    generator = random.Random(7)
    stems = [
        "".join(generator.choice("abc é") for _ in range(generator.choice([0, 1, 3, 6, 9, 20, 33, 47])))
        for _ in range(25)
    ]
    data = {(f"J{i % 2}", mutated(generator, generator.choice(stems))) for i in range(500)}
    names = spark.createDataFrame(sorted(data), "jurisdiction string, pure_name string")
    t, m = names.where("crc32(pure_name) % 2 = 0"), names.where("crc32(pure_name) % 2 = 1")
    got = similar_names(t, m, "pure_name", threshold, first, lengths, spaces)
    want = (
        t.alias("t").join(
            m.alias("m"),
            F.expr(
                f"t.jurisdiction = m.jurisdiction and "
                f"substring(t.pure_name, 1, {first}) = substring(m.pure_name, 1, {first}) and "
                f"abs(length(t.pure_name) - length(m.pure_name)) <= {lengths} and "
                f"abs(size(split(t.pure_name, ' ')) - size(split(m.pure_name, ' '))) <= {spaces}"
            ),
        )
        .selectExpr(
            "t.jurisdiction as j", "t.pure_name as a", "m.pure_name as b",
            "levenshtein(t.pure_name, m.pure_name) as d",
            "greatest(length(t.pure_name), length(m.pure_name)) as n",
        )
        .where(f"n > 0 and (1 - d / n) * 100 >= {threshold}")
    )
    assert rows(got, "jurisdiction", "name_text", "verified_text", "distance") == rows(want, "j", "a", "b", "d")


def test_similarity_of_mixed_case_names(spark):
    df = spark.createDataFrame(
        [("NO", "t", "Fishery north", None), ("NO", "m", "fishery nortH", "R")],
        "jurisdiction string, dv_hashkey_company string, name string, registration_number string",
    ).withColumns({"dv_recsrc": F.lit("s"), "dv_source_version": F.lit("v")})
    t, m = df.where("registration_number is null"), df.where("registration_number is not null")
    got = levenshtein_match(t, m, base="name", threshold=80)
    assert rows(got, "dv_hashkey_company", "verified_dv_hashkey_company", "distance") == [("t", "m", 2)]


def test_copies_of_a_name_do_not_multiply_pairs(spark):
    many = spark.range(2000).selectExpr(
        "'NO' as jurisdiction", "concat('t', id) as dv_hashkey_company", "'acme trading' as name",
        "'acme trading' as pure_name", "cast(null as string) as registration_number",
        "'s' as dv_recsrc", "'v' as dv_source_version",
    )
    trusted = many.withColumn("registration_number", F.lit("R"))
    assert similar_names(many, trusted).count() == 1
    assert levenshtein_match(many, trusted).count() == 2000


def tailed(spark, n, tail, seed):
    """Names of one block that end alike; each has a near twin."""
    generator = random.Random(seed)
    names = set()
    for _ in range(n // 2):
        own = "".join(generator.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(24))
        names |= {f"global {own}{tail}", f"global {own[:10]}z{own[11:]}{tail}"}
    return spark.createDataFrame([("NO", name) for name in sorted(names)], "jurisdiction string, pure_name string")


@pytest.mark.parametrize("threshold, share", [(95, 0.01), (90, 0.1)])
def test_names_with_a_common_tail_make_few_candidates(spark, threshold, share):
    """The tail brings no names together, only what is their own, and no match is lost."""
    limits = dict(threshold=threshold, length_diff=3, stripped=6)
    for n in (300, 1200):
        names = tailed(spark, n, " international trading holding limited", n)
        own = similarity._distinct_names(names, "pure_name", 6, True)
        pairs = similarity._candidates(own, own, **limits)
        assert pairs.select("name_text", "m_name_text").distinct().count() < 4 * n + share * n * n
        got = similar_names(names, names, threshold=threshold)
        if n == 300:
            want = names.alias("t").join(names.alias("m"), F.expr("abs(length(t.pure_name) - length(m.pure_name)) <= 3")).selectExpr(
                "t.pure_name as a", "m.pure_name as b", "levenshtein(t.pure_name, m.pure_name) as d",
                "greatest(length(t.pure_name), length(m.pure_name)) as n",
                "abs(size(split(t.pure_name, ' ')) - size(split(m.pure_name, ' '))) as s",
            ).where(f"s <= 3 and (1 - d / n) * 100 >= {threshold}")
            assert rows(got, "name_text", "verified_text", "distance") == rows(want, "a", "b", "d")
        assert got.count() >= 1.9 * names.count()  # itself and its twin


# --- versions -----------------------------------------------------------------------------------


def test_versions_at_equal_the_range_join(spark):
    """Several satellites, hot and null keys, events before, between and after versions, equal events."""
    generator = random.Random(3)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    histories = {}
    for name in ("color", "size"):
        versions = []
        for key in {k for k in keys if k != "c"}:
            at = generator.randrange(5)
            for _ in range(generator.randrange(1, 60 if key == "hot" else 5)):
                length = generator.randrange(1, 6)
                open_end = generator.random() < 0.1
                versions.append((key, f"{name}{at}", day(at), None if open_end else day(at + length - 1)))
                if open_end:
                    break
                at += length + generator.choice([0, 0, 2])
        histories[name] = spark.createDataFrame(versions, "k string, v string, dv_valid_from date, dv_valid_to date")
    events = [(i, generator.choice(keys), datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=generator.randrange(24 * 200)))
              for i in range(600)]
    events += [(600, "hot", None), (601, "gone", datetime.datetime(2024, 2, 1)), *events[:5]]
    events = spark.createDataFrame(events, "id int, k string, at timestamp").repartition(6)
    got = versions_at(events, "at", histories, ["k"])
    assert got.columns == ["id", "k", "at", "color", "size"]
    want = events.alias("e")
    for name, history in histories.items():
        want = want.join(
            history.alias(name),
            F.expr(f"e.k <=> {name}.k and {name}.dv_valid_from <= e.at and "
                   f"({name}.dv_valid_to is null or cast(e.at as date) <= {name}.dv_valid_to)"), "left",
        )
    want = want.selectExpr("e.id", "color.v as c", "size.v as s")
    assert as_text(got.selectExpr("id", "color.v as c", "size.v as s"), "id", "c", "s") == as_text(want, "id", "c", "s")
    assert versions_at(events.limit(0), "at", histories, ["k"]).count() == 0


def test_running_sums_in_two_levels(spark):
    """Equal to one window over all rows, and no window reads a group as a whole."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, id, -1) as k", "id % 7 as v", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts would be put together
    placed = batch.in_order(df, ["k", "v", "id"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = batch.running_sum(placed, "v", "part", ["place"], name="before")
    window = Window.orderBy("k", "v", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("before", F.coalesce(F.sum("v").over(window), F.lit(0)))
    assert rows(got, "id", "before") == rows(want, "id", "before")
    by = batch.running_sum(placed, "v", "part", ["place"], ["k"], "before")
    window = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("before", F.coalesce(F.sum("v").over(window), F.lit(0)))
    assert rows(by, "id", "before") == rows(want, "id", "before")
    plan = by._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and placed.select("part").distinct().count() > 4


# --- survivors ----------------------------------------------------------------------------------


def test_repoint_neither_grows_nor_chains(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string")
    bridge = spark.createDataFrame(
        [("a", "x"), ("a", "w"), ("b", "b"), (None, "c")], "from_key string, to_key string"
    )
    assert sorted(str(r[0]) for r in golden.repoint(df, bridge, "id").collect()) == ["None", "b", "c", "w"]


def golden_case(generator):
    """Satellite rows in two loads, and a bridge before and after."""
    sat = []
    for i in range(160):
        key = f"c{generator.randrange(40)}"
        value = lambda *some: generator.choice([None, *some])
        sat.append((key, generator.choice("XY") if key == "c0" else "XY"[int(key[1:]) % 2], i, value("n1", "n2", "n3"), value(1.5, 2.5),
                    value(["a"], ["b", None], []), value(True, False)))
    match = lambda k: (f"c{k}", f"c{k + generator.choice([10, 20])}", "XY"[k % 2])
    pairs = sorted({match(generator.randrange(12)) for _ in range(14)})
    late = pairs[::3]
    early = [p for p in pairs if p not in late]
    alone = lambda some: [(f"c{k}", None, "XY"[k % 2]) for k in range(40) if not any(f"c{k}" in p[:2] for p in some)]
    return sat, early + alone(early), pairs + alone(pairs)


@pytest.mark.parametrize("seed", [1, 2])
def test_golden_changes_equal_a_full_fold(spark, seed):
    generator = random.Random(seed)
    sat, before, after = golden_case(generator)
    schema = "hk string, jurisdiction string, n int, name string, x double, tags array<string>, flag boolean"
    bridged = "to_key string, from_key string, jurisdiction string"
    first, second = (spark.createDataFrame(part, schema) for part in (sat[:100], sat[100:]))
    old, new = spark.createDataFrame(before, bridged), spark.createDataFrame(after, bridged)
    moved = spark.createDataFrame(sorted(set(before) ^ set(after), key=repr), bridged)
    state = golden.fold_state(first, ["n"], "hk")
    records = golden.golden_record(old, first, ["n"], "hk")
    changed, again, gone = golden.golden_changes(state, new, second, moved, ["n"], "hk")
    now = joins.anti(records, gone, ["hk", "jurisdiction"]).unionByName(again)
    names = ["hk", "jurisdiction", "n", "name", "x", "tags", "flag"]
    whole = golden.golden_record(new, first.unionByName(second), ["n"], "hk")
    assert as_text(now, *names) == as_text(whole, *names)
    assert again.count() < whole.count()  # untouched survivors are not folded again
    states = joins.anti(state, changed, ["hk"]).unionByName(changed)
    assert as_text(golden.state_rows(states, "hk"), *names) == as_text(golden.state_rows(golden.fold_state(first.unionByName(second), ["n"], "hk"), "hk"), *names)


def test_golden_changes_read_the_new_load_alone(spark):
    """What is folded comes from the states; the satellite's earlier rows are not in the plan."""
    sat, before, after = golden_case(random.Random(5))
    schema = "hk string, jurisdiction string, n int, name string, x double, tags array<string>, flag boolean"
    folder = new_location(spark, "earlier-satellite")
    spark.createDataFrame(sat[:100], schema).write.parquet(folder)
    state = staged(golden.fold_state(spark.read.parquet(folder), ["n"], "hk"), "state")
    new = spark.createDataFrame(after, "to_key string, from_key string, jurisdiction string")
    _, again, _ = golden.golden_changes(state, new, spark.createDataFrame(sat[100:], schema), new.limit(0), ["n"], "hk")
    assert not any("earlier-satellite" in root for root in writers.roots_read(again))


def test_golden_record_prefers_the_survivor(spark):
    bridge = spark.createDataFrame(
        [("d1", "s", "NO"), ("d2", "s", "NO"), (None, "alone", "NO"), ("x", "ghost", "NO")],
        "from_key string, to_key string, jurisdiction string",
    )
    satellite = spark.createDataFrame(
        [
            ("s", "NO", "S", None, ["a"], False), ("d1", "NO", "D1", "one", ["b"], True),
            ("d2", "NO", "D2", "two", ["a", "c"], None), ("alone", "NO", "A", None, None, None),
            ("x", "NO", "X", "x", ["x"], True),
        ],
        "dv_hashkey_company string, jurisdiction string, name string, form string, tags array<string>, branch boolean",
    )
    got = golden.golden_record(bridge, satellite, ["name"])
    assert rows(got.where("name = 'S'"), "dv_hashkey_company", "name", "form", "tags", "branch") == [
        ("s", "S", "one", ["a", "b", "c"], True)
    ]
    assert rows(got, "dv_hashkey_company") == [("alone",), ("s",)]


# --- lookups ------------------------------------------------------------------------------------


def test_containment_keeps_one_match(spark):
    df = spark.createDataFrame([(1, "US", "carolina"), (2, "US", "x"), (3, None, None)], "id int, country_name string, jurisdiction string")
    lookup = spark.createDataFrame(
        [("us", "US.South Carolina"), ("us", "US.North Carolina"), ("NA", "Namibia")],
        "country_name string, jurisdiction string",
    )
    second = spark.createDataFrame([("X", "Xland")], "jurisdiction string, country string")
    got = lookups.by_containment(df, lookup, second)
    assert sorted((r["id"], r["jurisdiction"]) for r in got.where("id < 3").collect()) == [
        (1, "US.North Carolina"), (2, "Xland"),
    ]
    assert got.count() == 3


def test_broadcast_hint_depends_on_size(spark):
    small = spark.range(1)
    hinted = lambda limit: "ResolvedHint" in joins.small_side(small, limit)._jdf.queryExecution().analyzed().toString()
    assert hinted(1 << 20) and not hinted(1)


# --- batching, quality --------------------------------------------------------------------------


def test_groups_cover_every_value_once(spark):
    df = spark.range(1000).selectExpr("case when id < 600 then 'big' else concat('j', id % 20) end as jurisdiction")
    groups = batch.balanced_groups(df, 4)
    assert groups.count() == 21 and groups.agg(F.sum("cnt")).first()[0] == 1000
    assert {r[0] for r in groups.select("group_number").distinct().collect()} <= {1, 2, 3, 4}


def test_suite_from_contract_with_an_absent_column(spark):
    contract = TableContract(name="t", location="", columns=(
        {"name": "key", "type": "string", "tests": [{"check": "isComplete"}, {"check": "isUnique"}]},
        {"name": "code", "type": "string", "tests": [
            {"check": "isComplete"}, {"check": "isContainedIn", "params": [["a", "b"]]}]},
        {"name": "n", "type": "integer", "tests": [
            {"check": "isNonNegative"}, {"check": "hasMax", "params": [["==", 20]]}]},
    ))
    df = spark.createDataFrame([("a", 1), ("b", 20), (None, -3)], "code string, n int")
    got = quality.run_suite(df, quality.suite_from_contract(contract))
    status = {r["constraint"]: r["constraint_status"] for r in got.collect()}
    assert status == {
        "isComplete(key)": "Failure", "isUnique(key)": "Failure", "isComplete(code)": "Failure",
        "isContainedIn(code)": "Success", "isNonNegative(n)": "Failure", "hasMax(n)": "Success",
    }
    assert tuple(quality.summarise(got).first()) == (6, 2, 33.33)


def test_suite_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "a string")
    suite = [{"check": "hasSize", "predicate": ("==", 0)}, {"check": "isUnique", "column": "a"}]
    assert [r["constraint_status"] for r in quality.run_suite(df, suite).collect()] == ["Success", "Failure"]


# --- contracts and sources ----------------------------------------------------------------------


def test_contract_from_parts_with_placeholders():
    parts = merge_contracts(
        {"model": {"name": "t", "location": "lake/t", "unique_key": "k",
                   "columns": [{"name": "k", "type": "string", "nullable": False}]},
         "input_resources": [{"name": "a", "location": "raw/load_date={{load_date}}"}]},
        {"input_resources": [{"name": "b", "location": "raw/b", "filter": "d >= '{{ load_date }}'"}]},
    )
    contract, sources, _ = load_contract(parts, load_date="2024-01-01")
    assert contract.unique_key == ["k"] and contract.required == ["k"]
    assert [s.location for s in sources] == ["raw/load_date=2024-01-01", "raw/b"]
    assert sources[1].filter == "d >= '2024-01-01'"


def test_missing_input_is_an_error(spark):
    with pytest.raises(Exception):
        readers.read_source(spark, SourceSpec("x", "/nowhere/at/all"))
    with pytest.raises(KeyError):
        readers.read_sources(spark, [], only=["x"])


def test_jdbc_writer_sets_its_options():
    class Recorder:
        def __init__(self):
            self.calls = {}

        def __getattr__(self, name):
            def call(*args, **kwargs):
                self.calls.setdefault(name, []).append(args or kwargs)
                return self
            return call

    class Frame:
        write = Recorder()

    writers.write_jdbc(Frame, "jdbc:any:thing", "entity", connections=4, user="u")
    calls = Frame.write.calls
    assert calls["format"] == [("jdbc",)] and calls["mode"] == [("append",)]
    assert ("numPartitions", 4) in calls["option"] and ("dbtable", "entity") in calls["option"]
    assert calls["options"] == [{"user": "u"}] and "save" in calls
