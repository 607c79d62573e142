"""Quality, reconciliation, profiles and batching."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import query, table
from ledgerloom.contract import TableContract
from ledgerloom.operators import batch, profile, quality, reconcile, sketches
from ledgerloom.operators.joins import keep_values

SUITE = [
    {"check": "hasSize", "predicate": (">=", 1000)},
    {"check": "isComplete", "column": "l_shipdate"},
    {"check": "isUnique", "column": "l_orderkey"},
    {"check": "isUnique", "columns": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]},
    {"check": "isContainedIn", "column": "l_returnflag", "values": ["A", "N"]},
    {"check": "isNonNegative", "column": "l_discount"},
    {"check": "hasMin", "column": "l_quantity", "predicate": ("==", 1)},
    {"check": "hasMax", "column": "l_quantity", "predicate": ("<", 50)},
    {"check": "isComplete", "column": "absent"},
]

MEASURES = """
measures as (
    select 0 as position, 'hasSize()' as "constraint", cast(count(*) as double) as value, '>= 1000.0' as expected
        from lineitem
    union all select 1, 'isComplete(l_shipdate)', count(l_shipdate) / count(*), '== 1.0' from lineitem
    union all select 2, 'isUnique(l_orderkey)', count(*) filter (where n = 1) / sum(n), '== 1.0'
        from (select count(*) as n from lineitem group by l_orderkey)
    union all select 3, 'isUnique(l_orderkey,l_linenumber,l_partkey,l_suppkey)',
        count(*) filter (where n = 1) / sum(n), '== 1.0' from (select count(*) as n from lineitem
        group by l_orderkey, l_linenumber, l_partkey, l_suppkey)
    union all select 4, 'isContainedIn(l_returnflag)', count(*) filter (where l_returnflag in ('A', 'N'))
        / count(*), '== 1.0' from lineitem
    union all select 5, 'isNonNegative(l_discount)', count(*) filter (where l_discount >= 0) / count(*),
        '== 1.0' from lineitem
    union all select 6, 'hasMin(l_quantity)', min(l_quantity), '== 1.0' from lineitem
    union all select 7, 'hasMax(l_quantity)', max(l_quantity), '< 50.0' from lineitem
    union all select 8, 'isComplete(absent)', null, '== 1.0'
), results as (
    select "constraint", value, expected, case when case position when 0 then value >= 1000
        when 7 then value < 50 else value = 1 end then 'Success' else 'Failure' end as constraint_status
    from measures
)"""


@query("quality_suite", f"with {MEASURES} select * from results")
def quality_suite(spark, sf_dir):
    return quality.run_suite(table(spark, sf_dir, "lineitem"), SUITE)


@query(
    "quality_summary",
    f"""with {MEASURES} select count(*) as total,
        count(*) filter (where constraint_status = 'Success') as success,
        round(count(*) filter (where constraint_status = 'Success') / count(*) * 100, 2)
            as success_percent from results""",
)
def quality_summary(spark, sf_dir):
    return quality.summarise(quality.run_suite(table(spark, sf_dir, "lineitem"), SUITE))


ORDERS = TableContract(
    name="orders",
    location="",
    columns=(
        {"name": "o_orderkey", "type": "long", "tests": [{"check": "isComplete"}, {"check": "isUnique"}]},
        {"name": "o_custkey", "type": "integer", "tests": [{"check": "isUnique"}]},
        {"name": "o_orderstatus", "type": "string", "tests": [{"check": "isComplete"}]},
        {"name": "o_clerk", "type": "string"},
    ),
)


@query(
    "frame_validate",
    """with c as (select count(*) as n, count(distinct o_orderkey) as k, count(distinct o_custkey) as c,
        count(o_orderstatus) as s from orders)
    select 'o_orderkey' as "column", true as present, true as type_matches,
        cast(case when n <> k then 1 else 0 end as bigint) as failed_tests from c
    union all select 'o_custkey', true, false, case when n <> c then 1 else 0 end from c
    union all select 'o_orderstatus', true, true, case when n <> s then 1 else 0 end from c
    union all select 'o_clerk', false, false, 0""",
)
def frame_validate(spark, sf_dir):
    return quality.validate_frame(table(spark, sf_dir, "orders"), ORDERS)


@query(
    "orphan_links",
    """select o_orderkey, o_custkey from orders where o_custkey not in
    (select c_custkey from customer where c_acctbal >= 0)""",
)
def orphan_links(spark, sf_dir):
    hub = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return quality.orphans(table(spark, sf_dir, "orders"), hub, "o_custkey", "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


def _reconciles(sf_dir):
    path = sf_dir.rstrip("/")
    orders, customer = f"parquet.`{path}/orders.parquet`", f"parquet.`{path}/customer.parquet`"
    return [
        {
            "name": "orders_by_customer",
            "source_sql": f"select count(distinct o_custkey) as customers, count(*) as orders from {orders}",
            "target_sql": f"select (select count(*) from {customer}) as customers, "
            f"(select count(*) from {orders}) as orders",
        },
        {
            "name": "statuses",
            "source_sql": f"select count(distinct o_orderstatus) as statuses from {orders}",
            "target_sql": "select 3 as statuses",
        },
        {
            "name": "broken",
            "source_sql": "select no_such_column as x",
            "target_sql": "select 1 as x",
        },
    ]


RECONCILED = """
pairs as (
    select 'orders_by_customer' as test, 'customers' as metric,
        cast((select count(distinct o_custkey) from orders) as double) as source_value,
        cast((select count(*) from customer) as double) as target_value
    union all select 'orders_by_customer', 'orders', (select count(*) from orders), (select count(*) from orders)
    union all select 'statuses', 'statuses', (select count(distinct o_orderstatus) from orders), 3
    union all select 'broken', 'error: AnalysisException', null, null
), reconciled as (
    select *, target_value - source_value as diff, coalesce(source_value = target_value, false) as status
    from pairs
)"""


@query("reconcile_pairs", f"with {RECONCILED} select * from reconciled")
def reconcile_pairs(spark, sf_dir):
    return reconcile.reconcile_suite(spark, _reconciles(sf_dir))


@query(
    "reconcile_summary",
    f"""with {RECONCILED}, t as (select test, bool_and(status) as status from reconciled group by test)
    select bool_and(status) as status, count(*) as total_test, count(*) filter (where status) as success,
        round(count(*) filter (where status) / count(*) * 100, 2) as success_percent from t""",
)
def reconcile_summary(spark, sf_dir):
    return reconcile.reconcile_summary(reconcile.reconcile_suite(spark, _reconciles(sf_dir)))


@query(
    "distinct_against_total",
    """select 'events' as name, count(*) as total, count(distinct user_id) as distinct_keys from events
    union all select 'orders', count(*), count(distinct o_custkey) from orders""",
)
def distinct_against_total(spark, sf_dir):
    """How far a key is from unique, per table."""
    parts = [
        table(spark, sf_dir, name).agg(
            F.count("*").alias("total"), F.countDistinct(key).alias("distinct_keys")
        ).withColumn("name", F.lit(name))
        for name, key in (("events", "user_id"), ("orders", "o_custkey"))
    ]
    return parts[0].unionByName(parts[1])


def _stat(column, name, value):
    return f"select '{column}' as \"column\", '{name}' as statistic, cast({value} as double) as value from t"


def _profile_sql(columns):
    parts = []
    for column, kind in columns.items():
        parts.append(_stat(column, "null_count", f"count(*) - count({column})"))
        parts.append(_stat(column, "null_percentage", f"(count(*) - count({column})) * 100.0 / count(*)"))
        if kind == "number":
            for name, value in {
                "count": f"count({column})", "distinct": f"count(distinct {column})",
                "min": f"min({column})", "max": f"max({column})",
                "zero_count": f"count(*) filter (where {column} = 0)",
                "negative_count": f"count(*) filter (where {column} < 0)",
            }.items():
                parts.append(_stat(column, name, value))
        elif kind == "text":
            for name, value in {
                "empty_count": f"count(*) filter (where length({column}) = 0)",
                "min_length": f"min(length({column}))", "max_length": f"max(length({column}))",
                "avg_length": f"avg(length({column}))",
            }.items():
                parts.append(_stat(column, name, value))
        elif kind == "flag":
            parts.append(_stat(column, "true_count", f"count(*) filter (where {column})"))
            parts.append(_stat(column, "false_count", f"count(*) filter (where not {column})"))
        else:
            parts.append(_stat(column, "distinct_dates", f"count(distinct {column})"))
            for side in ("min", "max"):
                parts.append(
                    _stat(column, f"{side}_epoch_day", f"{side}(cast({column} as date)) - date '1970-01-01'")
                )
    return " union all ".join(parts)


PROFILED = {
    "o_orderkey": "number", "o_totalprice": "number", "o_orderdate": "date", "o_orderpriority": "text",
    "is_open": "flag", "urgent": "text",
}
_ADDED = ["o_orderstatus = 'O' as is_open", "nullif(o_orderpriority, '5-LOW') as urgent"]


@query(
    "profile",
    f"with t as (select *, {', '.join(_ADDED)} from orders) {_profile_sql(PROFILED)}",
)
def profile_query(spark, sf_dir):
    """Statistics that sum exactly; see ``profile_moments`` for the others."""
    rows = table(spark, sf_dir, "orders").selectExpr("*", *_ADDED)
    return profile.profile(rows, list(PROFILED)).where("statistic not in ('mean', 'stddev')")


@query(
    "profile_moments",
    """select 'l_quantity' as "column", 'mean' as statistic, round(avg(l_quantity), 6) as value from lineitem
    union all select 'l_quantity', 'stddev', round(stddev(l_quantity), 6) from lineitem
    union all select 'l_linenumber', 'mean', round(avg(l_linenumber), 6) from lineitem
    union all select 'l_linenumber', 'stddev', round(stddev(l_linenumber), 6) from lineitem""",
)
def profile_moments(spark, sf_dir):
    rows = profile.profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber"])
    return rows.where("statistic in ('mean', 'stddev')").withColumn("value", F.round("value", 6))


@query(
    "top_values",
    """with v as (select 'l_shipdate' as "column", strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as value from lineitem
        union all select 'l_returnflag', l_returnflag from lineitem
        union all select 'l_suppkey', cast(l_suppkey as varchar) from lineitem),
    c as (select "column", value, count(*) as count from v group by all)
    select *, cast(row_number() over (partition by "column" order by count desc, value) as integer) as rank
    from c qualify rank <= 5""",
)
def top_values(spark, sf_dir):
    return profile.top_values(
        table(spark, sf_dir, "lineitem"), ["l_shipdate", "l_returnflag", "l_suppkey"]
    )


def _two_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    left = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    right = orders.where("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey", "case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus",
        "nullif(o_orderpriority, '2-HIGH') as o_orderpriority", "o_totalprice",
    )
    return left, right


COMPARED = """
a as (select * from orders where o_orderstatus <> 'P'),
b as (select o_orderkey, case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus,
    nullif(o_orderpriority, '2-HIGH') as o_orderpriority from orders where o_orderpriority <> '5-LOW'),
j as (select a.o_orderkey as ak, b.o_orderkey as bk, a.o_orderstatus as s1, b.o_orderstatus as s2,
    a.o_orderpriority as p1, b.o_orderpriority as p2 from a full join b on a.o_orderkey = b.o_orderkey)"""


def _compared(column, a, b):
    return f"""select '{column}' as "column", count(ak) as left_rows, count(bk) as right_rows,
        count(*) as total_rows, count(*) filter (where {a} = {b}) as matching,
        count(*) filter (where {a} <> {b}) as different,
        count(*) filter (where {a} is null and {b} is not null) as null_in_left,
        count(*) filter (where {a} is not null and {b} is null) as null_in_right,
        count(*) filter (where ak is not null and {a} is null) as left_nulls,
        count(*) filter (where bk is not null and {b} is null) as right_nulls from j"""


@query(
    "frame_diff",
    f"""with {COMPARED} {_compared('o_orderstatus', 's1', 's2')} union all {_compared('o_orderpriority', 'p1', 'p2')}
    union all select c, count(ak), count(bk), count(*), null, null, null, null, null, null
        from j cross join (values ('o_custkey'), ('o_totalprice')) v(c) group by c""",
)
def frame_diff(spark, sf_dir):
    return profile.compare(*_two_orders(spark, sf_dir), ["o_orderkey"])


@query(
    "frame_diff_buckets",
    f"""with {COMPARED} {_compared('o_orderstatus', 's1', 's2')} union all {_compared('o_orderpriority', 'p1', 'p2')}
    union all select c, count(ak), count(bk), count(*), null, null, null, null, null, null
        from j cross join (values ('o_custkey'), ('o_totalprice')) v(c) group by c""",
)
def frame_diff_buckets(spark, sf_dir):
    """Q9 by checksums: only rows of buckets that differ meet."""
    return profile.compare_buckets(*_two_orders(spark, sf_dir), ["o_orderkey"], 256)


@query(
    "frame_diff_samples",
    f"""with {COMPARED} select ak as o_orderkey, 'o_orderstatus' as "column", s1 as left_value,
        s2 as right_value from j where s1 <> s2 order by ak limit 5""",
)
def frame_diff_samples(spark, sf_dir):
    return profile.differences(*_two_orders(spark, sf_dir), ["o_orderkey"])


GROUPS = """
counts as (select c_nationkey, count(*) as cnt from customer group by 1),
running as (select *, cast(sum(cnt) over (order by cnt) as bigint) as running_sum from counts),
groups as (select c_nationkey, cnt, running_sum, least(cast(floor(running_sum /
    ((select sum(cnt) from counts) / 4)) as bigint) + 1, 4) as group_number from running)"""


@query("balanced_groups", f"with {GROUPS} select * from groups")
def balanced_groups(spark, sf_dir):
    return batch.balanced_groups(table(spark, sf_dir, "customer"), 4, "c_nationkey")


@query(
    "balanced_group_summary",
    f"""with {GROUPS} select group_number, count(*) as num_values, cast(sum(cnt) as bigint) as total_cnt,
        min(c_nationkey) as first_value, max(c_nationkey) as last_value from groups group by 1""",
)
def balanced_group_summary(spark, sf_dir):
    groups = batch.balanced_groups(table(spark, sf_dir, "customer"), 4, "c_nationkey")
    return batch.group_summary(groups, "c_nationkey")


@query(
    "batched_run",
    f"with {GROUPS} select c_custkey, upper(c_name) as c_name, group_number from customer join groups using (c_nationkey)",
)
def batched_run(spark, sf_dir):
    return batch.run_in_groups(
        table(spark, sf_dir, "customer"), 4,
        lambda df: df.select("c_custkey", F.upper("c_name").alias("c_name"), "group_number"),
        "c_nationkey",
    )


@query(
    "value_set_filter",
    """select c_custkey, c_nationkey from customer where c_nationkey in (1, 3, 5)
    union all select c_custkey, c_nationkey + 100 from customer where c_nationkey < 12""",
)
def value_set_filter(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    few = keep_values(customer, "c_nationkey", [1, 3, 5])
    many = keep_values(customer, "c_nationkey", list(range(12)))
    return few.union(many.select("c_custkey", (F.col("c_nationkey") + 100).cast("int")))


@query(
    "cumulative_share",
    """with c as (select user_id, count(*) as cnt from events group by 1)
    select user_id, cnt, cast(sum(cnt) over (order by cnt) as bigint) as running_sum from c""",
)
def cumulative_share(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("cnt"))
    return batch.running_total(counts)


@query(
    "profile_by_load",
    """with c as (select 'o_orderstatus' as "column", count(*) as rows, count(*) - count(o_orderstatus) as nulls,
            null::double as least, null::double as most from orders
        union all select 'o_custkey', count(*), count(*) - count(o_custkey), min(o_custkey), max(o_custkey) from orders
        union all select 'o_totalprice', count(*), count(*) - count(o_totalprice), min(o_totalprice), max(o_totalprice)
            from orders)
    select *, true as distinct_close, true as median_close, case when "column" = 'o_orderstatus' then
        (select string_agg(s || '=' || n, ',' order by s) from (select o_orderstatus as s, count(*) as n from orders group by 1))
        end as values_of from c""",
)
def profile_by_load(spark, sf_dir):
    """Three loads, a state each, merged: exact figures, and sketches within their stated errors."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_custkey", "o_totalprice", "o_orderkey")
    loads = [sketches.profile_state(orders.where(F.col("o_orderkey") % 3 == i).drop("o_orderkey")) for i in range(3)]
    merged = sketches.profile_of(sketches.merge_states(loads[0].unionByName(loads[1]).unionByName(loads[2])))
    names = ["o_orderstatus", "o_custkey", "o_totalprice"]
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in names])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).alias("n")) for c in names])).alias("x")).select("x.*")
    medians = merged.where("quantiles is not null").select("column", F.get("quantiles", F.lit(1)).alias("median"))
    numbers = orders.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in names[1:]
    ])).alias("x")).select("x.*").join(F.broadcast(medians), "column")
    ranks = numbers.groupBy(F.col("column").alias("of")).agg(
        F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"),
    )
    both = merged.join(exact, F.col("column") == F.col("of")).drop("of").join(ranks, F.col("column") == F.col("of"), "left")
    error = sketches.RANK_ERROR
    return both.select(
        "column", "rows", "nulls", "least", "most",
        (F.abs(F.col("distinct_values") - F.col("n")) <= F.greatest(F.col("n") * sketches.DISTINCT_ERROR, F.lit(1))).alias("distinct_close"),
        F.coalesce((F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error), F.lit(True)).alias("median_close"),
        F.when(F.col("column") == names[0], F.array_join(F.array_sort(F.transform(
            "top", lambda x: F.concat(x["item"], F.lit("="), x["count"].cast("string"))
        )), ",")).alias("values_of"),
    )
