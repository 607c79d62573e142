"""Filters, joins, aggregates, windows, sorting and set operations."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import query, table
from ledgerloom.operators import dedupe, frames, joins, nesting


@query(
    "filters_and_rules",
    """select o_orderkey from orders where o_orderstatus in ('O', 'F') and o_orderpriority not like '%LOW%'
    and length(o_orderpriority) > 6 and o_totalprice > 1000 and o_custkey is not null""",
)
def filters_and_rules(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 1000 and o_custkey is not null")
    priority = F.col("o_orderpriority")
    return orders.where(
        F.col("o_orderstatus").isin("O", "F") & ~priority.contains("LOW") & (F.length(priority) > 6)
        & priority.rlike("^[0-9]")
    ).select("o_orderkey")


@query(
    "join_inner",
    """select l_orderkey, l_linenumber, o_custkey, c_name from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey""",
)
def join_inner(spark, sf_dir):
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("l_orderkey", "l_linenumber", "o_custkey", "c_name")
    )


@query(
    "join_left_chain",
    """select c_custkey, n_name, r_name, o_orderkey from customer left join nation on c_nationkey = n_nationkey
    left join (select * from region where r_name <> 'ASIA') on n_regionkey = r_regionkey
    left join orders on o_custkey = c_custkey and o_orderstatus = 'P'""",
)
def join_left_chain(spark, sf_dir):
    region = table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return (
        table(spark, sf_dir, "customer")
        .join(pending, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(joins.small_side(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(joins.small_side(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "n_name", "r_name", "o_orderkey")
    )


@query(
    "join_full",
    """select coalesce(a.o_custkey, b.o_custkey) as o_custkey, a.n as open_orders, b.n as closed_orders
    from (select o_custkey, count(*) as n from orders where o_orderstatus = 'O' group by 1) a
    full join (select o_custkey, count(*) as n from orders where o_orderpriority = '5-LOW' group by 1) b
    on a.o_custkey = b.o_custkey""",
)
def join_full(spark, sf_dir):
    count = lambda test: (
        table(spark, sf_dir, "orders").where(test).groupBy("o_custkey").agg(F.count("*").alias("n"))
    )
    both = joins.outer_compare(count("o_orderstatus = 'O'"), count("o_orderpriority = '5-LOW'"), ["o_custkey"])
    return both.select(
        "o_custkey", F.col("l.n").alias("open_orders"), F.col("r.n").alias("closed_orders")
    )


@query("join_anti", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)")
def join_anti(spark, sf_dir):
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(table(spark, sf_dir, "customer"), large, ["c_custkey"]).select("c_custkey")


@query(
    "join_not_exists",
    """select p_partkey from part where not exists
    (select 1 from lineitem where l_partkey = p_partkey and l_quantity > 45)""",
)
def join_not_exists(spark, sf_dir):
    return spark.sql(
        """select p_partkey from {part} where not exists
           (select 1 from {line} where l_partkey = p_partkey and l_quantity > 45)""",
        part=table(spark, sf_dir, "part"), line=table(spark, sf_dir, "lineitem"),
    )


@query("join_semi", "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_tax = 0.08)")
def join_semi(spark, sf_dir):
    taxed = table(spark, sf_dir, "lineitem").where("l_tax = 0.08").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.semi(table(spark, sf_dir, "orders"), taxed, ["o_orderkey"]).select("o_orderkey")


@query(
    "join_broadcast_lookup",
    "select l_orderkey, l_linenumber, n_name from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey",
)
def join_broadcast_lookup(spark, sf_dir):
    lookup = table(spark, sf_dir, "supplier").join(
        joins.small_side(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "n_name")
    return (
        table(spark, sf_dir, "lineitem")
        .join(joins.small_side(lookup), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "n_name")
    )


@query(
    "join_containment",
    """select c_custkey, n_name from customer join nation on c_nationkey % 5 = n_regionkey
    and contains(n_name, cast(c_nationkey as varchar))""",
)
def join_containment(spark, sf_dir):
    """Equality of the region and, within it, containment of the text."""
    return (
        table(spark, sf_dir, "customer")
        .join(
            joins.small_side(table(spark, sf_dir, "nation")),
            (F.col("c_nationkey") % 5 == F.col("n_regionkey"))
            & F.contains(F.col("n_name"), F.col("c_nationkey").cast("string")),
        )
        .select("c_custkey", "n_name")
    )


@query(
    "folded_text_join",
    "select s_suppkey, c_custkey from supplier join customer on replace(lower(s_name), 'supplier', 'customer') = lower(c_name)",
)
def folded_text_join(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "concat('  ', upper(replace(s_name, 'Supplier', 'Customer')), ' ') as label"
    )
    return joins.on_folded_text(supplier, table(spark, sf_dir, "customer"), "label", "c_name", "inner").select(
        "s_suppkey", "c_custkey"
    )


@query(
    "prefix_join",
    """select p_partkey, brand_no from part left join (select distinct substring(p_type, 1, 3) as prefix,
        upper(substring(p_type, 1, 3)) as brand_no from part where p_type <> 'SMALL')
    on substring(p_type, 1, 3) = prefix""",
)
def prefix_join(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    prefixes = part.where("p_type <> 'SMALL'").selectExpr(
        "substring(p_type, 1, 3) as prefix", "upper(substring(p_type, 1, 3)) as brand_no"
    ).distinct()
    return joins.on_prefix(part, joins.small_side(prefixes), "p_type", "prefix", 3).select("p_partkey", "brand_no")


@query(
    "conditional_key_join",
    """select l_orderkey, l_linenumber, k.label from lineitem left join
    (select 'P' || p_partkey as id, p_name as label from part union all
     select 'S' || s_suppkey, s_name from supplier) k
    on k.id = case when l_returnflag = 'R' then 'S' || l_suppkey else 'P' || l_partkey end""",
)
def conditional_key_join(spark, sf_dir):
    """The key depends on the row; as one expression it stays an equi-join."""
    names = table(spark, sf_dir, "part").selectExpr("concat('P', p_partkey) as id", "p_name as label").union(
        table(spark, sf_dir, "supplier").selectExpr("concat('S', s_suppkey)", "s_name")
    )
    key = F.expr("case when l_returnflag = 'R' then concat('S', l_suppkey) else concat('P', l_partkey) end")
    return table(spark, sf_dir, "lineitem").join(names, key == F.col("id"), "left").select(
        "l_orderkey", "l_linenumber", "label"
    )


@query(
    "or_join",
    """select l_orderkey, l_linenumber, c_custkey from lineitem join orders on l_orderkey = o_orderkey
    join customer on (l_suppkey = c_custkey or o_custkey = c_custkey) and c_acctbal < 0""",
)
def or_join(spark, sf_dir):
    """Line items stream past hash tables of orders and of listed customers; none is sorted."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    trade = table(spark, sf_dir, "lineitem").join(
        joins.build_side(orders), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey")
    listed = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return joins.on_either(trade, listed, "l_suppkey", "o_custkey", "c_custkey").select(
        "l_orderkey", "l_linenumber", "c_custkey"
    )


@query(
    "role_playing_join",
    """select l_orderkey, l_linenumber, b.n_name as buyer_n_name, s.n_name as supplier_n_name from lineitem
    join orders on l_orderkey = o_orderkey left join nation b on b.n_nationkey = o_custkey % 30
    left join nation s on s.n_nationkey = l_suppkey % 30""",
)
def role_playing_join(spark, sf_dir):
    trade = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).selectExpr("l_orderkey", "l_linenumber", "o_custkey % 30 as b", "l_suppkey % 30 as s")
    return joins.role_play(
        trade, table(spark, sf_dir, "nation"), {"buyer": "b", "supplier": "s"}, "n_nationkey", ["n_name"]
    ).drop("b", "s")


@query(
    "sentinel_left_join",
    """select o_orderkey, coalesce(c_name, 'CANT MAP') as buyer from orders
    left join (select * from customer where c_acctbal >= 0) on o_custkey = c_custkey""",
)
def sentinel_left_join(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return (
        table(spark, sf_dir, "orders")
        .join(known, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("o_orderkey", joins.or_sentinel("c_name").alias("buyer"))
    )


@query(
    "consolidate_groups",
    """select o_custkey, bool_or(o_orderstatus = 'O') as any_open, first(late order by o_orderdate, o_orderkey)
        filter (where late is not null) as late,
        array_to_string(list_sort(list(distinct p)), '|') as priorities, max(o_totalprice) as o_totalprice
    from (select *, case when o_orderstatus = 'P' then o_orderpriority end as late,
        unnest([o_orderpriority, o_orderstatus]) as p from orders) group by 1""",
)
def consolidate_groups(spark, sf_dir):
    """Fold by type, with an aggregate of its own for the price."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus = 'O' as any_open",
        "case when o_orderstatus = 'P' then o_orderpriority end as late",
        "array(o_orderpriority, o_orderstatus) as priorities", "o_totalprice",
    )
    folded = dedupe.consolidate(
        rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")],
        rules={"o_totalprice": F.max}, exclude=["o_orderkey", "o_orderdate"],
    )
    return folded.withColumn("priorities", F.array_join("priorities", "|"))


@query(
    "first_non_null",
    """select user_id, first(big order by ts, event_id) filter (where big is not null) as big,
        first(err order by ts, event_id) filter (where err is not null) as err
    from (select *, case when value > 50 then value end as big,
        case when event_type = 'error' then event_id end as err from events) group by 1""",
)
def first_non_null(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "*", "case when value > 50 then value end as big", "case when event_type = 'error' then event_id end as err"
    )
    return dedupe.first_non_null(rows, ["user_id"], ["big", "err"], [F.col("ts"), F.col("event_id")])


@query(
    "nested_collection",
    """select o_custkey, cast(0 as integer) as part, count(*) as n_orders,
        array_to_string(list_sort(list(concat_ws('|', o_orderstatus, o_orderpriority))), ';') as orders
    from orders group by 1""",
)
def nested_collection(spark, sf_dir):
    nested = nesting.nest(
        table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "orders"
    )
    return nested.select(
        "o_custkey", "part", F.size("orders").cast("bigint").alias("n_orders"),
        F.array_join(
            F.transform("orders", lambda x: F.concat_ws("|", x["o_orderstatus"], x["o_orderpriority"])), ";"
        ).alias("orders"),
    )


@query(
    "nested_parts",
    """select o_custkey, cast(4 as bigint) as parts, count(*) as n_orders,
        array_to_string(list_sort(list(concat_ws('|', o_orderstatus, o_orderpriority))), ';') as orders
    from orders group by 1""",
)
def nested_parts(spark, sf_dir):
    """Collections in four parts per key, put together again."""
    orders = table(spark, sf_dir, "orders")
    nested = nesting.nest(orders, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "orders", parts=4)
    documents = nesting.attach_nested(orders.select("o_custkey").distinct(), ["o_custkey"], [nested], parts=4)
    shown = F.transform(
        F.coalesce("orders", F.array().cast("array<struct<o_orderstatus: string, o_orderpriority: string>>")),
        lambda x: F.concat_ws("|", x["o_orderstatus"], x["o_orderpriority"]),
    )
    return (
        documents.select("o_custkey", "part", shown.alias("own"))
        .groupBy("o_custkey")
        .agg(F.countDistinct("part").alias("parts"), F.flatten(F.collect_list("own")).alias("all"))
        .select(
            "o_custkey", "parts", F.size("all").cast("bigint").alias("n_orders"),
            F.array_join(F.array_sort("all"), ";").alias("orders"),
        )
    )


@query(
    "struct_of_firsts",
    """select l_suppkey, first(l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey,
            l_returnflag, l_linestatus) as returnflag,
        first(l_linestatus order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus)
            as linestatus from lineitem group by 1""",
)
def struct_of_firsts(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]
    packed = nesting.struct_of_firsts(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_returnflag", "l_linestatus"],
        [F.col(c) for c in order], "first",
    )
    return packed.selectExpr(
        "l_suppkey", "first.l_returnflag as returnflag", "first.l_linestatus as linestatus"
    )


@query(
    "collected_aliases",
    """select o_custkey, array_to_string(list_sort(list(distinct o_orderpriority) filter
        (where o_orderstatus = 'F')), '; ') as closed, array_to_string(list_sort(list(distinct o_orderstatus)), '; ')
        as statuses from orders group by 1""",
)
def collected_aliases(spark, sf_dir):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.nullif(nesting.joined_values(closed), F.lit("")).alias("closed"),
        nesting.joined_values("o_orderstatus").alias("statuses"),
    )


@query(
    "alias_rows",
    """select distinct o_custkey, 'o_orderpriority' as "column", o_orderpriority as value from orders
    union all select distinct o_custkey, 'o_orderstatus', o_orderstatus from orders""",
)
def alias_rows(spark, sf_dir):
    """The values of a key as rows, where a key may have more of them than a cell holds."""
    return nesting.value_rows(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderpriority", "o_orderstatus"])


@query(
    "nested_children",
    """select o_custkey, o_orderstatus, o_orderpriority, count(*) as copies from orders group by all""",
)
def nested_children(spark, sf_dir):
    """A3 as a table of its own: the nested rows of a key with their numbers, none of them in one cell."""
    rows = nesting.child_rows(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderstatus", "o_orderpriority"])
    return rows.select("o_custkey", "item.o_orderstatus", "item.o_orderpriority", "copies")


@query(
    "basic_aggregates",
    """select l_returnflag, count(*) as n, count(distinct l_suppkey) as suppliers,
        count(*) filter (where l_discount > 0.05) as discounted,
        cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue,
        min(l_quantity) as least, max(l_quantity) as most, round(avg(l_quantity), 6) as mean,
        round(stddev(l_quantity), 6) as spread from lineitem group by 1""",
)
def basic_aggregates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.min("l_quantity").alias("least"),
        F.max("l_quantity").alias("most"),
        F.round(F.avg("l_quantity"), 6).alias("mean"),
        F.round(F.stddev("l_quantity"), 6).alias("spread"),
    )


@query(
    "flag_aggregate",
    """select l_suppkey, bool_or(l_returnflag = 'R') as returned, bool_or(l_quantity > 49) as bulk
    from lineitem group by 1""",
)
def flag_aggregate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
        F.bool_or(F.col("l_quantity") > 49).alias("bulk"),
    )


@query(
    "pivot_status",
    """select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as "F",
        count(*) filter (where o_orderstatus = 'O') as "O", count(*) filter (where o_orderstatus = 'P') as "P",
        round(count(*) filter (where o_orderstatus = 'F') / count(*) * 100, 2) as closed_percent
    from orders group by 1""",
)
def pivot_status(spark, sf_dir):
    counts = (
        table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.count(F.lit(1))).na.fill(0)
    )
    total = F.col("F") + F.col("O") + F.col("P")
    return counts.withColumn("closed_percent", F.round(F.col("F") / total * 100, 2))


@query(
    "share_of_total",
    """select l_suppkey, count(*) as n, count(*) / (select count(*) from lineitem) as share from lineitem group by 1""",
)
def share_of_total(spark, sf_dir):
    return spark.sql(
        """select l_suppkey, count(*) as n, count(*) / (select count(*) from {line}) as share
           from {line} group by l_suppkey""",
        line=table(spark, sf_dir, "lineitem"),
    )


@query(
    "latest_per_key",
    """select user_id, event_id, event_type, value from events qualify row_number() over
    (partition by user_id order by ts desc, event_id desc) = 1""",
)
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return dedupe.first_per_key(events, ["user_id"], order, complete=False).drop("ts")


@query(
    "keep_one_per_key",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity from lineitem qualify row_number()
    over (partition by l_orderkey order by l_partkey, l_suppkey, l_linenumber, l_quantity) = 1""",
)
def keep_one_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    return dedupe.first_per_key(rows, ["l_orderkey"])


@query(
    "most_complete_per_key",
    """select user_id, event_id, big, err from (select *, case when value > 50 then value end as big,
        case when event_type = 'error' then event_id end as err from events)
    qualify row_number() over (partition by user_id order by big is null, err is null, event_id) = 1""",
)
def most_complete_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "user_id", "event_id", "case when value > 50 then value end as big",
        "case when event_type = 'error' then event_id end as err",
    )
    return dedupe.most_complete_per_key(rows, ["user_id"], ["big", "err"], [F.col("event_id").asc()])


@query(
    "sort_limit_distinct",
    """select o_custkey, o_orderpriority from (select distinct o_custkey, o_orderpriority from orders)
    order by o_custkey desc, o_orderpriority limit 100""",
)
def sort_limit_distinct(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()
        .orderBy(F.col("o_custkey").desc(), F.col("o_orderpriority").asc()).limit(100)
    )


@query(
    "latest_version",
    """select o_custkey, o_orderkey, o_orderstatus from orders qualify row_number() over
    (partition by o_custkey order by o_orderkey desc) = 1
    union all select -1, o_orderkey, o_orderstatus from orders where o_orderkey = (select max(o_orderkey) from orders)""",
)
def latest_version(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    overall = dedupe.latest_version(rows, "o_orderkey").withColumn("o_custkey", F.lit(-1).cast("bigint"))
    return dedupe.latest_version(rows, "o_orderkey", ["o_custkey"]).union(overall)


@query(
    "union_years",
    """select year(o_orderdate) as yyyy, case when year(o_orderdate) < 1998 then o_orderstatus end as o_orderstatus,
        case when year(o_orderdate) >= 1998 then o_orderpriority end as o_orderpriority, count(*) as n
    from orders group by all""",
)
def union_years(spark, sf_dir):
    """Yearly frames with different columns put together by name."""
    orders = table(spark, sf_dir, "orders").withColumn("yyyy", F.year("o_orderdate").cast("bigint"))
    early = orders.where("yyyy < 1998").select("yyyy", "o_orderstatus")
    late = orders.where("yyyy >= 1998").select("o_orderpriority", "yyyy")
    return frames.union_all(early, late).groupBy("yyyy", "o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n")
    )


@query(
    "union_alias_distinct",
    "select o_custkey as key from orders union select s_suppkey from supplier union select c_custkey from customer",
)
def union_alias_distinct(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
        .union(table(spark, sf_dir, "supplier").select("s_suppkey"))
        .union(table(spark, sf_dir, "customer").select("c_custkey"))
        .distinct()
    )


@query(
    "name_and_alias_rows",
    "select 'name' as kind, p_name as label from part union all select 'brand', p_brand from part",
)
def name_and_alias_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(F.lit("name").alias("kind"), F.col("p_name").alias("label")).union(
        part.select(F.lit("brand"), "p_brand")
    )
