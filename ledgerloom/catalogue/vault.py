"""Vault loads and table merges."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import query, table
from ledgerloom.catalogue.samples import (
    COMPANY, HUB, LOAD_TS, SHIPMENT, VERSION, companies, diff_sql, hub, pure_sql, shipment_links,
)
from ledgerloom.contract import TableContract
from ledgerloom.functions.keys import audit_columns, hash_key
from ledgerloom.functions.text import pure_name
from ledgerloom.operators import merge
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.history import versions_at
from ledgerloom.plans.vault import load_history, load_hub, load_satellite
from ledgerloom.sources import buckets
from ledgerloom.sources.staging import new_location

HUB_KEYS = ["jurisdiction", "dv_hashkey_company"]
HUB_COLUMNS = [
    "dv_hashkey_company", "dv_recsrc", "dv_source_version", "jurisdiction",
    "registration_number", "name", "pure_name", "has_regnum",
]


@query(
    "hub_company_load",
    f"with {HUB} select {', '.join(HUB_COLUMNS)} from hub",
)
def hub_company_load(spark, sf_dir):
    base = load_hub(None, hub(spark, sf_dir, "supplier"), HUB_KEYS)
    added = load_hub(base, hub(spark, sf_dir, "customer"), HUB_KEYS)
    return base.unionByName(added).select(*HUB_COLUMNS)


def _declared(name, location, df):
    columns = tuple({"name": f.name, "type": f.dataType.typeName()} for f in df.schema.fields)
    return TableContract(name=name, location=location, columns=columns)


@query(
    "bucketed_hub_load",
    f"with {HUB} select {', '.join(HUB_COLUMNS)} from hub",
)
def bucketed_hub_load(spark, sf_dir):
    """The hub in buckets by its hash key: three loads, the last of which brings nothing new."""
    rows = hub(spark, sf_dir, "supplier").select(*HUB_COLUMNS)
    contract = _declared("h_company_bucketed", new_location(spark, "hub-buckets"), rows)
    keys, dealt = HUB_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions"))
    for source in ("supplier", "customer", "customer"):
        load = hub(spark, sf_dir, source).select(*HUB_COLUMNS)
        buckets.append_bucketed(buckets.merge_hub(spark, contract, load, keys, dealt), contract, keys, dealt)
    return buckets.bucketed(spark, contract, keys, dealt)


@query(
    "hub_insert_only_rerun",
    f"""with {HUB}, first_batch as (
        select * from hub_rows where source = 'customer' and name like '%Ltd.'
    )
    select h.jurisdiction, h.dv_hashkey_company, min(case when f.dv_hashkey_company is not null
        then 'first' else 'second' end) as dv_source_version
    from hub_rows h left join (select distinct jurisdiction, dv_hashkey_company from first_batch) f
    using (jurisdiction, dv_hashkey_company)
    where h.source = 'customer' group by all""",
)
def hub_insert_only_rerun(spark, sf_dir):
    """An overlapping batch adds what is new, the same batch again nothing."""
    rows = hub(spark, sf_dir, "customer")
    first = rows.where("name like '%Ltd.'").withColumn("dv_source_version", F.lit("first"))
    second = rows.withColumn("dv_source_version", F.lit("second"))
    state = merge.insert_only(None, first, HUB_KEYS)
    for batch in (second, second):
        state = merge.insert_only(state, batch, HUB_KEYS)
    return state.select(*HUB_KEYS, "dv_source_version")


LINK_COLUMNS = [
    "dv_hashkey_l_bol", "dv_hashkey_bol", "dv_recsrc", "dv_source_version",
    "buyer_dv_hashkey_company", "supplier_dv_hashkey_company", "shipper_dv_hashkey_company",
    "export_port", "import_port", "bol", "actual_arrival_date",
]


@query(
    "link_bol_load",
    f"with {SHIPMENT} select distinct {', '.join(LINK_COLUMNS)} from l_bol",
)
def link_bol_load(spark, sf_dir):
    links = shipment_links(spark, sf_dir)
    return load_hub(None, links, ["dv_hashkey_l_bol"]).select(*LINK_COLUMNS)


DEMOGRAPHIC = TableContract(
    name="s_company_demographic",
    location="",
    unique_key=["jurisdiction", "dv_hashdiff"],
    columns=tuple(
        {"name": name, "type": kind}
        for name, kind in [
            ("dv_hashkey_company", "string"), ("dv_recsrc", "string"),
            ("dv_loaddts", "timestamp"), ("dv_source_version", "string"),
            ("jurisdiction", "string"), ("name", "string"), ("segment", "string"),
            ("balance", "decimal(18,2)"), ("is_branch", "boolean"), ("lei_code", "string"),
        ]
    ),
    partition_by=["jurisdiction"],
)


def demographic_rows(spark, sf_dir):
    rows = companies(spark, sf_dir).withColumn("pure_name", pure_name("name"))
    return rows.select(
        hash_key("company").alias("dv_hashkey_company"),
        *audit_columns("tpch", LOAD_TS, VERSION),
        "jurisdiction", "name", "segment", "balance",
        (F.col("balance") < 0).alias("is_branch"),
        F.col("k").alias("undeclared"),
    )


@query(
    "sat_demographic_load",
    f"""with {COMPANY}, rows as (
        select distinct md5(concat_ws(';', jurisdiction, registration_number, {pure_sql('name')}))
                as dv_hashkey_company,
            {diff_sql('jurisdiction', 'name', 'segment', 'balance', 'balance < 0', 'null')} as dv_hashdiff,
            jurisdiction, name, segment, balance, balance < 0 as is_branch,
            cast(null as varchar) as lei_code
        from company)
    select *, balance < 0 as late from rows""",
)
def sat_demographic_load(spark, sf_dir):
    rows = demographic_rows(spark, sf_dir)
    base = load_satellite(None, rows.where("balance >= 0"), DEMOGRAPHIC, "dv_hashkey_company")
    added = load_satellite(base, rows, DEMOGRAPHIC, "dv_hashkey_company")
    columns = [
        "dv_hashkey_company", "dv_hashdiff", "jurisdiction", "name", "segment", "balance",
        "is_branch", "lei_code",
    ]
    return (
        base.withColumn("late", F.lit(False))
        .unionByName(added.withColumn("late", F.lit(True)))
        .select(*columns, "late")
    )


STATUS = TableContract(
    name="s_customer_status",
    location="",
    unique_key="o_custkey",
    columns=tuple(
        {"name": name, "type": kind}
        for name, kind in [
            ("o_custkey", "long"), ("o_orderstatus", "string"), ("o_orderpriority", "string"),
            ("dv_status", "integer"), ("dv_valid_from", "date"), ("dv_valid_to", "date"),
        ]
    ),
)
FIRST_DAY, SECOND_DAY = "1998-01-01", "2001-01-01"


def _latest_status(orders, condition):
    """The latest order of every customer, by date and key."""
    return first_per_key(
        orders.where(condition), ["o_custkey"],
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    ).select("o_custkey", "o_orderstatus", "o_orderpriority")


def history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    early = f"o_orderdate < timestamp_ntz '{FIRST_DAY} 00:00:00'"
    first = _latest_status(orders, early)
    second = _latest_status(orders, f"not ({early})")
    state = load_history(None, first, STATUS, FIRST_DAY)
    return load_history(state, second, STATUS, SECOND_DAY)


HISTORY = f"""
b1 as (select o_custkey, o_orderstatus, o_orderpriority from orders
    where o_orderdate < '{FIRST_DAY}' qualify row_number() over (partition by o_custkey
    order by o_orderdate desc, o_orderkey desc) = 1),
b2 as (select o_custkey, o_orderstatus, o_orderpriority from orders
    where o_orderdate >= '{FIRST_DAY}'
    qualify row_number() over (partition by o_custkey
    order by o_orderdate desc, o_orderkey desc) = 1),
fresh as (select * from b2 where not exists (select 1 from b1 where b1.o_custkey = b2.o_custkey
    and b1.o_orderstatus = b2.o_orderstatus and b1.o_orderpriority = b2.o_orderpriority)),
history as (
    select b1.*, cast(case when f.o_custkey is null then 1 else 0 end as integer) as dv_status,
        date '{FIRST_DAY}' as dv_valid_from,
        case when f.o_custkey is not null then date '{SECOND_DAY}' - 1 end as dv_valid_to
    from b1 left join fresh f on b1.o_custkey = f.o_custkey
    union all
    select *, 1, date '{SECOND_DAY}', null from fresh
)"""
HISTORY_COLUMNS = (
    "o_custkey, o_orderstatus, o_orderpriority, dv_status, dv_valid_from, "
    "cast(dv_valid_to as date) as dv_valid_to, "
    + diff_sql("o_custkey", "o_orderstatus", "o_orderpriority") + " as dv_hashdiff"
)


@query("sat_scd2_two_batches", f"with {HISTORY} select {HISTORY_COLUMNS} from history")
def sat_scd2_two_batches(spark, sf_dir):
    return history(spark, sf_dir)


@query(
    "pit_lookup",
    f"""with {HISTORY} select o_custkey, o_orderstatus, o_orderpriority, dv_valid_from from history
    where dv_valid_from <= date '2000-06-01'
    and (dv_valid_to is null or dv_valid_to >= date '2000-06-01')""",
)
def pit_lookup(spark, sf_dir):
    return merge.valid_at(history(spark, sf_dir), "2000-06-01").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", "dv_valid_from"
    )


@query(
    "gold_upsert_hashdiff",
    f"""select c_custkey as id, c_name as name,
        case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end as segment,
        case when c_acctbal < 0 then date '2024-02-01' else date '2024-01-01' end as created_at,
        {diff_sql('c_custkey', 'c_name', "case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end")}
            as dv_hashdiff,
        case when c_acctbal < 0 or c_mktsegment = 'BUILDING' then 'second' else 'first' end
            as dv_source_version
    from customer""",
)
def gold_upsert_hashdiff(spark, sf_dir):
    """Changed rows are replaced but keep their creation date, new ones come in."""
    first, second = _customer_batches(spark, sf_dir)
    state = merge.upsert(None, first, ["id"])
    return merge.upsert(state, second, ["id"])


def _customer_batches(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    renamed = "case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end"
    first = customer.where("c_acctbal >= 0").selectExpr(
        "c_custkey as id", "c_name as name", "c_mktsegment as segment",
        "date '2024-01-01' as created_at", "'first' as dv_source_version",
    )
    second = customer.selectExpr(
        "c_custkey as id", "c_name as name", f"{renamed} as segment",
        "date '2024-02-01' as created_at", "'second' as dv_source_version",
    )
    return first, second


@query(
    "upsert_change_feed",
    """with changed as (
        select c_custkey as id, c_name as name, c_mktsegment as old, c_acctbal < 0 as fresh,
            case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end as new
        from customer
    )
    select id, name, new as segment, date '2024-02-01' as created_at, 'second' as dv_source_version,
        'insert' as _change_type, 2::bigint as _commit_version from changed where fresh
    union all
    select id, name, old, date '2024-01-01', 'first', 'update_preimage', 2 from changed where not fresh and old <> new
    union all
    select id, name, new, date '2024-01-01', 'second', 'update_postimage', 2 from changed where not fresh and old <> new""",
)
def upsert_change_feed(spark, sf_dir):
    """M3 and M8 in one pass: the feed is what the merge has found, no states are compared."""
    first, second = _customer_batches(spark, sf_dir)
    changes = merge.upsert_changes(merge.upsert(None, first, ["id"]), second, ["id"])
    return changes.feed(2).select(
        "id", "name", "segment", "created_at", "dv_source_version", "_change_type", "_commit_version"
    )


SEGMENT = TableContract(
    name="s_customer_segment",
    location="",
    unique_key="o_custkey",
    columns=tuple(
        {"name": name, "type": kind}
        for name, kind in [
            ("o_custkey", "long"), ("segment", "string"),
            ("dv_status", "integer"), ("dv_valid_from", "date"), ("dv_valid_to", "date"),
        ]
    ),
)


@query(
    "as_of_satellites",
    f"""with {HISTORY}, s1 as (
        select c_custkey as o_custkey, c_mktsegment as segment from customer where c_acctbal >= 0
    ), s2 as (
        select c_custkey as o_custkey,
            case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end as segment
        from customer where c_custkey % 5 <> 0
    ), opened as (select * from s2 where not exists (
        select 1 from s1 where s1.o_custkey = s2.o_custkey and s1.segment = s2.segment)
    ), segments as (
        select s1.*, date '1995-01-01' as dv_valid_from, case when opened.o_custkey is not null
            then date '1996-06-01' - 1 end as dv_valid_to
        from s1 left join opened on s1.o_custkey = opened.o_custkey
        union all
        select *, date '1996-06-01', null from opened
    )
    select o.o_orderkey, h.o_orderstatus as status_then, h.dv_valid_from as status_since, s.segment as segment_then
    from orders o
    left join history h on h.o_custkey = o.o_custkey and h.dv_valid_from <= o.o_orderdate
        and (h.dv_valid_to is null or h.dv_valid_to >= o.o_orderdate)
    left join segments s on s.o_custkey = o.o_custkey and s.dv_valid_from <= o.o_orderdate
        and (s.dv_valid_to is null or s.dv_valid_to >= o.o_orderdate)""",
)
def as_of_satellites(spark, sf_dir):
    """Every order with its customer's status and segment at the time."""
    customer = table(spark, sf_dir, "customer")
    renamed = "case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end"
    first = customer.where("c_acctbal >= 0").selectExpr("c_custkey as o_custkey", "c_mktsegment as segment")
    second = customer.where("c_custkey % 5 <> 0").selectExpr("c_custkey as o_custkey", f"{renamed} as segment")
    segments = load_history(load_history(None, first, SEGMENT, "1995-01-01"), second, SEGMENT, "1996-06-01")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    satellites = {"status": history(spark, sf_dir), "segment": segments}
    return versions_at(orders, "o_orderdate", satellites, ["o_custkey"]).select(
        "o_orderkey", F.col("status.o_orderstatus").alias("status_then"),
        F.col("status.dv_valid_from").alias("status_since"), F.col("segment.segment").alias("segment_then"),
    )


def _order_states(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    before = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    after = orders.where("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey",
        "case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as o_orderstatus",
        "o_orderpriority",
    )
    return before, after


FEED = """
feed as (
    select o_orderkey, o_orderstatus, o_orderpriority, 'delete' as _change_type from orders
        where o_orderstatus <> 'P' and o_orderpriority = '5-LOW'
    union all
    select o_orderkey, case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end,
        o_orderpriority, 'insert' from orders
        where o_orderstatus = 'P' and o_orderpriority <> '5-LOW'
    union all
    select o_orderkey, o_orderstatus, o_orderpriority, 'update_preimage' from orders
        where o_orderstatus <> 'P' and o_orderpriority = '1-URGENT'
    union all
    select o_orderkey, 'X', o_orderpriority, 'update_postimage' from orders
        where o_orderstatus <> 'P' and o_orderpriority = '1-URGENT'
)"""


@query(
    "change_feed",
    f"""with {FEED} select *, cast(7 as bigint) as _commit_version,
        '{LOAD_TS}' as _commit_timestamp from feed""",
)
def change_feed(spark, sf_dir):
    feed = merge.change_feed(*_order_states(spark, sf_dir), ["o_orderkey"], 7, committed=LOAD_TS)
    return feed.withColumn("_commit_timestamp", F.col("_commit_timestamp").cast("string"))


@query(
    "change_feed_split",
    f"""with {FEED} select o_orderkey, o_orderstatus, o_orderpriority,
        case when _change_type = 'delete' then 'delete' else 'upsert' end as action
    from feed where _change_type <> 'update_preimage'""",
)
def change_feed_split(spark, sf_dir):
    """Upserts and deletes above a high-water mark."""
    feed = merge.change_feed(*_order_states(spark, sf_dir), ["o_orderkey"], 7)
    upserts, deletes = merge.split_feed(feed, after_version=6)
    return upserts.withColumn("action", F.lit("upsert")).union(
        deletes.withColumn("action", F.lit("delete"))
    )


def _loads(spark, sf_dir):
    """Orders as an insert-only table: loaded on their date, version by status."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "cast(o_orderdate as timestamp) as dv_loaddts",
        "nullif(o_orderstatus, 'P') as dv_source_version",
    )


@query(
    "state_as_of_load",
    "select o_orderkey, o_totalprice from orders where o_orderdate <= '1998-06-30'",
)
def state_as_of_load(spark, sf_dir):
    return merge.state_as_of(_loads(spark, sf_dir), "1998-06-30 00:00:00").select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "undo_source_version",
    "select o_orderkey, nullif(o_orderstatus, 'P') as dv_source_version from orders"
    " where o_orderstatus <> 'F'",
)
def undo_source_version(spark, sf_dir):
    """A load is taken back; rows without a version stay."""
    return merge.without_version(_loads(spark, sf_dir), "F").select("o_orderkey", "dv_source_version")


@query(
    "conditional_merge_parties",
    """with fix as (select o_orderkey, o_custkey as check_key, o_custkey + 1000000 as value
        from orders where o_orderpriority = '1-URGENT')
    select l_orderkey, l_linenumber,
        case when check_key = l_suppkey then value else l_suppkey end as supplier_id,
        case when check_key is not null and check_key <> l_suppkey and check_key = o.o_custkey
            then value else o.o_custkey end as buyer_id
    from lineitem join orders o on l_orderkey = o.o_orderkey
    left join fix on fix.o_orderkey = l_orderkey""",
)
def conditional_merge_parties(spark, sf_dir):
    """Supplier first, else buyer: the first clause that holds applies."""
    orders = table(spark, sf_dir, "orders")
    line = table(spark, sf_dir, "lineitem")
    base = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey as supplier_id", "o_custkey as buyer_id"
    )
    updates = orders.where("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey as l_orderkey", "o_custkey as check_key", "o_custkey + 1000000 as value"
    )
    check, value = F.col("updates.check_key"), F.col("updates.value")
    return merge.conditional_merge(
        base, updates, ["l_orderkey"],
        [
            (check == F.col("base.supplier_id"), {"supplier_id": value}),
            (check == F.col("base.buyer_id"), {"buyer_id": value}),
        ],
    )


@query(
    "delete_by_keys",
    """select l_orderkey, l_linenumber from lineitem
    where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')
    and not (l_discount > 0.08)""",
)
def delete_by_keys(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    closed = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    kept = merge.delete_keys(line, closed, ["l_orderkey"])
    return merge.delete_where(kept, "l_discount > 0.08").select("l_orderkey", "l_linenumber")


@query(
    "update_by_case",
    """select o_orderkey, case when o_orderstatus = 'F' then 'closed'
        when o_totalprice > 300000 then 'large' else o_orderstatus end as o_orderstatus,
        case when o_orderstatus = 'P' then '9-NONE' else o_orderpriority end as o_orderpriority
    from orders""",
)
def update_by_case(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return merge.update_by_case(
        orders,
        {
            "o_orderstatus": [
                (F.col("o_orderstatus") == "F", F.lit("closed")),
                (F.col("o_totalprice") > 300000, F.lit("large")),
            ],
            "o_orderpriority": [(F.col("o_orderstatus") == "P", F.lit("9-NONE"))],
        },
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "touched_partitions",
    """select o_orderkey, o_orderpriority from orders where o_orderpriority in
    (select o_orderpriority from orders where o_totalprice > 499000)""",
)
def touched_partitions(spark, sf_dir):
    """The part of a table that a merge has to rewrite."""
    orders = table(spark, sf_dir, "orders")
    return merge.touched(
        orders, orders.where("o_totalprice > 499000"), ["o_orderpriority"]
    ).select("o_orderkey", "o_orderpriority")
