"""Scans, sinks and staging by round trip."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import query, table
from ledgerloom.contract import SourceSpec, TableContract
from ledgerloom.sources import readers, writers
from ledgerloom.sources.ingest import ingest_new, stamped
from ledgerloom.sources.staging import new_location, staged

CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query(
    "contract_scan",
    """select c_custkey, c_mktsegment, null as o_orderkey from customer where c_acctbal > 0
    union all select o_custkey, null, o_orderkey from orders where o_orderstatus = 'P'""",
)
def contract_scan(spark, sf_dir):
    """Declared inputs with filters; one of them is not asked for."""
    specs = [
        SourceSpec("customer", f"{sf_dir}/customer.parquet", filter="c_acctbal > 0"),
        SourceSpec("orders", f"{sf_dir}/orders.parquet", filter="o_orderstatus = 'P'"),
        SourceSpec("missing", f"{sf_dir}/missing.parquet"),
    ]
    inputs = readers.read_sources(spark, specs, only=["customer", "orders"])
    return inputs["customer"].select("c_custkey", "c_mktsegment").unionByName(
        inputs["orders"].selectExpr("o_custkey as c_custkey", "o_orderkey"), allowMissingColumns=True
    )


@query(
    "scan_csv_parts",
    f"select {', '.join(CUSTOMER)}, true as from_part from customer",
)
def scan_csv_parts(spark, sf_dir):
    """All csv parts of a folder in one scan, with the file of every row."""
    location = new_location(spark, "csv")
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER)
    rows.repartition(3, "c_custkey").write.option("header", True).csv(location)
    parts = readers.read_parts(spark, f"{location}/*.csv", schema=CUSTOMER_DDL)
    return parts.select(*CUSTOMER, F.col("source_file").like("part-%.csv").alias("from_part"))


@query(
    "scan_csv_multiline",
    "select page_id, url, html from pages",
)
def scan_csv_multiline(spark, sf_dir):
    """Quoted fields with quotes, commas and line breaks survive."""
    location = new_location(spark, "multiline")
    table(spark, sf_dir, "pages").write.options(header=True, quote='"', escape='"').csv(location)
    return readers.read_csv(
        spark, location, schema="page_id bigint, url string, html string", multiLine=True
    )


@query("scan_json_glob", f"select {', '.join(CUSTOMER)} from customer")
def scan_json_glob(spark, sf_dir):
    location = new_location(spark, "json")
    table(spark, sf_dir, "customer").select(*CUSTOMER).write.partitionBy("c_nationkey").json(location)
    read = readers.read_json(spark, f"{location}/c_nationkey=*/*.json", CUSTOMER_DDL, basePath=location)
    return read.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_mktsegment")


@query("scan_path_sql", "select o_orderkey, o_totalprice from orders where o_orderpriority = '1-URGENT'")
def scan_path_sql(spark, sf_dir):
    return readers.read_path_sql(spark, f"{sf_dir}/orders.parquet").where(
        "o_orderpriority = '1-URGENT'"
    ).select("o_orderkey", "o_totalprice")


@query(
    "scan_lookup",
    """select c_custkey, case when n_nationkey = 7 then 'NA' else 'C' || n_nationkey end as code
    from customer join nation on c_nationkey = n_nationkey""",
)
def scan_lookup(spark, sf_dir):
    """A lookup csv in which "NA" is a value."""
    location = new_location(spark, "lookup")
    table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as key", "case when n_nationkey = 7 then 'NA' else concat('C', n_nationkey) end as code"
    ).write.option("header", True).csv(location)
    lookup = readers.read_lookup(spark, location)
    return table(spark, sf_dir, "customer").join(
        lookup, F.col("c_nationkey").cast("string") == F.col("key")
    ).select("c_custkey", "code")


def _orders_contract(location, extra=()):
    columns = [("o_orderkey", "long"), ("o_totalprice", "decimal(18,2)"), ("o_orderstatus", "string")]
    return TableContract(
        name="orders", location=location, unique_key="o_orderkey", partition_by="o_orderstatus",
        columns=tuple({"name": n, "type": t} for n, t in [*columns, *extra]),
    )


@query(
    "append_roundtrip",
    """select o_orderkey, cast(o_totalprice as decimal(18,2)) as o_totalprice, o_orderstatus from orders
    where o_orderstatus <> 'P'""",
)
def append_roundtrip(spark, sf_dir):
    """An empty table, then two appends with different columns."""
    contract = _orders_contract(new_location(spark, "append"))
    orders = table(spark, sf_dir, "orders")
    before = writers.table_state(spark, contract)
    writers.append(orders.where("o_orderstatus = 'F'"), contract)
    writers.append(
        orders.where("o_orderstatus = 'O'").select("o_orderstatus", "o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice")),
        contract,
    )
    return before.unionByName(writers.table_state(spark, contract))


@query(
    "partition_replace",
    """select o_orderkey, case when o_orderstatus = 'F' then cast(0 as decimal(18,2))
        else cast(o_totalprice as decimal(18,2)) end as o_totalprice, o_orderstatus from orders""",
)
def partition_replace(spark, sf_dir):
    """Only the partitions of the new rows are rewritten."""
    contract = _orders_contract(new_location(spark, "replace"))
    orders = table(spark, sf_dir, "orders")
    writers.append(orders, contract)
    changed = orders.where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey", "cast(0 as decimal(18,2)) as o_totalprice", "o_orderstatus"
    )
    writers.replace_partitions(changed, contract)
    return writers.table_state(spark, contract)


@query("truncate_insert", "select o_orderkey, cast(o_totalprice as decimal(18,2)) as o_totalprice, o_orderstatus from orders where o_orderstatus = 'P'")
def truncate_insert(spark, sf_dir):
    contract = _orders_contract(new_location(spark, "truncate"))
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_totalprice as decimal(18,2)) as o_totalprice", "o_orderstatus"
    )
    writers.replace_all(rows, contract)
    writers.replace_all(rows.where("o_orderstatus = 'P'"), contract)
    return writers.table_state(spark, contract)


@query("staged_reread", "select o_custkey, count(*) as n from orders group by 1")
def staged_reread(spark, sf_dir):
    return staged(table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")))


@query(
    "incremental_read",
    """select o_orderkey, '2001-01-01' as load_date from orders where o_orderdate >= '2000-06-01'""",
)
def incremental_read(spark, sf_dir):
    """Rows since a load date, which prunes partitions, and a timestamp."""
    location = new_location(spark, "incremental")
    table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate as timestamp) as dv_loaddts",
        "case when o_orderdate >= timestamp_ntz '2000-01-01 00:00:00' then '2001-01-01' else '2000-01-01' end as load_date",
    ).write.partitionBy("load_date").parquet(location)
    rows = spark.read.parquet(location)
    return readers.read_since(rows, "2000-06-01 00:00:00", "2001-01-01").select(
        "o_orderkey", F.col("load_date").cast("string").alias("load_date")
    )


@query(
    "search_export",
    """select c_custkey as id, c_name as name, c_mktsegment as description, n_name as jurisdiction,
        n_name as country from customer join nation on c_nationkey = n_nationkey where c_acctbal > 0""",
)
def search_export(spark, sf_dir):
    """Search documents of trading companies, written as json and read back."""
    location = new_location(spark, "search")
    nation = table(spark, sf_dir, "nation")
    entities = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "c_custkey as id", "c_name as name", "c_mktsegment as description", "n_name as jurisdiction",
        "n_name as country_name", "c_acctbal > 0 as is_trade",
    )
    writers.export_search_documents(entities, location)
    return readers.read_json(
        spark, location, "id bigint, name string, description string, jurisdiction string, country string"
    ).select("id", "name", "description", "jurisdiction", "country")


@query(
    "high_water_mark",
    "select o_orderkey, cast(3 as bigint) as _commit_version from orders where o_orderstatus = 'P'",
)
def high_water_mark(spark, sf_dir):
    """Changes above the last noted version; noting it twice changes nothing."""
    log = new_location(spark, "log")
    feed = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as bigint) as _commit_version"
    )
    for version in (1, 2, 2):
        writers.advance(spark, log, version)
    return writers.unprocessed(feed, writers.last_version(spark, log))


@query(
    "ingest_new_parts",
    """select o_orderkey, o_orderstatus, if(o_orderdate < '1996-01-01', 'first', 'second') as dv_source_version,
        null as late from orders
    union all select null, null, null, 0""",
)
def ingest_new_parts(spark, sf_dir):
    """A folder that gets a second part between runs: each part is taken once, a run without a new part takes nothing."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_orderstatus"]
    source, target, log = (new_location(spark, name) for name in ("parts", "taken", "taken-log"))
    early = F.col("o_orderdate") < F.lit("1996-01-01")
    for condition, version in ((early, "first"), (~early, "second")):
        orders.where(condition).select(*columns).write.mode("append").parquet(source)
        ingest_new(spark, source, target, log, orders.select(*columns).schema, transform=stamped(version))
    again = ingest_new(spark, source, target, log, orders.select(*columns).schema, transform=stamped("third"))
    rows = spark.read.parquet(target).select(*columns, "dv_source_version", F.lit(None).cast("int").alias("late"))
    return rows.unionByName(spark.range(1).select(F.lit(again).cast("int").alias("late")), allowMissingColumns=True)
