"""Source jobs: bronze cleaning and vault recipes, from a raw frame to a table's rows."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.cleaning import _clean_sql
from ledgerloom.catalogue.registry import query, table
from ledgerloom.catalogue.samples import LOAD_TS, pure_sql
from ledgerloom.operators.joins import small_side
from ledgerloom.plans import bronze, recipes
from ledgerloom.plans.targets import contract_of


@query(
    "job_standard_clean",
    f"select page_id, {_clean_sql('url')} as page_url, {_clean_sql('html')} as raw_html, '2024-01-01' as load_date from pages",
)
def job_standard_clean(spark, sf_dir):
    raw = table(spark, sf_dir, "pages").selectExpr("page_id as `Page Id`", "url as pageUrl", "html as `raw.html`")
    return bronze.standard_clean(raw, "2024-01-01")


@query(
    "job_new_york",
    """select c_custkey as registration_number, c_name as name, cast('1998-02-03' as date) as date_incorporated,
        nullif(concat_ws(', ', case when c_custkey % 2 = 0 then 'Road ' || c_nationkey end,
            case when c_custkey % 3 = 0 then 'City ' || c_nationkey end), '') as ceo_full_address,
        n_name <> 'NATION_1' as is_branch
    from customer join nation on c_nationkey = n_nationkey""",
)
def job_new_york(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "c_custkey as `DOS ID`", "c_name as `Current Entity Name`", "'02/03/1998' as `Initial DOS Filing Date`",
        "case n_name when 'NATION_1' then 'New York' else n_name end as Jurisdiction", "c_mktsegment as `CEO Name`",
        "case when c_custkey % 2 = 0 then concat('Road ', c_nationkey) end as `CEO Address 1`",
        "case when c_custkey % 3 = 0 then concat('City ', c_nationkey) end as `CEO City`",
    )
    return bronze.new_york(raw, "2024-01-01").select(
        "registration_number", "name", "date_incorporated", "ceo_full_address", "is_branch"
    )


@query(
    "job_sanction_company",
    f"""select case p_size % 3 when 0 then 'ru' when 1 then p_brand else 'Unknown' end as jurisdiction, p_name as company_name,
        {pure_sql('p_name')} as pure_name, case when p_size % 2 = 0 then concat(p_partkey, '-', p_size) end as tax_number,
        p_size % 5 = 0 as is_sanctioned, concat(p_type, '|', p_name) as other_names,
        concat('Note: ', p_type, ' - ', p_brand) as description_full
    from part""",
)
def job_sanction_company(spark, sf_dir):
    """A sanction list with nested properties, as company rows."""
    raw = table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as id", "p_name as caption", "'Company' as schema",
        """named_struct(
            'jurisdiction', case when p_size % 3 = 0 then array('ru', 'by') end,
            'country', case when p_size % 3 = 1 then array(p_brand) else array() end,
            'alias', array(p_type), 'name', array(p_name, p_type),
            'taxNumber', case when p_size % 2 = 0 then array(cast(p_partkey as string), cast(p_size as string)) end,
            'notes', array(p_type, p_brand),
            'topics', case when p_size % 5 = 0 then array('sanction') end) as properties""",
    )
    rows = bronze.sanction_company(raw, load_date="2024-01-01")
    return rows.select(
        "jurisdiction", "company_name", "pure_name", "tax_number", "is_sanctioned",
        F.array_join("other_names", "|").alias("other_names"), "description_full",
    )


@query(
    "job_sanction_edges",
    """select cast(user_id as varchar) as from_entity_id, event_type as to_entity_id,
        cast(date_trunc('month', ts) as date) as start_date, case event_type when 'click' then 'Director'
        when 'view' then 'Employee' else event_type end as position,
        cast(case event_type when 'click' then 1 when 'view' then 5 else 0 end as integer) as position_code
    from events""",
)
def job_sanction_edges(spark, sf_dir):
    raw = table(spark, sf_dir, "events").selectExpr(
        "case event_type when 'click' then 'Managing Director' when 'view' then 'an employee' else event_type end as caption",
        "'Membership' as schema",
        """named_struct('member', array(cast(user_id as string)), 'organization', array(event_type),
           'startDate', array(date_format(ts, 'yyyy-MM'))) as properties""",
    )
    return bronze.sanction_edge(raw, "membership", "2024-01-01").select(
        "from_entity_id", "to_entity_id", "start_date", "position", "position_code"
    )


def _trades(spark, sf_dir):
    """Orders' lines as trades between named importers and exporters."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    place = lambda name: nation.select(F.col("n_nationkey").alias(f"{name}_key"), F.col("n_name").alias(name))
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(small_side(supplier.select("s_suppkey", "s_name", "s_nationkey")), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(place("import_country"), F.col("c_nationkey") == F.col("import_country_key"))
        .join(place("export_country_or_area"), F.col("s_nationkey") == F.col("export_country_or_area_key"))
        .selectExpr(
            "l_orderkey", "l_linenumber", "l_partkey",
            "case when c_custkey % 10 = 0 then null else import_country end as import_country",
            "export_country_or_area", "c_name as importer", "s_name as exporter",
            "o_orderstatus as data_source", "'x' as dv_recsrc",
        )
    )


TRADES = """
trades as (select l_orderkey, l_linenumber, l_partkey, case when c_custkey % 10 = 0 then null else i.n_name end as import_country,
        e.n_name as export_country_or_area, c_name as importer, s_name as exporter, o_orderstatus as data_source
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join supplier on l_suppkey = s_suppkey join nation i on c_nationkey = i.n_nationkey
    join nation e on s_nationkey = e.n_nationkey),
parties as (select distinct coalesce(import_country, 'unspecified') as jurisdiction, importer as name, data_source from trades
    union select export_country_or_area, exporter, data_source from trades)"""


@query(
    "job_trade_company_hub",
    f"""with {TRADES} select md5(concat_ws(';', jurisdiction, {pure_sql('name')})) as dv_hashkey_company, 'feed' as dv_recsrc,
        min(concat(data_source, ';20240108')) as dv_source_version, jurisdiction, name, cast(0 as integer) as has_regnum
    from parties group by jurisdiction, name""",
)
def job_trade_company_hub(spark, sf_dir):
    """Importers and exporters of trades, loaded into the company hub."""
    rows = recipes.load(
        recipes.RECIPES["h_company/trade_dat"], None, _trades(spark, sf_dir),
        contract_of("h_company", "lake"), record_source="feed", load_ts=LOAD_TS,
    )
    return rows.select(
        "dv_hashkey_company", "dv_recsrc", "dv_source_version", "jurisdiction", "name", "has_regnum"
    )


@query(
    "job_address_satellite",
    f"""with c as (select c_custkey, c_name, c_mktsegment, {pure_sql('c_name')} as pure_name from customer),
    rows as (
        select c_custkey, pure_name, c_mktsegment as full_address, 1 as type from c where c_custkey % 4 <> 0
        union all select c_custkey, pure_name, concat('Box ', c_custkey), 3 from c)
    select md5(concat_ws(';', 'CA.Newfoundland and Labrador', c_custkey, pure_name)) as dv_hashkey_company, full_address,
        cast(type as integer) as type, 'Canada' as country_name from rows""",
)
def job_address_satellite(spark, sf_dir):
    """Main and mailing address of a register as address satellite rows."""
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_name as company_name", "c_custkey as company_number",
        "case when c_custkey % 4 <> 0 then c_mktsegment end as main_full_address",
        "concat('Box ', c_custkey) as mailing_full_address", "'A1' as registered_office_postal_zip_code",
        "'B2' as registered_office_outside_nl_postal_zip_code",
    )
    rows = recipes.load(
        recipes.RECIPES["s_company_address/newfoundland"], None, raw,
        contract_of("s_company_address", "lake"), load_ts=LOAD_TS,
    )
    return rows.select("dv_hashkey_company", "full_address", "type", "country_name")


@query(
    "job_person_company_links",
    f"""with l as (select distinct user_id, event_type from events)
    select md5(concat_ws(';', md5(concat_ws(';', 'NO', concat('User ', user_id))),
            md5(concat_ws(';', 'SE', user_id, concat('firm ', user_id))), event_type)) as dv_hashkey_l_person_company_relationship,
        md5(concat_ws(';', 'NO', concat('User ', user_id))) as dv_hashkey_person, event_type as position,
        cast(4 as integer) as position_code
    from l where event_type <> 'error'""",
)
def job_person_company_links(spark, sf_dir):
    """Positions of users at firms; a row without position is no link."""
    raw = table(spark, sf_dir, "events").selectExpr(
        "'NO' as from_jurisdiction", "concat('User ', user_id) as from_name", "cast(null as string) as from_full_address",
        "'SE' as to_jurisdiction", "user_id as to_registration_number", "concat('firm ', user_id) as to_pure_name",
        "nullif(event_type, 'error') as position", "4 as position_code",
    )
    rows = recipes.load(
        recipes.RECIPES["l_person_company_relationship/register"], None, raw,
        contract_of("l_person_company_relationship", "lake"), record_source="feed", load_ts=LOAD_TS,
    )
    return rows.select(
        "dv_hashkey_l_person_company_relationship", "dv_hashkey_person", "position", "position_code"
    )


@query(
    "job_shipments_by_name",
    f"""with {TRADES} select l_orderkey, l_linenumber,
        case when s.s_name is null then 'CANT MAP' else md5(concat('S', s_suppkey)) end as supplier_dv_hashkey_company,
        case when c_name is null then 'CANT MAP' else md5(concat('C', c_custkey)) end as buyer_dv_hashkey_company
    from trades left join (select * from supplier join nation on s_nationkey = n_nationkey where s_acctbal > 0) s
        on s.s_name = exporter and s.n_name = export_country_or_area
    left join (select * from customer join nation on c_nationkey = n_nationkey where c_acctbal > 0) c
        on c.c_name = importer and c.n_name = import_country""",
)
def job_shipments_by_name(spark, sf_dir):
    """Parties of trades by pure name and country; those not known are named so."""
    nation = table(spark, sf_dir, "nation")
    known = lambda name, p, mark: table(spark, sf_dir, name).where(f"{p}_acctbal > 0").join(
        nation, F.col(f"{p}_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        f"lower({p}_name) as pure_name", "n_name as jurisdiction",
        f"md5(concat('{mark}', {p}_{'supp' if p == 's' else 'cust'}key)) as dv_hashkey_company",
    )
    trades = _trades(spark, sf_dir).selectExpr(
        "l_orderkey", "l_linenumber", "concat(l_orderkey, '-', l_linenumber, '-', l_partkey) as bol",
        "lower(exporter) as pure_seller", "export_country_or_area as seller_country",
        "lower(importer) as pure_buyer", "import_country as buyer_country",
    )
    linked = recipes.shipments_by_name(
        trades, known("supplier", "s", "S"), known("customer", "c", "C"), local_side="buyer"
    )
    return linked.select(
        "l_orderkey", "l_linenumber", "supplier_dv_hashkey_company", "buyer_dv_hashkey_company"
    )
