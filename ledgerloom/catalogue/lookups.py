"""Jurisdictions, countries, ports and customs codes."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import query, table
from ledgerloom.catalogue.samples import LOAD_TS, LOOKUP, VERSION, lookup_jurisdiction
from ledgerloom.functions import codes
from ledgerloom.operators import lookups
from ledgerloom.plans import hscodes, marts
from ledgerloom.plans import ports as port_plans


def _placed(spark, sf_dir):
    """Customers with nation and region name."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


PLACED = """
placed as (select * from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey)"""


@query(
    "jurisdiction_by_containment",
    f"""with {LOOKUP},{PLACED} select c_custkey, case when c_custkey % 3 = 0 then 'Region ' || r_name
        when c_custkey % 3 = 1 then (case when n_nationkey % 4 = 0 then 'US.' else '' end) || n_name
        end as jurisdiction, case when c_custkey % 3 = 0 then 'nowhere' else lower(n_name) end
        as country_name from placed""",
)
def jurisdiction_by_containment(spark, sf_dir):
    rows = _placed(spark, sf_dir).selectExpr(
        "c_custkey",
        "case c_custkey % 3 when 0 then lower(r_name) when 1 then lower(n_name) else 'elsewhere' end as jurisdiction",
        "case when c_custkey % 3 = 0 then 'nowhere' else lower(n_name) end as country_name",
    )
    second = table(spark, sf_dir, "region").selectExpr(
        "r_name as jurisdiction", "concat('Region ', r_name) as country"
    )
    return lookups.by_containment(rows, lookup_jurisdiction(spark, sf_dir), second)


_SEGMENT_ROW = """case c_custkey % 4 when 0 then lower(n_name) when 1 then 'Unknown' when 2 then null
    else r_name end"""


@query(
    "jurisdiction_by_segment",
    f"""with {LOOKUP},{PLACED}, f as (select c_custkey, n_name, n_nationkey, r_name, case when
            c_custkey % 4 in (1, 2) then n_name else {_SEGMENT_ROW} end as filled from placed)
    select c_custkey, n_name as country_name, case when c_custkey % 4 <> 3 then
        (case when n_nationkey % 4 = 0 then 'US.' else '' end) || n_name else filled end
        as jurisdiction, c_custkey % 4 <> 3 as is_correct from f""",
)
def jurisdiction_by_segment(spark, sf_dir):
    rows = _placed(spark, sf_dir).selectExpr(
        "c_custkey", f"{_SEGMENT_ROW} as jurisdiction", "n_name as country_name"
    )
    return lookups.by_last_segment(rows, lookup_jurisdiction(spark, sf_dir))


@query(
    "jurisdiction_evidence_fix",
    f"""with {PLACED} select c_custkey,
        case c_custkey % 5 when 1 then n_name when 3 then n_name else r_name end as jurisdiction,
        case c_custkey % 5 when 0 then r_name when 3 then n_name else n_name end as country_name,
        c_custkey % 5 <> 4 as is_correct from placed""",
)
def jurisdiction_evidence_fix(spark, sf_dir):
    """0: only the jurisdiction is in the address, 1: only the country, 2: both,
    3: both columns equal, 4: neither."""
    rows = _placed(spark, sf_dir).selectExpr(
        "c_custkey",
        "case when c_custkey % 5 = 3 then n_name else r_name end as jurisdiction",
        "n_name as country_name",
        """case c_custkey % 5 when 0 then concat('Road 1, ', lower(r_name)) when 1 then
           concat('Road 1, ', n_name) when 2 then concat(r_name, ' ', n_name) else 'Road' end
           as full_address""",
        "false as is_correct",
    )
    return lookups.by_address(rows).drop("full_address")


@query(
    "jurisdiction_unspecified",
    f"""with {PLACED} select c_custkey, case when r_name in ('ASIA', 'EUROPE') or c_custkey % 9 = 0
        then 'unspecified' else n_name end as jurisdiction from placed""",
)
def jurisdiction_unspecified(spark, sf_dir):
    raw = """case when c_custkey % 9 = 0 then null when r_name = 'ASIA' then 'Global'
        when r_name = 'EUROPE' then 'European Union' else n_name end as jurisdiction"""
    rows = _placed(spark, sf_dir).selectExpr("c_custkey", raw)
    return rows.withColumn("jurisdiction", codes.unspecified("jurisdiction"))


_VALID = """case n_nationkey when 0 then 'US.Texas' when 1 then 'US.Florida' when 2 then 'United States'
    when 3 then 'Bolivia' when 4 then 'unspecified' when 5 then 'US.Nowhere' else n_name end"""
_STATE_TEXT = """case c_custkey % 8 when 0 then 'TX' when 1 then 'Fl' when 2 then 'USA'
    when 3 then 'Bolivia, Plurinational State of' when 4 then '' when 5 then 'Nowhere'
    when 6 then concat('Republic of ', n_name) else n_name end"""


@query(
    "jurisdiction_state_codes",
    f"""with {PLACED}, v as (select {_VALID} as jurisdiction, concat('Republic of ', n_name)
            as official_name from nation),
    r as (select c_custkey, n_name, case when c_custkey % 8 in (0, 1, 2, 5) then 'US' else 'XX' end
        as country_code, case c_custkey % 8 when 0 then 'US.Texas' when 1 then 'US.Florida'
        when 2 then 'United States' when 3 then 'Bolivia' when 4 then 'unspecified'
        when 5 then 'US.Nowhere' when 6 then (select min(v.jurisdiction) from v where
        v.official_name = concat('Republic of ', n_name)) else n_name end as jurisdiction from placed)
    select c_custkey, country_code, jurisdiction from r
    where jurisdiction in (select jurisdiction from v)""",
)
def jurisdiction_state_codes(spark, sf_dir):
    rows = _placed(spark, sf_dir).selectExpr(
        "c_custkey", "case when c_custkey % 8 in (0, 1, 2, 5) then 'US' else 'XX' end as country_code",
        f"{_STATE_TEXT} as jurisdiction",
    )
    lookup = table(spark, sf_dir, "nation").selectExpr(
        f"{_VALID} as jurisdiction", "concat('Republic of ', n_name) as official_name"
    )
    return lookups.by_state_code(rows, lookup)


@query(
    "country_code_names",
    """select c_custkey, concat('a', c_nationkey) as country_code, n_name as country_name
    from customer left join nation on c_nationkey = n_nationkey and c_nationkey <> 7""",
)
def country_code_names(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "concat('a', c_nationkey) as country_code"
    )
    lookup = lookup_jurisdiction(spark, sf_dir).where("alpha2_code <> 'A7'")
    return lookups.country_names(rows, lookup)


def _hs_codes(spark, sf_dir):
    """Chapters from brands, headings from sizes, codes from part keys."""
    part = table(spark, sf_dir, "part")
    two = "lpad(cast(p_size as string), 2, '0')"
    four = f"concat({two}, lpad(cast(p_partkey % 10 as string), 2, '0'))"
    six = f"concat({four}, lpad(cast(p_partkey % 3 as string), 2, '0'))"
    eight = f"concat({six}, lpad(cast(p_partkey % 7 as string), 2, '0'))"
    return (
        part.where("p_size > 2").selectExpr(f"{two} as code", "concat('(Chapter) ', p_size, '.') as description")
        .union(part.selectExpr(four, f"concat('Heading ', {four})"))
        .union(part.where("p_size < 40").selectExpr(six, f"concat('Sub ', {six})"))
        .union(part.selectExpr(eight, f"concat('Item ', {eight})"))
        .distinct()
    )


_TWO = "lpad(cast(p_size as varchar), 2, '0')"
_FOUR = f"concat({_TWO}, lpad(cast(p_partkey % 10 as varchar), 2, '0'))"
_SIX = f"concat({_FOUR}, lpad(cast(p_partkey % 3 as varchar), 2, '0'))"
_EIGHT = f"concat({_SIX}, lpad(cast(p_partkey % 7 as varchar), 2, '0'))"


@query(
    "hs_hierarchy",
    f"""with p as (select *, {_TWO} as two, {_FOUR} as four, {_SIX} as six, {_EIGHT} as eight from part),
    h2 as (select distinct two, concat('Chapter ', p_size) as d2 from p where p_size > 2),
    h4 as (select distinct four, concat('Heading ', four) as d4, two, d2 from (select distinct four from p)
        join h2 on substring(four, 1, 2) = two),
    h6 as (select six, concat('Sub ', six) as d6, h4.* from (select distinct six from p
        where p_size < 40) join h4 on substring(six, 1, 4) = four),
    i8 as (select distinct eight, concat('Item ', eight) as d8 from p),
    h8 as (
        select eight, concat_ws('; ', d2, d4, d6, d8) as description, six as parent_code
            from i8 join h6 on substring(eight, 1, 6) = six
        union all
        select eight, concat_ws('; ', d2, d4, d8), four from i8 join h4 on substring(eight, 1, 4) = four
            where four not in (select four from h6)
    ), tree as (
        select two as code, d2 as description, 'hs_2' as type, null as parent_code from h2
        union all select four, concat_ws('; ', d2, d4), 'hs_4', two from h4
        union all select six, concat_ws('; ', d2, d4, d6), 'hs_6', four from h6
        union all select eight, description, 'hs_8', parent_code from h8
    )
    select md5(concat_ws(';', 'Brazil', code)) as dv_hashkey_hscode, code, description, type,
        parent_code from tree""",
)
def hs_hierarchy(spark, sf_dir):
    tree = hscodes.hierarchy(_hs_codes(spark, sf_dir), "BR", "Brazil", "tpch", LOAD_TS, VERSION)
    return tree.select("dv_hashkey_hscode", "code", "description", "type", "parent_code")


def _port_listing(spark, sf_dir):
    """Suppliers as port names: official names of low keys, aliases of the rest."""
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "concat('K', s_suppkey % 30) as port_code",
            "case when s_suppkey < 30 then 'Official' else 'Alias' end as kind",
            "s_name as port_name",
            "case when s_suppkey % 30 = 3 then 'China Taiwan (area)' "
            "else concat('NATION_', s_suppkey % 30 % 25) end as country_name",
            "cast(s_suppkey % 30 as string) as latitude",
            "cast(s_suppkey % 30 * 2 as string) as longitude",
        )
    )


def _port_lookup(spark, sf_dir):
    countries = table(spark, sf_dir, "nation").selectExpr(
        "n_name as country", "concat('C', n_nationkey) as country_code"
    )
    world = port_plans.world_ports(_port_listing(spark, sf_dir), countries)
    listed = table(spark, sf_dir, "nation").selectExpr(
        "case n_nationkey when 3 then '99900' when 4 then null else lpad(cast(n_nationkey as string), 3, '0') end as port_code",
        "case n_nationkey % 3 when 0 then concat('Dock ', n_nationkey, ', KY') "
        "when 1 then concat('Dock ', n_nationkey, ', Ohio') else 'Area Port of Ysleta' end as port_name",
    )
    everywhere = port_plans.with_unspecified(world.unionByName(port_plans.us_ports(listed), True))
    return port_plans.port_lookup(everywhere, "tpch", LOAD_TS, VERSION)


PORTS = """
listing as (
    select concat('K', s_suppkey % 30) as port_code, s_suppkey < 30 as official, s_name as port_name,
        case when s_suppkey % 30 = 3 then 'Taiwan' else concat('NATION_', s_suppkey % 30 % 25) end
            as country_name, cast(s_suppkey % 30 as varchar) as latitude,
        cast(s_suppkey % 30 * 2 as varchar) as longitude
    from supplier
), world as (
    select port_code, min(port_name) filter (where official) as port_name,
        nullif(array_to_string(list_sort(list(distinct port_name) filter (where not official)), '; '), '')
            as previous_port_name,
        min(country_name) as country_name, min(latitude) as latitude, min(longitude) as longitude
    from listing group by port_code
), us as (
    select case n_nationkey when 3 then '99900' else concat('0', lpad(cast(n_nationkey as varchar), 3, '0'))
            end as port_code,
        case n_nationkey % 3 when 0 then concat('Dock ', n_nationkey, ', KY')
            when 1 then concat('Dock ', n_nationkey, ', Ohio') else 'Area Port of Ysleta' end as port_name,
        case n_nationkey % 3 when 0 then 'Kentucky' when 1 then 'Ohio' else 'Texas' end as jurisdiction
    from nation where n_nationkey <> 4
), named as (
    select world.*, 'C' || n_nationkey as country_code, country_name as jurisdiction
        from world left join nation on country_name = n_name
    union all by name
    select port_code, port_name, jurisdiction, 'United States' as country_name, 'US' as country_code
        from us
), every as (
    select * from named
    union all by name
    select distinct jurisdiction, country_name, country_code, 'unspecified, ' || jurisdiction as port_code,
        'unspecified, ' || jurisdiction as port_name from named
), lookup_port as (
    select distinct md5(concat_ws(';', port_code, port_name)) as dv_hashkey_port, port_code, port_name,
        previous_port_name, country_name, latitude, longitude, country_code, jurisdiction
    from (select * replace (case when port_code = '99900' then 'unspecified' else port_code end as port_code,
            case when port_code = '99900' then 'unspecified' else port_name end as port_name,
            case when port_code = '99900' then 'unspecified' else country_name end as country_name,
            case when port_code = '99900' then 'unspecified' else jurisdiction end as jurisdiction)
        from every)
)"""
PORT_COLUMNS = [
    "dv_hashkey_port", "port_code", "port_name", "previous_port_name", "country_name", "latitude",
    "longitude", "country_code", "jurisdiction",
]


@query("port_lookup", f"with {PORTS} select {', '.join(PORT_COLUMNS)} from lookup_port")
def port_lookup(spark, sf_dir):
    return _port_lookup(spark, sf_dir).select(*PORT_COLUMNS)


@query(
    "port_resolution",
    f"""with {PORTS}, names as (
        select lower(trim(n)) as key, min_by(port_code, port_code || n) as port_code,
            min_by(n, port_code || n) as port_name from (
            select port_name as n, port_code from lookup_port
            union all
            select unnest(string_split(previous_port_name, '; ')), port_code from lookup_port
        ) where n is not null group by 1
    ), ship as (select l_orderkey, l_linenumber, case when l_suppkey % 4 = 0 then 'Lost port'
            else concat(' ', upper(s_name)) end as loading_port,
            case when l_suppkey % 8 = 0 then 'unspecified' else n_name end as country
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)
    select l_orderkey, l_linenumber, coalesce(names.port_name, concat('unspecified, ', country))
            as port_name_export,
        coalesce(names.port_code, case when country = 'unspecified' then 'unspecified'
            else concat('unspecified, ', country) end) as port_code_export,
        h.hash as export_port
    from ship left join names on lower(trim(loading_port)) = key
    left join (select port_code, min(dv_hashkey_port) as hash from lookup_port group by 1) h
        on h.port_code = coalesce(names.port_code, case when country = 'unspecified'
            then 'unspecified' else concat('unspecified, ', country) end)""",
)
def port_resolution(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    ship = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "l_orderkey", "l_linenumber",
            "case when l_suppkey % 4 = 0 then 'Lost port' else concat(' ', upper(s_name)) end as loading_port",
            "case when l_suppkey % 8 = 0 then 'unspecified' else n_name end as country",
        )
    )
    resolved = port_plans.resolve_ports(
        ship, _port_lookup(spark, sf_dir), {"export": ("loading_port", "country")}
    )
    return resolved.drop("loading_port", "country")


@query(
    "port_mart",
    f"""with {PORTS} select dv_hashkey_port as id, port_code, cast(len(string_split(previous_port_name,
        ';')) as integer) as n_former, trim(string_split(previous_port_name, ';')[1]) as first_former
    from lookup_port""",
)
def port_mart(spark, sf_dir):
    mart = marts.port_mart(_port_lookup(spark, sf_dir))
    return mart.select(
        "id", "port_code",
        F.when(F.col("previous_port_name").isNotNull(), F.size("previous_port_name")).alias("n_former"),
        F.trim(F.get("previous_port_name", 0)).alias("first_former"),
    )


