"""Gold marts."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import query, table
from ledgerloom.catalogue.resolution import (
    BRIDGE, GOLDEN, bridge, golden_records, satellite,
)
from ledgerloom.catalogue.samples import (
    COMPANY, HUB, LOAD_TS, PARTY, SHIPMENT, companies, parties, resolved_hub,
    shipment_links, shipments,
)
from ledgerloom.functions.keys import hash_key, hash_of
from ledgerloom.operators.joins import small_side
from ledgerloom.plans import marts
from ledgerloom.sources.staging import staged


def _lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_name as jurisdiction", "concat('C', n_nationkey) as country_code",
        "n_name as country_name", "lower(r_name) as continent", "concat('A', n_nationkey) as alpha2_code",
        "n_nationkey % 4 = 0 as is_state",
    )


PLACE = """
place as (select n_name as jurisdiction, concat('C', n_nationkey) as country_code, n_name as country_name,
    lower(r_name) as continent from nation join region on n_regionkey = r_regionkey)"""


def _addresses(spark, sf_dir, everyone):
    """Orders as addresses of the customer's company."""
    who = everyone.where("source = 'customer'")
    orders = table(spark, sf_dir, "orders")
    return orders.join(who, F.col("o_custkey") == F.col("k")).selectExpr(
        "dv_hashkey_company", "jurisdiction", "cast(substring(o_orderpriority, 1, 1) as int) as type",
        "concat('Year ', year(o_orderdate)) as full_address", "o_orderstatus as city",
    )


ADDRESS = """
address as (select dv_hashkey_company, jurisdiction, cast(substring(o_orderpriority, 1, 1) as integer) as type,
    concat('Year ', year(o_orderdate)) as full_address, o_orderstatus as city
    from orders join party on source = 'customer' and o_custkey = k)"""


def _industries(spark, sf_dir, everyone):
    """Part types as industries, and those each supplier's company ships."""
    part = table(spark, sf_dir, "part")
    types = part.select(F.col("p_type").alias("industry_code")).distinct()
    industry = types.select(
        hash_of("industry_code").alias("dv_hashkey_industry"), "industry_code",
        F.lower("industry_code").alias("desc"),
    )
    line = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    who = everyone.where("source = 'supplier'")
    links = (
        line.select("l_suppkey", "p_type").distinct()
        .join(who, F.col("l_suppkey") == F.col("k"))
        .select(
            "dv_hashkey_company", "jurisdiction", hash_of("p_type").alias("dv_hashkey_industry"),
            (F.length("p_type") % 2).alias("type"),
        ).distinct()
    )
    return industry, links


def _sanctions(spark, sf_dir, everyone):
    """Companies with a negative balance are sanctioned."""
    rows = companies(spark, sf_dir)
    poor = rows.where("balance < 0").select("source", "k")
    return everyone.join(poor, ["source", "k"]).select(
        hash_of("source", "k").alias("dv_hashkey_sanction"), "dv_hashkey_company", "source", "k"
    )


SANCTION = """
sanction as (select md5(concat_ws(';', p.source, p.k)) as dv_hashkey_sanction, p.dv_hashkey_company,
    p.source, p.k from party p join company c using (source, k) where c.balance < 0)"""
MOVES = """
moves as (select from_key, min(to_key) as to_key from bridge where from_key <> to_key group by 1)"""


@query(
    "entity_company_doc",
    f"""with {GOLDEN},{PARTY},{ADDRESS},{SANCTION},{PLACE},{MOVES},
    addr as (select coalesce(m.to_key, a.dv_hashkey_company) as id, jurisdiction,
            array_to_string(list_sort(list(concat_ws('|', type, full_address, city))), ';') as addresses
        from address a left join moves m on m.from_key = a.dv_hashkey_company group by all),
    sanctioned as (select distinct coalesce(m.to_key, s.dv_hashkey_company) as id
        from sanction s left join moves m on m.from_key = s.dv_hashkey_company),
    industry as (select id, jurisdiction, array_to_string(list_sort(list(concat_ws('|', t, p_type,
            lower(p_type)))), ';') as industries from (
        select coalesce(m.to_key, p.dv_hashkey_company) as id, p.jurisdiction, p_type,
            cast(length(p_type) % 2 as integer) as t
        from (select distinct p.dv_hashkey_company, p.jurisdiction, p_type from lineitem
            join part on l_partkey = p_partkey join party p on p.source = 'supplier' and p.k = l_suppkey) p
        left join moves m on m.from_key = p.dv_hashkey_company) group by all)
    select h.dv_hashkey_company as id, cast(0 as integer) as part, s.id is not null as is_sanctioned, h.name,
        p.continent, h.registration_number, h.jurisdiction, g.legal_form, a.addresses,
        g.status as statuses, i.industries, g.is_branch
    from hub h
    left join golden g using (jurisdiction, dv_hashkey_company)
    left join place p using (jurisdiction)
    left join addr a on a.id = h.dv_hashkey_company and a.jurisdiction = h.jurisdiction
    left join industry i on i.id = h.dv_hashkey_company and i.jurisdiction = h.jurisdiction
    left join sanctioned s on s.id = h.dv_hashkey_company
    where h.dv_hashkey_company not in (select from_key from moves)""",
)
def entity_company_doc(spark, sf_dir):
    documents = _company_documents(spark, sf_dir)
    line = lambda *fields: lambda x: F.concat_ws("|", *[x[f].cast("string") for f in fields])
    shown = lambda column, *fields: F.array_join(
        F.array_sort(F.transform(column, line(*fields))), ";"
    )
    return documents.select(
        "id", "part", F.coalesce("is_sanctioned", F.lit(False)).alias("is_sanctioned"), "name",
        "continent", "registration_number", "jurisdiction", "legal_form",
        shown("addresses", "type", "full_address", "city").alias("addresses"),
        F.array_join(F.transform("statuses", lambda x: x["status"]), ";").alias("statuses"),
        shown("industries", "type", "industry_code", "desc").alias("industries"),
        F.col("company.is_branch").cast("boolean").alias("is_branch"),
    )


def _company_documents(spark, sf_dir, parts=1):
    keys = bridge(spark, sf_dir)
    everyone = parties(spark, sf_dir)
    industry, links = _industries(spark, sf_dir, everyone)
    return marts.company_documents(
        resolved_hub(spark, sf_dir), keys,
        golden_records(spark, sf_dir).drop("category"),
        _addresses(spark, sf_dir, everyone), _sanctions(spark, sf_dir, everyone), industry, links,
        _lookup(spark, sf_dir), parts,
    )


@query(
    "entity_company_parts",
    f"""with {GOLDEN},{PARTY},{ADDRESS},{MOVES},
    alive as (select dv_hashkey_company as id, jurisdiction from hub
        where dv_hashkey_company not in (select from_key from moves)),
    rows as (
        select coalesce(m.to_key, a.dv_hashkey_company) as id, jurisdiction, 'address' as kind,
            concat_ws('|', type, full_address, city) as line
        from address a left join moves m on m.from_key = a.dv_hashkey_company
        union all
        select coalesce(m.to_key, p.dv_hashkey_company), p.jurisdiction, 'industry',
            concat_ws('|', cast(length(p_type) % 2 as integer), p_type, lower(p_type))
        from (select distinct p.dv_hashkey_company, p.jurisdiction, p_type from lineitem
            join part on l_partkey = p_partkey join party p on p.source = 'supplier' and p.k = l_suppkey) p
        left join moves m on m.from_key = p.dv_hashkey_company
    )
    select id, jurisdiction, kind, line, count(*) as copies, true as shared from rows join alive using (id, jurisdiction)
    group by all""",
)
def entity_company_parts(spark, sf_dir):
    """G1 in four parts a company: the nested rows of all its parts, none of which holds more than its share."""
    documents = _company_documents(spark, sf_dir, 4)
    line = lambda x, *fields: F.concat_ws("|", *[x[f].cast("string") for f in fields])
    rows = None
    for kind, column, fields in (("address", "addresses", ["type", "full_address", "city"]),
                                 ("industry", "industries", ["type", "industry_code", "desc"])):
        own = documents.select("id", "jurisdiction", "part", F.explode(column).alias("x"))
        own = own.select("id", "jurisdiction", "part", F.lit(kind).alias("kind"), line(F.col("x"), *fields).alias("line"))
        rows = own if rows is None else rows.unionByName(own)
    # copies of a row are dealt to the parts in turn, so no part has two more of them than another
    dealt = rows.groupBy("id", "jurisdiction", "kind", "line", "part").agg(F.count(F.lit(1)).alias("n"))
    return dealt.groupBy("id", "jurisdiction", "kind", "line").agg(
        F.sum("n").alias("copies"), (F.max("n") <= F.ceil(F.sum("n") / 4)).alias("shared")
    )


def _persons(spark, sf_dir):
    """Event users as persons, living in a nation."""
    nation = table(spark, sf_dir, "nation")
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("event_type").alias("skills")
    )
    return users.join(nation, F.col("user_id") % 25 == F.col("n_nationkey")).selectExpr(
        "user_id", "concat('User ', user_id) as name", "n_name as jurisdiction",
        "concat('Street ', user_id) as full_address", "skills", "concat('Born ', n) as birthplace",
    ).withColumn("dv_hashkey_person", hash_key("person"))


PERSON = """
person as (select *, md5(concat_ws(';', jurisdiction, name, full_address)) as dv_hashkey_person from (
    select user_id, concat('User ', user_id) as name, n_name as jurisdiction,
        concat('Street ', user_id) as full_address, max(event_type) as skills,
        concat('Born ', count(*)) as birthplace
    from events join nation on user_id % 25 = n_nationkey group by all))"""


def _person_addresses(spark, sf_dir):
    people = _persons(spark, sf_dir).select("user_id", "dv_hashkey_person", "jurisdiction")
    return table(spark, sf_dir, "events").join(people, "user_id").selectExpr(
        "dv_hashkey_person", "jurisdiction", "event_type as full_address", "cast(1 as int) as type"
    )


def person_documents(spark, sf_dir):
    people = _persons(spark, sf_dir)
    hub_rows = people.select("dv_hashkey_person", "jurisdiction", "name")
    return marts.person_documents(
        hub_rows, people.select("dv_hashkey_person", "jurisdiction", "skills", "birthplace"),
        _person_addresses(spark, sf_dir),
        people.where("jurisdiction like '%1'").select("dv_hashkey_person"),
        _lookup(spark, sf_dir),
    )


@query(
    "entity_person_doc",
    f"""with {PERSON},{PLACE}, a as (select user_id, array_to_string(list_sort(list(event_type)), ';')
        as addresses from events group by 1)
    select dv_hashkey_person as id, jurisdiction like '%1' as is_sanctioned, name, continent, jurisdiction,
        addresses, skills, birthplace
    from person join a using (user_id) join place using (jurisdiction)""",
)
def entity_person_doc(spark, sf_dir):
    return person_documents(spark, sf_dir).select(
        "id", F.coalesce("is_sanctioned", F.lit(False)).alias("is_sanctioned"), "name", "continent",
        "jurisdiction",
        F.array_join(F.transform("addresses", lambda x: x["full_address"]), ";").alias("addresses"),
        F.col("person.skills").alias("skills"), F.col("person.birthplace").alias("birthplace"),
    )


def _entities(spark, sf_dir):
    """Slim entity rows of companies and persons."""
    company = resolved_hub(spark, sf_dir).dropDuplicates(["dv_hashkey_company"]).selectExpr(
        "dv_hashkey_company as id", "name", "jurisdiction"
    )
    person = _persons(spark, sf_dir).selectExpr("dv_hashkey_person as id", "name", "jurisdiction")
    place = _lookup(spark, sf_dir).select("jurisdiction", "continent")
    return company.join(place, "jurisdiction"), person.join(place, "jurisdiction")


def _company_links(spark, sf_dir):
    """A supplier's company ships to a customer's company."""
    who = parties(spark, sf_dir)
    company = ["dv_hashkey_company", "jurisdiction"]
    # of all line items only the numbers of two companies are shuffled
    numbers = staged(who.select(*company).distinct().withColumn("number", F.monotonically_increasing_id()), "numbers")
    number = lambda source, side: who.where(F.col("source") == source).join(
        small_side(numbers), [who[c].eqNullSafe(numbers[c]) for c in company]
    ).select(F.col("k").alias(f"{side}_k"), F.col("number").alias(side))
    end = lambda side: numbers.select(
        F.col("number").alias(side), F.col("dv_hashkey_company").alias(f"dv_hashkey_{side}_company"),
        F.col("jurisdiction").alias(f"{side}_jurisdiction"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orders = orders.join(number("customer", "to"), F.col("o_custkey") == F.col("to_k")).select("o_orderkey", "to")
    pairs = (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
        .join(small_side(number("supplier", "from")), F.col("l_suppkey") == F.col("from_k"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("from", "to").distinct()
    )
    return (
        pairs.join(small_side(end("from")), "from").join(small_side(end("to")), "to")
        .withColumn("position", F.lit("Supplier"))
        .select(
            hash_key("l_company_company_position").alias("dv_hashkey_l_company_company_relationship"),
            "dv_hashkey_from_company", "dv_hashkey_to_company", "from_jurisdiction", "to_jurisdiction",
            "position",
        )
    )


COMPANY_LINK = """
company_link as (select distinct md5(concat_ws(';', f.dv_hashkey_company, t.dv_hashkey_company, 'Supplier'))
        as id, f.dv_hashkey_company as from_key, t.dv_hashkey_company as to_key,
        f.jurisdiction as from_jurisdiction, t.jurisdiction as to_jurisdiction
    from lineitem join orders on l_orderkey = o_orderkey
    join party f on f.source = 'supplier' and f.k = l_suppkey
    join party t on t.source = 'customer' and t.k = o_custkey)"""


def company_edges(spark, sf_dir, keys):
    company, _ = _entities(spark, sf_dir)
    links = marts.edge_links(
        _company_links(spark, sf_dir), "dv_hashkey_l_company_company_relationship",
        "dv_hashkey_from_company", "dv_hashkey_to_company", keys,
        ["dv_hashkey_from_company", "dv_hashkey_to_company"],
    )
    return marts.entity_edges(links, company, company)


EDGE = """
pointed as (select id, coalesce(f.to_key, l.from_key) as from_entity_id,
        coalesce(t.to_key, l.to_key) as to_entity_id, from_jurisdiction, to_jurisdiction
    from company_link l left join moves f on f.from_key = l.from_key
    left join moves t on t.from_key = l.to_key),
entity as (select dv_hashkey_company as id, name, jurisdiction, continent
    from (select distinct on (dv_hashkey_company) dv_hashkey_company, name, jurisdiction from hub)
    join place using (jurisdiction)),
company_edge as (select l.*, f.name as from_name, t.name as to_name, case when f.continent = t.continent
        then f.continent else 'diff_jurisdiction' end as continent
    from pointed l join entity f on f.id = from_entity_id and f.jurisdiction = from_jurisdiction
    join entity t on t.id = to_entity_id and t.jurisdiction = to_jurisdiction)"""


@query("entity_edges", f"with {BRIDGE},{PARTY},{COMPANY_LINK},{PLACE},{MOVES},{EDGE} select * from company_edge")
def entity_edges(spark, sf_dir):
    return company_edges(spark, sf_dir, bridge(spark, sf_dir)).select(
        "id", "from_entity_id", "to_entity_id", "from_jurisdiction", "to_jurisdiction",
        F.col("from_entity.name").alias("from_name"), F.col("to_entity.name").alias("to_name"),
        "continent",
    )


def _user_company_links(spark, sf_dir):
    """Users hold a position at the customer company of their number."""
    people = _persons(spark, sf_dir).selectExpr(
        "user_id", "dv_hashkey_person", "jurisdiction as from_jurisdiction"
    )
    who = parties(spark, sf_dir).where("source = 'customer'").selectExpr(
        "k", "dv_hashkey_company", "jurisdiction as to_jurisdiction"
    )
    return (
        table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
        .join(people, "user_id").join(who, F.col("user_id") == F.col("k"))
        .withColumnRenamed("event_type", "position")
        .select(
            hash_key("l_person_company_position").alias("dv_hashkey_l_person_company_relationship"),
            "dv_hashkey_person", "dv_hashkey_company", "from_jurisdiction", "to_jurisdiction", "position",
        )
    )


def _user_links(spark, sf_dir):
    """Each user is related to the next."""
    people = _persons(spark, sf_dir).select("user_id", "dv_hashkey_person", "jurisdiction")
    end = lambda side: people.select(
        F.col("user_id").alias(f"{side}_user"), F.col("dv_hashkey_person").alias(f"dv_hashkey_{side}_person"),
        F.col("jurisdiction").alias(f"{side}_jurisdiction"),
    )
    return end("from").join(end("to"), F.col("from_user") + 1 == F.col("to_user")).withColumn(
        "related_type", F.lit("next")
    ).withColumn("dv_hashkey_l_person_person_relationship", hash_key("l_person_person_related"))


@query(
    "edge_union",
    f"""with {BRIDGE},{PARTY},{COMPANY_LINK},{PLACE},{MOVES},{EDGE},{PERSON},
    pc as (select distinct md5(concat_ws(';', dv_hashkey_person, p.dv_hashkey_company, event_type)) as id,
            dv_hashkey_person, coalesce(m.to_key, p.dv_hashkey_company) as company,
            person.jurisdiction as pj, p.jurisdiction as cj
        from events join person using (user_id) join party p on p.source = 'customer' and p.k = user_id
        left join moves m on m.from_key = p.dv_hashkey_company)
    select id, 'company_company' as kind, continent from company_edge
    union all
    select pc.id, 'person_company', case when a.continent = e.continent then a.continent
        else 'diff_jurisdiction' end
    from pc join place a on a.jurisdiction = pj join entity e on e.id = company and e.jurisdiction = cj
    union all
    select md5(concat_ws(';', a.dv_hashkey_person, b.dv_hashkey_person, 'next')), 'person_person',
        case when x.continent = y.continent then x.continent else 'diff_jurisdiction' end
    from person a join person b on a.user_id + 1 = b.user_id
    join place x on x.jurisdiction = a.jurisdiction join place y on y.jurisdiction = b.jurisdiction""",
)
def edge_union(spark, sf_dir):
    """Edges of all three kinds in one table."""
    company, person = _entities(spark, sf_dir)
    keys = bridge(spark, sf_dir)
    person_company = marts.entity_edges(
        marts.edge_links(
            _user_company_links(spark, sf_dir), "dv_hashkey_l_person_company_relationship",
            "dv_hashkey_person", "dv_hashkey_company", keys, ["dv_hashkey_company"],
        ),
        person, company,
    )
    person_person = marts.entity_edges(
        marts.edge_links(
            _user_links(spark, sf_dir), "dv_hashkey_l_person_person_relationship",
            "dv_hashkey_from_person", "dv_hashkey_to_person",
        ),
        person, person,
    )
    named = [
        edges.select("id", F.lit(kind).alias("kind"), "continent")
        for kind, edges in [
            ("company_company", company_edges(spark, sf_dir, keys)),
            ("person_company", person_company), ("person_person", person_person),
        ]
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "entity_structs",
    f"""with {HUB},{PLACE} select dv_hashkey_company as id, jurisdiction, continent,
        concat_ws('|', dv_hashkey_company, name, jurisdiction) as entity
    from (select distinct on (dv_hashkey_company) * from hub) join place using (jurisdiction)""",
)
def entity_structs(spark, sf_dir):
    company, _ = _entities(spark, sf_dir)
    packed = marts.entity_structs(company)
    return packed.withColumn(
        "entity", F.concat_ws("|", "entity.id", "entity.name", "entity.jurisdiction")
    )


@query(
    "address_mart",
    f"""with {BRIDGE},{PARTY},{ADDRESS},{MOVES},{PERSON}, rows as (
        select coalesce(m.to_key, a.dv_hashkey_company) as id, full_address, city from address a
            left join moves m on m.from_key = a.dv_hashkey_company
        union all
        select dv_hashkey_person, event_type, null from events join person using (user_id))
    select * from rows qualify row_number() over (partition by id order by full_address,
        city nulls last) = 1""",
)
def address_mart(spark, sf_dir):
    return marts.address_mart(
        _addresses(spark, sf_dir, parties(spark, sf_dir)), _person_addresses(spark, sf_dir),
        bridge(spark, sf_dir),
    )


@query(
    "industry_marts",
    """select md5(p_type) as id, p_type as industry_code, lower(p_type) as "desc" from part group by p_type""",
)
def industry_marts(spark, sf_dir):
    return marts.industry_mart(_industries(spark, sf_dir, parties(spark, sf_dir))[0])


@query(
    "company_industry_mart",
    f"""with {COMPANY},{PARTY} select distinct md5(concat_ws(';', p.dv_hashkey_company, md5(p_type))) as id,
        p.dv_hashkey_company as entity_id, md5(p_type) as industry_id
    from lineitem join part on l_partkey = p_partkey join party p on p.source = 'supplier' and p.k = l_suppkey""",
)
def company_industry_mart(spark, sf_dir):
    links = _industries(spark, sf_dir, parties(spark, sf_dir))[1].select(
        hash_of("dv_hashkey_company", "dv_hashkey_industry").alias("dv_hashkey_l_company_industry"),
        "dv_hashkey_company", "dv_hashkey_industry",
    )
    return marts.company_industry_mart(links)


@query(
    "company_detail_mart",
    f"""with {GOLDEN} select dv_hashkey_company as id, jurisdiction, name, balance,
        '{LOAD_TS}' as created_at, '{LOAD_TS}' as updated_at from golden""",
)
def company_detail_mart(spark, sf_dir):
    records = golden_records(spark, sf_dir)
    mart = marts.company_detail_mart(records, LOAD_TS)
    return mart.select(
        "id", "jurisdiction", "name", "balance", F.col("created_at").cast("string").alias("created_at"),
        F.col("updated_at").cast("string").alias("updated_at"),
    )


@query(
    "status_mart",
    f"""with {GOLDEN} select distinct md5(dv_hashkey_company || md5(status)) as id,
        md5(status) as status_id, dv_hashkey_company as entity_id, status from sat_rows""",
)
def status_mart(spark, sf_dir):
    rows = satellite(spark, sf_dir).withColumn("status_desc", F.lit(None).cast("string"))
    return marts.status_mart(rows, LOAD_TS).select("id", "status_id", "entity_id", "status")


@query(
    "provenance_mart",
    f"""with {HUB} select md5(concat_ws(';', dv_hashkey_company, dv_recsrc)) as id, dv_recsrc,
        dv_source_version, dv_hashkey_company as entity_id, 'tpch' as data_source,
        substring(dv_recsrc, 6) as link from hub""",
)
def provenance_mart(spark, sf_dir):
    rows = resolved_hub(spark, sf_dir)
    return marts.provenance_mart(rows).drop("dv_loaddts")


@query(
    "sanction_mart",
    f"""with {COMPANY},{PARTY},{SANCTION},{PERSON}, s as (
        select dv_hashkey_sanction, concat('S', k) as id, source as program, dv_hashkey_company as entity_id
            from sanction
        union all
        select md5(concat_ws(';', 'user', user_id)), concat('U', user_id), 'user', dv_hashkey_person
            from person where jurisdiction like '%1')
    select id, entity_id, program from s""",
)
def sanction_mart(spark, sf_dir):
    company = _sanctions(spark, sf_dir, parties(spark, sf_dir))
    person = _persons(spark, sf_dir).where("jurisdiction like '%1'").withColumn(
        "dv_hashkey_sanction", hash_of(F.lit("user"), "user_id")
    )
    details = company.selectExpr(
        "dv_hashkey_sanction", "concat('S', k) as sanction_id", "source as program"
    ).union(person.selectExpr("dv_hashkey_sanction", "concat('U', user_id)", "'user'"))
    return marts.sanction_mart(details, company, person)


FLAGS = """
marks as (
    select buyer_dv_hashkey_company as key, 'buyer' as type from l_bol
    union select supplier_dv_hashkey_company, 'supplier' from l_bol
    union select dv_hashkey_company, 'sanction' from sanction
), member as (
    select jurisdiction, to_key, from_key as key from bridge
    union select jurisdiction, to_key, to_key from bridge
), flags as (
    select jurisdiction, to_key, bool_or(type = 'buyer') as is_trade_buyer,
        bool_or(type = 'supplier') as is_trade_supplier, bool_or(type = 'sanction') as is_sanction
    from member left join marks using (key) group by all
)"""


def _merge_ctes(*texts):
    """Concatenate CTE lists, each named query once."""
    import re

    seen, parts = set(), []
    for text in texts:
        for piece in re.split(r",\s*(?=\w+ as \((?:\n|select))", text.strip().strip(",")):
            name = piece.strip().split(" ", 1)[0]
            if name not in seen:
                seen.add(name)
                parts.append(piece.strip())
    return ",\n".join(parts)


TRADE = _merge_ctes(GOLDEN, SHIPMENT, SANCTION, FLAGS, MOVES)


def _flags(spark, sf_dir, keys):
    everyone = parties(spark, sf_dir)
    return marts.trade_flags(shipment_links(spark, sf_dir), _sanctions(spark, sf_dir, everyone), keys)


@query("trade_flags", f"with {TRADE} select * from flags")
def trade_flags(spark, sf_dir):
    return _flags(spark, sf_dir, bridge(spark, sf_dir))


@query(
    "trade_entity",
    f"""with {TRADE} select g.dv_hashkey_company as id, g.name, coalesce(g.jurisdiction, 'unspecified')
            as jurisdiction, coalesce(n_name, 'unspecified') as country_name,
        coalesce('A' || n_nationkey, 'unspecified') as country_code, false as is_person,
        coalesce(is_trade_buyer or is_trade_supplier, false) as is_trade,
        coalesce(is_sanction, false) as is_sanction
    from golden g left join flags f on f.jurisdiction = g.jurisdiction and f.to_key = g.dv_hashkey_company
    left join nation on g.jurisdiction = n_name""",
)
def trade_entity(spark, sf_dir):
    """Nations before F are written as states, ``US.BRAZIL``, and shown by their name."""
    state = F.col("jurisdiction") < "F"
    stated = lambda df: df.withColumn(
        "jurisdiction", F.when(state, F.concat(F.lit("US."), "jurisdiction")).otherwise(F.col("jurisdiction"))
    )
    lookup = _lookup(spark, sf_dir).withColumn("is_state", state)
    entities = marts.trade_entities(
        stated(golden_records(spark, sf_dir)), stated(_flags(spark, sf_dir, bridge(spark, sf_dir))), stated(lookup), LOAD_TS
    )
    return entities.select(
        "id", "name", "jurisdiction", "country_name", "country_code", "is_person", "is_trade", "is_sanction"
    )


@query(
    "trade_transaction",
    f"""with {TRADE}, codes as (select distinct lpad(cast(p_partkey as varchar), 8, '0') as code from part
        where p_size > 10)
    select l.dv_hashkey_bol as id, s.bol, value_usd, cast(year(s.actual_arrival_date) as integer) as yyyy,
        cast(year(s.actual_arrival_date) * 100 + month(s.actual_arrival_date) as integer) as yyyymm,
        cast(year(s.actual_arrival_date) * 10000 + month(s.actual_arrival_date) * 100
            + day(s.actual_arrival_date) as integer) as yyyymmdd,
        coalesce(b.to_key, buyer_dv_hashkey_company) as buyer_id,
        coalesce(p.to_key, supplier_dv_hashkey_company) as supplier_id,
        coalesce(p.to_key, supplier_dv_hashkey_company) as shipper_id,
        coalesce(code, 'dummy') as hs_code_ref, import_port, export_port,
        '{LOAD_TS}' as dv_loaddts, '{LOAD_TS}' as created_at, '{LOAD_TS}' as updated_at
    from hashed_ship s join (select distinct * from l_bol) l on s.dv_hashkey_bol = l.dv_hashkey_bol
    left join moves b on b.from_key = buyer_dv_hashkey_company
    left join moves p on p.from_key = supplier_dv_hashkey_company
    left join codes on hs_code = code
    where buyer_dv_hashkey_company is not null and supplier_dv_hashkey_company is not null""",
)
def trade_transaction(spark, sf_dir):
    rows = shipments(spark, sf_dir).withColumn("dv_hashkey_bol", hash_key("bol"))
    codes = table(spark, sf_dir, "part").where("p_size > 10").selectExpr(
        "lpad(cast(p_partkey as string), 8, '0') as code"
    )
    # the link's own hash follows from the rest; dealt by shipment, links are made distinct and joined in one shuffle
    links = shipment_links(spark, sf_dir).drop("dv_hashkey_l_bol", "dv_recsrc", "dv_source_version", "dv_loaddts")
    links = links.repartition("dv_hashkey_bol").distinct()
    fact = marts.trade_transactions(rows, links, bridge(spark, sf_dir), codes, LOAD_TS)
    return fact.select(
        "id", "bol", "value_usd", "yyyy", "yyyymm", "yyyymmdd", "buyer_id", "supplier_id", "shipper_id",
        "hs_code_ref", "import_port", "export_port",
        *[F.col(c).cast("string").alias(c) for c in ("dv_loaddts", "created_at", "updated_at")],
    )
