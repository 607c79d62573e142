"""Gold marts: entity documents, edges, attribute marts, trade facts."""

from pyspark.sql import functions as F

from ledgerloom.functions.dates import date_keys
from ledgerloom.functions.text import split_provenance
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.joins import anti, small_side
from ledgerloom.operators.lookups import one_per_jurisdiction
from ledgerloom.operators.nesting import attach_nested, nest, struct_of_firsts
from ledgerloom.plans.golden import repoint

# Fields of the nested structs and output columns.
ADDRESS_FIELDS = [
    "type", "start_date", "end_date", "full_address", "street", "city", "region", "state", "province",
    "country_code", "postal_code", "latitude", "longitude",
]
INDUSTRY_FIELDS = ["type", "industry_code", "desc", "country_code", "standard_type"]
STATUS_FIELDS = ["status", "status_code", "status_desc"]
COMPANY_FIELDS = [
    "image_url", "no_of_employees", "authorised_capital", "paid_up_capital", "currency_code",
    "is_branch",
]
PERSON_FIELDS = [
    "first_name", "last_name", "middle_name", "full_name", "image_url", "dob", "birthplace",
    "nationality", "country_of_residence", "accuracy_level", "gender", "skills", "job_summary",
    "salary", "yoe", "industry",
]
PLACE = ["country_code", "country_name", "continent"]
TYPES = {
    "start_date": "timestamp", "end_date": "timestamp", "authorised_capital": "float", "paid_up_capital": "float",
}
DOCUMENT_KEY = ["id", "part"]


def _with(df, names):
    """The frame with typed nulls for columns that a source does not have, and the types of ``TYPES``."""
    absent = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    df = df.withColumns(absent) if absent else df
    typed = {n: F.col(n).cast(TYPES[n]) for n in names if n in TYPES}
    return df.withColumns(typed) if typed else df


def _unique(df, keys):
    return first_per_key(df, keys)


def company_documents(
    hub, bridge, demographic, address, sanctions, industries, industry_links, lookup, parts=1
):
    """G1: one nested document per surviving company.

    Companies that were merged into another are left out and what refers to
    them is re-pointed. ``demographic`` is the golden record. Each company
    has ``parts`` rows, which share its nested rows; the key is ``DOCUMENT_KEY``.
    """
    keys = ["dv_hashkey_company", "jurisdiction"]
    merged = bridge.where("from_key is not null and from_key <> to_key").select(
        F.col("from_key").alias("dv_hashkey_company")
    )
    companies = _unique(anti(hub, merged, ["dv_hashkey_company"], null_safe=False), keys)
    facts = _unique(demographic, keys)
    addresses = _with(repoint(address, bridge, "dv_hashkey_company"), ADDRESS_FIELDS)
    sanctioned = (
        repoint(sanctions, bridge, "dv_hashkey_company")
        .select("dv_hashkey_company")
        .distinct()
        .withColumn("is_sanctioned", F.lit(True))
    )
    linked = repoint(industry_links, bridge, "dv_hashkey_company").join(
        industries, "dv_hashkey_industry"
    )
    nested = [
        nest(addresses, keys, ADDRESS_FIELDS, "addresses", parts),
        nest(_with(demographic, STATUS_FIELDS), keys, STATUS_FIELDS, "statuses", parts),
        nest(_with(linked, INDUSTRY_FIELDS), keys, INDUSTRY_FIELDS, "industries", parts),
    ]
    details = struct_of_firsts(
        _with(demographic, COMPANY_FIELDS), keys, COMPANY_FIELDS,
        [F.col(k) for k in keys], "company",
    )
    used = {*keys, *companies.columns, *STATUS_FIELDS, *COMPANY_FIELDS}
    attributes = [c for c in facts.columns if c not in used and not c.startswith("dv_")]
    spine = (
        companies.join(facts.select(*keys, *attributes), keys, "left")
        .join(details, keys, "left")
        .join(sanctioned, "dv_hashkey_company", "left")
        .join(small_side(one_per_jurisdiction(lookup, PLACE)), "jurisdiction", "left")
    )
    return attach_nested(spine, keys, nested, parts).select(
        F.col("dv_hashkey_company").alias("id"),
        "part",
        *[c for c in companies.columns if c.startswith("dv_") and c not in keys],
        F.lit(False).alias("is_person"),
        "is_sanctioned",
        "name",
        *PLACE,
        "registration_number",
        "jurisdiction",
        *attributes,
        "addresses",
        "statuses",
        "industries",
        "company",
    )


def person_documents(hub, demographic, address, sanctions, lookup, parts=1):
    """One nested document per person, in ``parts`` rows; the key is ``DOCUMENT_KEY``."""
    keys = ["dv_hashkey_person", "jurisdiction"]
    facts = _unique(demographic, keys)
    if "name" in facts.columns and "full_name" not in facts.columns:
        facts = facts.withColumnRenamed("name", "full_name")
    facts = _with(facts, PERSON_FIELDS)
    details = struct_of_firsts(facts, keys, PERSON_FIELDS, [F.col(k) for k in keys], "person")
    sanctioned = (
        sanctions.select("dv_hashkey_person").distinct().withColumn("is_sanctioned", F.lit(True))
    )
    used = {*keys, *hub.columns, *PERSON_FIELDS}
    attributes = [c for c in facts.columns if c not in used and not c.startswith("dv_")]
    spine = (
        _unique(hub, keys)
        .join(facts.select(*keys, *attributes), keys, "left")
        .join(details, keys, "left")
        .join(sanctioned, "dv_hashkey_person", "left")
        .join(small_side(one_per_jurisdiction(lookup, PLACE)), "jurisdiction", "left")
    )
    nested = [nest(_with(address, ADDRESS_FIELDS), keys, ADDRESS_FIELDS, "addresses", parts)]
    return attach_nested(spine, keys, nested, parts).select(
        F.col("dv_hashkey_person").alias("id"),
        "part",
        *[c for c in hub.columns if c.startswith("dv_") and c not in keys],
        F.lit(True).alias("is_person"),
        "is_sanctioned",
        "name",
        *PLACE,
        "jurisdiction",
        *attributes,
        "addresses",
        "person",
    )


def entity_edges(links, from_entities, to_entities):
    """Links with both endpoints as structs; of documents in parts the first.

    The continent of an edge is that of its ends when they share one, else
    ``diff_jurisdiction``. An edge whose end is unknown or nameless is dropped.
    """
    def end(entities, side):
        if "part" in entities.columns:
            entities = entities.where("part = 0")
        payload = [c for c in entities.columns if c != "continent"]
        return entities.where("name is not null").select(
            F.col("id").alias(f"__{side}_id"),
            F.col("jurisdiction").alias(f"__{side}_jurisdiction"),
            F.col("continent").alias(f"__{side}_continent"),
            F.struct(*payload).alias(f"{side}_entity"),
        )

    joined = links
    for side, entities in (("to", to_entities), ("from", from_entities)):
        joined = joined.join(
            end(entities, side),
            (F.col(f"{side}_entity_id") == F.col(f"__{side}_id"))
            & (F.col(f"{side}_jurisdiction") == F.col(f"__{side}_jurisdiction")),
        )
    same = F.col("__to_continent") == F.col("__from_continent")
    return joined.select(
        *links.columns,
        "to_entity",
        "from_entity",
        F.when(same, F.col("__from_continent")).otherwise("diff_jurisdiction").alias("continent"),
    )


def edge_links(links, link_id, from_key, to_key, bridge=None, company_keys=()):
    """Relationship rows in edge form, company ends re-pointed."""
    if bridge is not None and company_keys:
        links = repoint(links, bridge, list(company_keys))
    return links.withColumnsRenamed(
        {link_id: "id", from_key: "from_entity_id", to_key: "to_entity_id"}
    )


def entity_structs(entities, group="continent"):
    """Whole rows as a struct beside id, jurisdiction and continent."""
    payload = [c for c in entities.columns if c != group]
    return entities.select("id", "jurisdiction", F.struct(*payload).alias("entity"), group)


def address_mart(company_address, person_address, bridge, where=None):
    """One address row per entity, companies re-pointed."""
    if where:
        company_address, person_address = company_address.where(where), person_address.where(where)
    company = repoint(company_address, bridge, "dv_hashkey_company").withColumnRenamed(
        "dv_hashkey_company", "id"
    )
    person = person_address.withColumnRenamed("dv_hashkey_person", "id")
    both = company.unionByName(person, allowMissingColumns=True).drop(
        "jurisdiction", "registration_number", "name", "pure_name", "country_name", "type"
    )
    return first_per_key(both, ["id"])


def industry_mart(industries):
    """Industries under their public id."""
    return industries.withColumnRenamed("dv_hashkey_industry", "id")


def company_industry_mart(links):
    """Company industries under their public ids."""
    return links.withColumnsRenamed(
        {
            "dv_hashkey_l_company_industry": "id",
            "dv_hashkey_company": "entity_id",
            "dv_hashkey_industry": "industry_id",
        }
    )


def company_detail_mart(demographic, stamp=None):
    """Company details with creation and update time."""
    now = F.current_timestamp() if stamp is None else F.lit(stamp).cast("timestamp")
    return demographic.withColumnRenamed("dv_hashkey_company", "id").withColumns(
        {"created_at": now, "updated_at": now}
    )


def status_mart(demographic, stamp=None):
    """One row per company and status; a company without status has none."""
    now = F.current_timestamp() if stamp is None else F.lit(stamp).cast("timestamp")
    status_id = F.md5(F.concat("status", F.coalesce("status_desc", F.lit(""))))
    rows = (
        demographic.withColumn("status_id", status_id)
        .withColumnRenamed("dv_hashkey_company", "entity_id")
        .withColumn("id", F.md5(F.concat("entity_id", "status_id")))
        .where("id is not null")
    )
    return first_per_key(rows, ["id"]).withColumns({"created_at": now, "updated_at": now})


def provenance_mart(demographic):
    """Source name and link of every company."""
    source = split_provenance("dv_recsrc")
    return demographic.select(
        F.md5(F.concat_ws(";", "dv_hashkey_company", "dv_recsrc")).alias("id"),
        "dv_recsrc",
        "dv_loaddts",
        "dv_source_version",
        F.col("dv_hashkey_company").alias("entity_id"),
        source["data_source"].alias("data_source"),
        source["link"].alias("link"),
    ).where("data_source <> ''")


def sanction_mart(sanctions, company_links, person_links):
    """Sanctions of companies and persons."""
    links = company_links.select(
        "dv_hashkey_sanction", F.col("dv_hashkey_company").alias("entity_id")
    ).union(
        person_links.select("dv_hashkey_sanction", F.col("dv_hashkey_person").alias("entity_id"))
    )
    details = [
        c
        for c in ("dv_recsrc", "dv_source_version", "dv_loaddts", "country", "authority",
                  "program", "reason", "start_date", "end_date", "source_link")
        if c in sanctions.columns
    ]
    return sanctions.join(links, "dv_hashkey_sanction").select(
        F.col("sanction_id").alias("id"), "entity_id", *details
    )


def trade_flags(shipment_links, sanction_links, bridge):
    """Whether a surviving company bought, sold or is sanctioned.

    Flags are folded to one row per company before they meet the bridge, so
    the shipments of one trader never travel together.
    """
    names = ["is_trade_buyer", "is_trade_supplier", "is_sanction"]

    def mark(column, flag):
        return F.struct(F.col(column).alias("company_key"), *[F.lit(n == flag).alias(n) for n in names])

    traders = shipment_links.select(
        F.explode(
            F.array(
                mark("buyer_dv_hashkey_company", "is_trade_buyer"),
                mark("supplier_dv_hashkey_company", "is_trade_supplier"),
            )
        ).alias("mark")
    )
    flags = (
        traders.union(sanction_links.select(mark("dv_hashkey_company", "is_sanction")))
        .select("mark.*")
        .where("company_key is not null")
        .groupBy("company_key")
        .agg(*[F.max(n).alias(n) for n in names])
    )
    members = (
        bridge.select("jurisdiction", "to_key", F.col("from_key").alias("member"))
        .union(bridge.select("jurisdiction", "to_key", F.col("to_key")))
        .distinct()
    )
    return (
        members.join(flags, F.col("member") == F.col("company_key"), "left")
        .groupBy("jurisdiction", "to_key")
        .agg(*[F.max(n).alias(n) for n in names])
    )


def trade_entities(golden, flags, lookup, load_ts=None):
    """Golden records with trade flags and displayed jurisdiction."""
    now = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    places = one_per_jurisdiction(lookup, ["country_name", "alpha2_code", "is_state"])
    state = F.get(F.split("jurisdiction", "[.]"), 1)
    known = golden.drop("country_name", "country_code")
    joined = known.join(
        flags.select(
            F.col("jurisdiction").alias("__j"), F.col("to_key").alias("__key"),
            "is_trade_buyer", "is_trade_supplier", F.col("is_sanction").alias("__sanction"),
        ),
        (F.col("jurisdiction") == F.col("__j")) & (F.col("dv_hashkey_company") == F.col("__key")),
        "left",
    ).join(small_side(places), "jurisdiction", "left")
    rest = [c for c in known.columns if c not in ("dv_hashkey_company", "jurisdiction", "dv_loaddts")]
    no = F.lit(False)
    return joined.select(
        F.col("dv_hashkey_company").alias("id"),
        now.alias("dv_loaddts"),
        *rest,
        F.when(F.col("is_state").cast("boolean"), state)
        .otherwise(F.coalesce("jurisdiction", F.lit("unspecified")))
        .alias("jurisdiction"),
        F.coalesce("country_name", F.lit("unspecified")).alias("country_name"),
        F.coalesce("alpha2_code", F.lit("unspecified")).alias("country_code"),
        no.alias("is_person"),
        F.coalesce(F.col("is_trade_buyer") | F.col("is_trade_supplier"), no).alias("is_trade"),
        F.coalesce("__sanction", no).alias("is_sanction"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def trade_transactions(shipments, links, bridge, hscodes, load_ts=None):
    """The shipment fact with survivor parties, date keys, HS reference, and load, creation and update stamps.

    All three stamps are the time of the run, now by default; the shipment's own load time goes.
    """
    now = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    parties = {"buyer": "buyer_id", "supplier": "supplier_id", "shipper": "shipper_id"}
    pointed = repoint(
        links, bridge, [f"{role}_dv_hashkey_company" for role in parties]
    ).select(
        "dv_hashkey_bol",
        *[F.col(f"{role}_dv_hashkey_company").alias(name) for role, name in parties.items()],
        "import_port",
        "export_port",
    ).where("buyer_id is not null and supplier_id is not null")
    codes = hscodes.select(F.col("code").alias("__code")).distinct()
    return (
        shipments.drop("dv_loaddts", "created_at", "updated_at")
        .withColumns(date_keys("actual_arrival_date"))
        .join(pointed, "dv_hashkey_bol")
        .join(small_side(codes), F.col("hs_code") == F.col("__code"), "left")
        .withColumn("hs_code_ref", F.coalesce("__code", F.lit("dummy")))
        .drop("__code")
        .withColumnRenamed("dv_hashkey_bol", "id")
        .withColumns({"dv_loaddts": now, "created_at": now, "updated_at": now})
    )


def port_mart(ports):
    """Ports under their public id, former names as an array."""
    return (
        ports.withColumnRenamed("dv_hashkey_port", "id")
        .withColumn("previous_port_name", F.split("previous_port_name", ";"))
        .drop("dv_loaddts")
    )
