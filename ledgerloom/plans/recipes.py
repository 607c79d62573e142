"""Vault jobs as data: one recipe per source and target table.

A recipe names what a source row becomes; ``rows_of`` turns it into one plan
and the contract of the target does the rest: absent columns become nulls,
undeclared ones go. Writers are chosen by the kind of table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from ledgerloom.functions.codes import has_regnum, unspecified
from ledgerloom.functions.fixed import HASH_KEYS
from ledgerloom.functions.keys import audit_columns, hash_key, hash_of
from ledgerloom.functions.text import pure_name
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.frames import enforce_schema, union_all
from ledgerloom.operators.joins import or_sentinel, small_side
from ledgerloom.operators.lookups import one_per_jurisdiction
from ledgerloom.operators.merge import new_rows, satellite_rows
from ledgerloom.plans.targets import schema_of

PROVENANCE = "concat_ws(';', data_source, data_source_link)"
LOADED = "concat_ws(';', data_source, load_date)"


@dataclass(frozen=True)
class Recipe:
    """What one source becomes in one table.

    where: SQL filter on the source. roles: column maps (name to SQL) of
    which one wide row gives one row each. rename, derive: new names, and SQL
    expressions over them. pure: pure name column by name column. hashes:
    hash column to hash kind, or to (kind, {key part: column}). distinct: one
    row per these columns. record_source, version: SQL, else the caller's.
    """

    table: str
    where: str | None = None
    roles: tuple = ()
    rename: dict = field(default_factory=dict)
    derive: dict = field(default_factory=dict)
    pure: dict = field(default_factory=dict)
    known_place: bool = False
    hashes: dict = field(default_factory=dict)
    distinct: tuple = ()
    keep: str | None = None
    record_source: str | None = None
    version: str | None = None


def _complete(df, columns):
    absent = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def rows_of(recipe, source, record_source="", version=None, load_ts=None):
    """The rows a source brings to the recipe's table, in the table's schema."""
    df = source.where(recipe.where) if recipe.where else source
    if recipe.roles:
        df = union_all(
            *[
                df.select(*[F.expr(sql).alias(name) for name, sql in role.items()]).distinct()
                for role in recipe.roles
            ]
        )
    df = df.withColumnsRenamed(recipe.rename)
    df = df.withColumns({name: F.expr(sql) for name, sql in recipe.derive.items()})
    df = df.withColumns({target: pure_name(name) for target, name in recipe.pure.items()})
    if recipe.known_place:
        df = df.withColumn("jurisdiction", unspecified("jurisdiction"))
    for target, rule in recipe.hashes.items():
        kind, renamed = (rule, {}) if isinstance(rule, str) else rule
        if isinstance(kind, tuple):
            df = df.withColumn(target, hash_of(*kind))
            continue
        df = _complete(df, [renamed.get(part, part) for part in HASH_KEYS[kind]])
        df = df.withColumn(target, hash_key(kind, **renamed))
    if recipe.keep:
        df = df.where(recipe.keep)
    if recipe.table == "h_company":
        df = _complete(df, ["registration_number"]).withColumn("has_regnum", has_regnum())
    if recipe.distinct:
        df = first_per_key(df, list(recipe.distinct))
    origin, loaded, edition = audit_columns(
        F.expr(recipe.record_source) if recipe.record_source else record_source, load_ts, version
    )
    stamped = {"dv_recsrc": origin, "dv_loaddts": loaded, "dv_source_version": edition}
    if "dv_valid_from" in schema_of(recipe.table).names:  # in force since the day before the load
        stamped |= {
            "dv_status": F.lit(1),
            "dv_valid_from": F.date_sub(loaded.cast("date"), 1),
            "dv_valid_to": F.lit(None).cast("date"),
        }
    if recipe.version:
        stamped["dv_source_version"] = F.expr(recipe.version)
    return enforce_schema(df.withColumns(stamped), schema_of(recipe.table))


def load(recipe, base, source, contract, **stamps):
    """Rows to append to the recipe's table: hubs and links by key, satellites by hash."""
    rows = rows_of(recipe, source, **stamps)
    if recipe.table.startswith("s_"):
        return satellite_rows(base, rows, rows.schema, contract.unique_key, rows.columns[0])
    return new_rows(base, rows, contract.unique_key)


COMPANY = {"dv_hashkey_company": "company"}
PERSON = {"dv_hashkey_person": "person"}
SANCTION = {"dv_hashkey_sanction": "sanction"}
PURE = {"pure_name": "name"}
FULL_NAME = {"dv_hashkey_person": ("person", {"name": "full_name"})}


def _trade_parties(hashed):
    """Importer and exporter of a shipment as companies."""
    common = {"dv_recsrc": "dv_recsrc", "data_source": "data_source"}
    sides = [("import_country", "importer", "buyer"), ("export_country_or_area", "exporter", "supplier")]
    roles = []
    for country, name, party in sides:
        role = {"jurisdiction": country, "name": name, **common}
        if hashed:
            role |= {
                "load_date": "load_date", "pure_name": f"pure_{name}",
                "dv_hashkey_company": f"{party}_dv_hashkey_company",
            }
        roles.append(role)
    return tuple(roles)


# Labels of sources and their versions.
COLOMBIA = (
    "'Colombia;https://www.datos.gov.co/en/Comercio-Industria-y-Turismo/"
    "Personas-Naturales-Personas-Jur-dicas-y-Entidades-/c82u-588k/about_data'"
)
COLOMBIA_VERSION = "'Colombia-20241231'"
COLOMBIA_IMPORT_VERSION = "'gov_colombia_trade_import_2016_2024;20241227'"
NEWFOUNDLAND = (
    "'Newfoundland and Labrador;"
    "https://cado.eservices.gov.nl.ca/Company/CompanyNameNumberSearch.aspx'"
)
NEWFOUNDLAND_VERSION = "'Newfoundland and Labrador-20241231'"
NEWFOUNDLAND_PLACE = "'CA.Newfoundland and Labrador'"
TAIWAN = "'https://data.gcis.nat.gov.tw/od/datacategory'"

COLOMBIA_COMPANY = dict(
    where="first_lastname is null and business_name is not null",
    rename={"business_name": "name"}, pure=PURE, hashes=COMPANY,
    record_source=COLOMBIA, version=COLOMBIA_VERSION,
)
NEWFOUNDLAND_COMPANY = dict(
    rename={"company_name": "name", "company_number": "registration_number"},
    hashes=COMPANY, record_source=NEWFOUNDLAND, version=NEWFOUNDLAND_VERSION,
)
COLOMBIA_IMPORT = dict(
    pure=PURE, known_place=True, hashes=COMPANY, version=COLOMBIA_IMPORT_VERSION
)


def _colombia_roles(importer=(), exporter=()):
    """Importer, exporter and shipper of the Colombian imports as companies."""
    return (
        {"name": "name_import", "registration_number": "regis_import", "jurisdiction": "'Colombia'",
         **dict(importer)},
        {"name": "name_export", "jurisdiction": "jurisdiction", **dict(exporter)},
        {"name": "shipper_company"},
    )


HUBS = {
    "h_company/trade_dat": Recipe(
        "h_company", roles=_trade_parties(False), pure=PURE, known_place=True, hashes=COMPANY,
        version="concat_ws(';', data_source, '20240108')",
    ),
    "h_company/register": Recipe("h_company", hashes=COMPANY, record_source=PROVENANCE),
    "h_company/register_rehashed": Recipe(
        "h_company",
        rename={"new_dv_hashkey_company": "dv_hashkey_company", "new_pure_name": "pure_name"},
        record_source="dv_recsrc", version="dv_source_version",
    ),
    "h_company/trade_6k": Recipe(
        "h_company", roles=_trade_parties(True), known_place=True, record_source="dv_recsrc", version=LOADED
    ),
    "h_company/bangladesh": Recipe(
        "h_company", rename={"name_status": "registration_number"},
        derive={"jurisdiction": "'Bangladesh'"}, hashes=COMPANY,
    ),
    "h_company/colombia": Recipe("h_company", derive={"jurisdiction": "'Colombia'"}, **COLOMBIA_COMPANY),
    "h_company/colombia_import": Recipe("h_company", roles=_colombia_roles(), **COLOMBIA_IMPORT),
    "h_company/taiwan": Recipe(
        "h_company", derive={"jurisdiction": "'Taiwan'"}, pure=PURE, hashes=COMPANY, record_source=TAIWAN
    ),
    "h_company/seo_listing": Recipe(
        "h_company", derive={"registration_number": "cast(null as string)"}, hashes=COMPANY
    ),
    "h_company/manual": Recipe(
        "h_company", hashes=COMPANY, record_source=PROVENANCE, version="'manual_company'"
    ),
    "h_company/mexico": Recipe("h_company", derive={"jurisdiction": "'Mexico'"}, pure=PURE, hashes=COMPANY),
    "h_company/newfoundland": Recipe(
        "h_company", where="company_name is not null and status <> 'System Error'",
        derive={"jurisdiction": NEWFOUNDLAND_PLACE}, pure=PURE, distinct=("dv_hashkey_company",),
        **NEWFOUNDLAND_COMPANY,
    ),
    "h_company/new_york": Recipe(
        "h_company", derive={"jurisdiction": "'New York'"}, pure=PURE, hashes=COMPANY,
        distinct=("dv_hashkey_company",),
    ),
    "h_company/open_sanctions": Recipe("h_company", where="type = 'COMPANY'", pure=PURE, hashes=COMPANY),
    "h_company/sanction": Recipe("h_company", rename={"company_name": "name"}, hashes=COMPANY),
    "h_company/trade_feed": Recipe(
        "h_company", roles=_trade_parties(True), known_place=True, record_source="dv_recsrc", version=LOADED
    ),
    "h_company/test_levenshtein": Recipe("h_company", pure=PURE, hashes=COMPANY),
    "h_industry/register": Recipe("h_industry", hashes={"dv_hashkey_industry": "industry"}),
    "h_industry/mexico": Recipe(
        "h_industry", rename={"industry_description": "desc"},
        derive={"country_code": "'MX'", "standard_type": "'SCIAN'"},
        hashes={"dv_hashkey_industry": "industry"}, distinct=("dv_hashkey_industry",),
    ),
    "h_person/register": Recipe(
        "h_person", where="name is not null", hashes=PERSON, record_source=PROVENANCE
    ),
    "h_person/newfoundland": Recipe(
        "h_person", where="company_name is not null and officer_name is not null and status <> 'System Error'",
        rename={"officer_name": "name"}, derive={"jurisdiction": NEWFOUNDLAND_PLACE},
        hashes=PERSON, record_source=NEWFOUNDLAND, version=NEWFOUNDLAND_VERSION,
    ),
    "h_person/kentucky": Recipe(
        "h_person", where="full_name is not null", rename={"full_name": "name"}, hashes=PERSON,
        distinct=("name", "full_address"),
    ),
    "h_person/open_sanctions": Recipe(
        "h_person", where="type = 'PERSON' and full_name is not null", derive={"name": "full_name"},
        hashes=PERSON, distinct=("full_name", "full_address"),
    ),
    "h_person/sanction": Recipe(
        "h_person", derive={"jurisdiction": "country_name", "name": "full_name", "full_address": "address"},
        hashes=PERSON,
    ),
    "h_sanction/register": Recipe("h_sanction", rename={"entity_id": "id"}, hashes=SANCTION),
    "h_sanction/open_sanctions": Recipe("h_sanction", where="is_sanction", hashes=SANCTION),
    "h_sanction/sanction": Recipe("h_sanction", hashes=SANCTION),
}

DEMOGRAPHICS = {
    "s_company_demographic/trade_dat": Recipe(
        "s_company_demographic", roles=_trade_parties(False), pure=PURE, known_place=True, hashes=COMPANY,
        version="concat_ws(';', data_source, '20240108')",
    ),
    "s_company_demographic/register": Recipe(
        "s_company_demographic", hashes=COMPANY, record_source=PROVENANCE
    ),
    "s_company_demographic/register_rehashed": Recipe(
        "s_company_demographic",
        derive={"dv_hashkey_company": "new_dv_hashkey_company", "pure_name": "new_pure_name"},
        record_source="dv_recsrc", version="dv_source_version",
    ),
    "s_company_demographic/trade_6k": Recipe(
        "s_company_demographic", roles=_trade_parties(True), known_place=True, record_source="dv_recsrc",
        version=LOADED,
    ),
    "s_company_demographic/trade_feed": Recipe(
        "s_company_demographic", roles=_trade_parties(True), known_place=True, record_source="dv_recsrc",
        version=LOADED,
    ),
    "s_company_demographic/bangladesh": Recipe(
        "s_company_demographic", rename={"name_status": "registration_number"},
        derive={"jurisdiction": "'Bangladesh'", "currency_code": "'BDT'", "is_branch": "false",
                "status_code": "1"},
        hashes=COMPANY,
    ),
    "s_company_demographic/colombia": Recipe(
        "s_company_demographic",
        derive={
            "jurisdiction": "'Colombia'", "currency_code": "'COP'", "is_branch": "false",
            "date_incorporated": "concat_ws('-', substr(registration_date, 1, 4), "
            "substr(registration_date, 5, 2), substr(registration_date, 7, 2))",
            "other_names": "split(abbreviation, ';')", "legal_form": "company_type",
            "status": "registration_status", "status_code": "registration_status_code",
        },
        **COLOMBIA_COMPANY,
    ),
    "s_company_demographic/colombia_import": Recipe(
        "s_company_demographic",
        roles=_colombia_roles(
            importer={"phone_numbers": "array(tele_import)"},
            exporter={
                "emails": "array(email_export_std)", "websites": "array(url_export)",
                "fax_numbers": "array(fax_export)", "phone_numbers": "array(phone_export)",
            },
        ),
        derive={"is_branch": "false"}, **COLOMBIA_IMPORT,
    ),
    "s_company_demographic/seo_listing": Recipe(
        "s_company_demographic",
        derive={
            "registration_number": "cast(null as string)", "is_branch": "false", "status_code": "1",
            "category": "category_list", "phone_numbers": "from_json(phone, 'array<string>')",
            "emails": "from_json(mail, 'array<string>')", "websites": "from_json(website, 'array<string>')",
        },
        hashes=COMPANY,
    ),
    "s_company_demographic/manual": Recipe(
        "s_company_demographic",
        derive={
            name: f"array({name})"
            for name in ("category", "phone_numbers", "emails", "websites", "fax_numbers", "other_names")
        },
        hashes=COMPANY, record_source=PROVENANCE, version="'manual_company'",
    ),
    "s_company_demographic/mexico": Recipe(
        "s_company_demographic", where="registration_number is not null and legal_name is not null",
        rename={"legal_name": "name"},
        derive={"jurisdiction": "'Mexico'", "is_branch": "false", "currency_code": "'MXN'"},
        pure=PURE, hashes=COMPANY, distinct=("registration_number", "name"),
    ),
    "s_company_demographic/newfoundland": Recipe(
        "s_company_demographic", where="company_name is not null",
        derive={"jurisdiction": NEWFOUNDLAND_PLACE, "currency_code": "'CAD'"}, pure=PURE,
        distinct=("dv_hashkey_company",), **NEWFOUNDLAND_COMPANY,
    ),
    "s_company_demographic/new_york": Recipe(
        "s_company_demographic",
        derive={"jurisdiction": "'New York'", "is_branch": "false", "currency_code": "'USD'"},
        pure=PURE, hashes=COMPANY,
    ),
    "s_company_demographic/open_sanctions": Recipe(
        "s_company_demographic", where="type = 'COMPANY'",
        derive={"is_branch": "false", "currency_code": "'USD'"}, pure=PURE, hashes=COMPANY,
    ),
    "s_company_demographic/sanction": Recipe(
        "s_company_demographic", rename={"company_name": "name"}, hashes=COMPANY
    ),
    "s_company_demographic/turkey": Recipe(
        "s_company_demographic", where="registration_number is not null and name is not null",
        derive={"jurisdiction": "'Turkey'", "is_branch": "false", "currency_code": "'TRY'"},
        pure=PURE, hashes=COMPANY, distinct=("registration_number", "name"),
    ),
    "s_person_demographic/register": Recipe(
        "s_person_demographic", where="name is not null", hashes=PERSON, record_source=PROVENANCE
    ),
    "s_person_demographic/kentucky": Recipe(
        "s_person_demographic", where="full_name is not null", rename={"full_name": "name"}, hashes=PERSON,
        distinct=("name", "full_address"),
    ),
    "s_person_demographic/newfoundland": Recipe(
        "s_person_demographic", where="officer_name is not null", rename={"officer_name": "name"},
        derive={"jurisdiction": NEWFOUNDLAND_PLACE}, hashes=PERSON,
        record_source=NEWFOUNDLAND, version=NEWFOUNDLAND_VERSION,
    ),
    "s_person_demographic/open_sanctions": Recipe(
        "s_person_demographic", where="type = 'PERSON'", rename={"full_name": "name"}, hashes=PERSON
    ),
    "s_person_demographic/sanction": Recipe(
        "s_person_demographic",
        derive={"jurisdiction": "country_name", "name": "full_name", "full_address": "address",
                "is_person": "true", "country_of_residence": "country_name", "gender": "gender_numeric"},
        hashes=PERSON,
    ),
}

ADDRESSES = {
    "s_company_address/register": Recipe("s_company_address", hashes=COMPANY, record_source=PROVENANCE),
    "s_company_address/register_rehashed": Recipe(
        "s_company_address",
        derive={"dv_hashkey_company": "new_dv_hashkey_company", "pure_name": "new_pure_name"},
        record_source="dv_recsrc", version="dv_source_version",
    ),
    "s_company_address/bangladesh": Recipe(
        "s_company_address", rename={"name_status": "registration_number"},
        derive={"jurisdiction": "'Bangladesh'", "country_name": "'Bangladesh'", "country_code": "'BD'"},
        hashes=COMPANY,
    ),
    "s_company_address/colombia": Recipe(
        "s_company_address",
        derive={"jurisdiction": "'Colombia'", "country_name": "'Colombia'", "country_code": "'CO'",
                "city": "chamber_commerce"},
        **COLOMBIA_COMPANY,
    ),
    "s_company_address/colombia_import": Recipe(
        "s_company_address",
        roles=_colombia_roles(
            importer={"full_address": "address_import"}, exporter={"full_address": "address_export"}
        ),
        keep="full_address is not null", distinct=("full_address",), **COLOMBIA_IMPORT,
    ),
    "s_company_address/seo_listing": Recipe(
        "s_company_address", derive={"registration_number": "cast(null as string)", "type": "1"},
        hashes=COMPANY,
    ),
    "s_company_address/manual": Recipe(
        "s_company_address", hashes=COMPANY, record_source=PROVENANCE, version="'manual_company'"
    ),
    "s_company_address/newfoundland": Recipe(
        "s_company_address", where="company_name is not null",
        roles=tuple(
            {
                "jurisdiction": NEWFOUNDLAND_PLACE, "registration_number": "company_number",
                "name": "company_name", "full_address": f"{kind}_full_address", "type": code,
                "postal_code": f"{office}_postal_zip_code", "country_code": "'CA'",
                "country_name": "'Canada'",
            }
            for kind, office, code in (
                ("main", "registered_office", "1"), ("mailing", "registered_office_outside_nl", "3"),
            )
        ),
        pure=PURE, hashes=COMPANY, keep="full_address is not null",
        record_source=NEWFOUNDLAND, version=NEWFOUNDLAND_VERSION,
    ),
    "s_company_address/new_york": Recipe(
        "s_company_address", rename={"location_zip": "postal_code"},
        derive={"jurisdiction": "'New York'", "country_name": "'United States'", "country_code": "'US'"},
        pure=PURE, hashes=COMPANY,
    ),
    "s_company_address/open_sanctions": Recipe(
        "s_company_address", where="type = 'COMPANY'", derive={"type": "cast(null as int)"}, pure=PURE,
        hashes=COMPANY,
    ),
    "s_company_address/sanction": Recipe(
        "s_company_address",
        rename={"company_name": "name", "address": "full_address", "country": "country_code"},
        derive={"type": "1"}, hashes=COMPANY,
    ),
    "s_person_address/register": Recipe(
        "s_person_address", where="name is not null", derive={"type": "1"}, hashes=PERSON,
        record_source=PROVENANCE,
    ),
    "s_person_address/kentucky": Recipe(
        "s_person_address", where="full_name is not null and full_address is not null",
        rename={"full_name": "name"}, hashes=PERSON, distinct=("name", "full_address"),
    ),
    "s_person_address/open_sanctions": Recipe(
        "s_person_address", where="type = 'PERSON'", rename={"full_name": "name"},
        derive={"type": "cast(null as int)"}, hashes=PERSON,
    ),
    "s_person_address/sanction": Recipe(
        "s_person_address",
        derive={"jurisdiction": "country_name", "name": "full_name", "full_address": "address", "type": "1"},
        hashes=PERSON,
    ),
}


def _relationship(kind, hashes, **more):
    suffix = "related" if kind == "person_person" else "position"
    role = "related_type" if kind == "person_person" else "position"
    return Recipe(
        f"l_{kind}_relationship",
        hashes={**hashes, f"dv_hashkey_l_{kind}_relationship": f"l_{kind}_{suffix}"},
        keep=" and ".join(filter(None, [f"{role} is not null", more.pop("keep", None)])),
        **more,
    )


REHASHED = dict(record_source="dv_recsrc", version="dv_source_version")
LINKS = {
    "l_company_company_relationship/register": _relationship(
        "company_company",
        {"dv_hashkey_from_company": "from_company", "dv_hashkey_to_company": "to_company"},
    ),
    "l_company_company_relationship/register_rehashed": _relationship(
        "company_company", {},
        rename={f"new_dv_hashkey_{e}_company": f"dv_hashkey_{e}_company" for e in ("from", "to")},
        **REHASHED,
    ),
    "l_company_company_relationship/kentucky": _relationship(
        "company_company",
        {"dv_hashkey_from_company": "from_company", "dv_hashkey_to_company": "to_company"},
        where="full_name is not null and name is not null",
    ),
    "l_person_company_relationship/register": _relationship(
        "person_company", {"dv_hashkey_person": "from_person", "dv_hashkey_company": "to_company"}
    ),
    "l_person_company_relationship/register_rehashed": _relationship(
        "person_company", {}, rename={"new_dv_hashkey_company": "dv_hashkey_company"}, **REHASHED
    ),
    "l_person_company_relationship/kentucky": _relationship(
        "person_company", {**COMPANY, **FULL_NAME}, where="full_name is not null and name is not null",
        pure=PURE, derive={"from_jurisdiction": "jurisdiction", "to_jurisdiction": "jurisdiction"},
    ),
    "l_person_company_relationship/newfoundland": _relationship(
        "person_company", {"dv_hashkey_person": "from_person", "dv_hashkey_company": "to_company"},
        where="company_name is not null and officer_name is not null",
        rename={"company_number": "to_registration_number", "officer_name": "from_name",
                "pure_name": "to_pure_name"},
        derive={"from_jurisdiction": NEWFOUNDLAND_PLACE, "to_jurisdiction": NEWFOUNDLAND_PLACE},
        record_source=NEWFOUNDLAND, version=NEWFOUNDLAND_VERSION,
    ),
    "l_person_person_relationship/register": _relationship(
        "person_person", {"dv_hashkey_from_person": "from_person", "dv_hashkey_to_person": "to_person"}
    ),
    "l_person_person_relationship/kentucky": _relationship(
        "person_person",
        {"dv_hashkey_from_person": ("from_person", {"from_name": "full_name_from"}),
         "dv_hashkey_to_person": ("to_person", {"to_name": "full_name_to"})},
        where="full_name_from is not null and full_name_to is not null",
    ),
    "l_company_industry/register": Recipe(
        "l_company_industry", keep="industry_code is not null and country_code is not null",
        hashes={"dv_hashkey_industry": "industry",
                "dv_hashkey_l_c_i": (("dv_hashkey_company", "dv_hashkey_industry"), {})},
    ),
    "l_company_industry/mexico": Recipe(
        "l_company_industry", derive={"country_code": "'MX'", "jurisdiction": "'Mexico'", "type": "true"},
        pure=PURE,
        hashes={"dv_hashkey_industry": "industry", **COMPANY,
                "dv_hashkey_l_c_i": (("dv_hashkey_industry", "dv_hashkey_company"), {})},
    ),
    "l_sanction_company/open_sanctions": Recipe(
        "l_sanction_company", where="is_sanction and type = 'COMPANY'", pure=PURE,
        hashes={**COMPANY, **SANCTION,
                "dv_hashkey_link_sanction": (("dv_hashkey_company", "id"), {})},
    ),
    "l_sanction_person/open_sanctions": Recipe(
        "l_sanction_person", where="is_sanction and type = 'PERSON'", rename={"full_name": "name"},
        hashes={**PERSON, **SANCTION, "dv_hashkey_link_sanction": (("dv_hashkey_person", "id"), {})},
    ),
}

REFERENCES = {
    "hs_code_ref/Bangladesh":
        "md5(case when length(hs_code) >= 8 then concat(hs_code, 'Bangladesh') else hs_code end)",
    "hs_code_ref/United States":
        "md5(case when length(hs_code) >= 8 then concat(hs_code, 'United States') else hs_code end)",
}
BOL = {"dv_hashkey_bol": "bol"}
PURE_PARTIES = {"pure_seller": "seller", "pure_buyer": "buyer"}
OTHER = {
    "s_sanction/register": Recipe("s_sanction", rename={"entity_id": "id"}, hashes=SANCTION),
    "s_sanction/company": Recipe("s_sanction", hashes=SANCTION),
    "s_sanction/person": Recipe("s_sanction", hashes=SANCTION),
    "s_sanction/open_sanctions": Recipe("s_sanction", where="is_sanction", hashes=SANCTION),
    "s_port/register": Recipe(
        "s_port", derive={"dv_status": "1"}, hashes={"dv_hashkey_port": "port"}
    ),
    "s_port/us_import": Recipe(
        "s_port", derive={"dv_status": "1"}, hashes={"dv_hashkey_port": "port"},
        distinct=("port_code", "port_name"),
    ),
    "lookup_hscode/register": Recipe("lookup_hscode", hashes={"dv_hashkey_hscode": (("code",), {})}),
    "s_bol/register": Recipe("s_bol", hashes=BOL),
    "s_bol/trade_6k": Recipe(
        "s_bol",
        rename={"unit_of_quantity": "quantity_unit", "products": "description"},
        derive={
            "weight_unit": "upper(unit_of_weight)",
            "actual_arrival_date": "concat_ws('-', substr(date, 1, 4), substr(date, 5, 2), substr(date, 7, 2))",
        },
        hashes=BOL,
    ),
    "s_bol/trade_feed": Recipe("s_bol", record_source="dv_recsrc", version=LOADED),
    "s_bol/colombia_import": Recipe("s_bol", hashes=BOL, version=COLOMBIA_IMPORT_VERSION),
    "s_bol/bangladesh_export": Recipe(
        "s_bol",
        rename={
            "billid": "bol", "hs": "hs_code", "n_weight_kg": "teu_number", "qty": "quantity",
            "cargo_value_local_currency": "invoice_value", "descript": "description",
            "date": "actual_arrival_date", "qty_unit": "quantity_unit",
        },
        derive={"jurisdiction": "seller_country", "hs_code_ref": REFERENCES["hs_code_ref/Bangladesh"]},
        pure=PURE_PARTIES, hashes=BOL,
    ),
    "s_bol/bangladesh_import": Recipe(
        "s_bol",
        rename={
            "billid": "bol", "hs": "hs_code", "assessed_value_in_bdt": "invoice_value",
            "descript": "description", "unit_of_quantity": "quantity_unit", "g_weight_in_kg": "weight",
        },
        derive={
            "jurisdiction": "'Bangladesh'", "weight_unit": "'kg'", "actual_arrival_date": "date",
            "estimated_arrival_date": "date", "buyer_country": "'Bangladesh'",
            "seller_country": "origin_country", "hs_code_ref": REFERENCES["hs_code_ref/Bangladesh"],
        },
        pure=PURE_PARTIES, hashes=BOL,
    ),
    "s_bol/us_import": Recipe(
        "s_bol",
        derive={
            "bol": "bill_of_lading", "teu_number": "teu", "description": "product_desc",
            "weight": "weight_in_kg", "hs_code_ref": REFERENCES["hs_code_ref/United States"],
        },
        hashes=BOL,
    ),
    "l_bol/trade_feed": Recipe("l_bol", record_source="dv_recsrc", version=LOADED),
}

RECIPES = {**HUBS, **DEMOGRAPHICS, **ADDRESSES, **LINKS, **OTHER}


# --- sources that need a join before their recipe ------------------------------------------------


def with_country_code(df, lookup):
    """The country code of the jurisdiction, for the industry recipes."""
    codes = one_per_jurisdiction(lookup, ["country_code"])
    return df.drop("country_code").join(small_side(codes), "jurisdiction", "left")


def with_address_dates(addresses, dates):
    """Start and end date of an address by its id, for the register's addresses."""
    return addresses.join(dates.select("id", "start_date", "end_date"), "id", "left")


def sanctioned_entities(entities, sanctions, kind):
    """Sanctioned entities with their sanction records, for the sanction recipes.

    Without a record the entity stays, with the record's columns null.
    """
    records = sanctions.select(
        F.col("id").alias("__id"), F.col("id").alias("sanction_id"),
        *[c for c in ("authority", "country", "program", "reason", "start_date", "end_date",
                      "source_link") if c in sanctions.columns],
    )
    chosen = entities.where("is_sanctioned").select(
        F.col("country_name").alias("jurisdiction"),
        F.col("id_number").cast("string").alias("id"),
        F.lit(kind).alias("source_schema"),
    )
    return chosen.join(records, F.col("id") == F.col("__id"), "left").drop("__id")


def sanction_links(sanctioned, parties, entity_key, party_key, hash_column):
    """Links of sanctions to the hubs of companies or persons, by entity id."""
    joined = sanctioned.select(F.col(entity_key).alias("id")).join(
        parties.select(F.col(party_key).alias("__id"), hash_column), F.col("id") == F.col("__id")
    )
    return joined.withColumn("dv_hashkey_sanction", hash_of("id")).withColumn(
        "dv_hashkey_link_sanction", hash_of("dv_hashkey_sanction", hash_column)
    ).drop("__id")


def mapped_sanction_links(satellite, hub, hash_column):
    """Links from a sanction satellite; a sanction the hub lacks is ``CANT MAP``."""
    known = hub.where("sanction_id is not null").groupBy(F.col("sanction_id").alias("__id")).agg(
        F.min("dv_hashkey_sanction").alias("__sanction")
    )
    joined = satellite.join(known, F.col("sanction_id") == F.col("__id"), "left").withColumn(
        "dv_hashkey_sanction", or_sentinel("__sanction")
    )
    return joined.withColumn(
        "dv_hashkey_link_sanction", hash_of("dv_hashkey_sanction", hash_column)
    ).drop("__id", "__sanction")


def shipments_by_name(shipments, companies, local, local_side):
    """Parties of shipments by pure name and country; unknown ones are ``CANT MAP``.

    ``local`` holds the companies of the reporting country, which the party on
    ``local_side`` (buyer or seller) is sought among.
    """
    df = shipments
    for side, role in (("seller", "supplier"), ("buyer", "buyer")):
        frame = local if side == local_side else companies
        known = frame.groupBy(
            F.col("pure_name").alias("__name"), F.col("jurisdiction").alias("__place")
        ).agg(F.min("dv_hashkey_company").alias("__hash"))
        df = (
            df.join(
                small_side(known),
                (F.col(f"pure_{side}") == F.col("__name")) & (F.col(f"{side}_country") == F.col("__place")),
                "left",
            )
            .withColumn(f"{role}_dv_hashkey_company", or_sentinel("__hash"))
            .drop("__name", "__place", "__hash")
        )
    return _hashed_links(df)


def shipments_of_columns(shipments, parties, ports):
    """Parties of shipments hashed from their own columns, ports by code.

    ``parties`` maps role to (name column, SQL of the jurisdiction, registration
    number column or None); ``ports`` maps side to (SQL of the code, lookup).
    """
    df = shipments
    for role, (name, place, number) in parties.items():
        df = df.withColumn(
            f"{role}_dv_hashkey_company",
            hash_of(F.expr(place), F.col(number) if number else F.lit(None), pure_name(name)),
        )
    for side, (code, lookup) in ports.items():
        known = lookup.groupBy(F.col("port_code").alias("__code")).agg(
            F.min("dv_hashkey_port").alias(f"{side}_port")
        )
        df = df.drop(f"{side}_port").join(
            small_side(known), F.expr(code) == F.col("__code"), "left"
        ).drop("__code")
    return _hashed_links(df)


def _hashed_links(df):
    df = _complete(df, [*HASH_KEYS["bol"], "export_port", "import_port"])
    return df.withColumn("dv_hashkey_bol", hash_key("bol")).withColumn(
        "dv_hashkey_l_bol", hash_key("l_bol")
    )


def _after_first(column):
    """The parts of a printed place behind its first one."""
    parts = F.split(column, ", ")
    return F.concat_ws(", ", F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))))


def us_import_ports(df):
    """Port codes and names out of the printed ports of the US imports.

    A printed port is its code and the parts of its name, ``Unknown`` where it
    has none; the name of a loading port goes on with the parts of the country.
    """
    named = F.size(F.split("loading_port", ", ")) > 1
    return df.withColumns(
        {
            "unloading_port_code": F.get(F.split("unloading_port", ", "), 0),
            "loading_port_code": F.get(F.split("loading_port", ", "), 0),
            "loading_port_name": F.concat_ws(
                ", ", F.when(named, _after_first("loading_port")).otherwise("Unknown"), _after_first("country")
            ),
        }
    )


def _known_ports(ports, columns):
    named = ports.where("port_code is not null and port_name is not null")
    return small_side(first_per_key(named.select("port_code", *columns), ["port_code"]))


def us_shipments(df, ports):
    """US imports with known unloading port, for the satellite and the link.

    The supplier's place is the country behind its code, the buyer's the state;
    weights are in KG.
    """
    known = _known_ports(ports, ["port_name"]).select(
        F.col("port_code").alias("__code"), F.col("port_name").alias("unloading_port_name")
    )
    found = us_import_ports(df).join(known, F.col("unloading_port_code") == F.col("__code")).drop("__code")
    return found.withColumns(
        {
            "jurisdiction_supplier": F.when(
                F.size(F.split("country", ", ")) > 2, _after_first("country")
            ).otherwise("Unknown"),
            "jurisdiction_buyer": F.col("state"),
            "weight_unit": F.lit("KG"),
        }
    )


def us_shipment_links(df, ports):
    """The link rows of US imports: hashes of shipment, supplier, buyer and both ports."""
    rows = us_shipments(df, ports).drop("weight").withColumnsRenamed(
        {"bill_of_lading": "bol", "teu": "teu_number", "weight_in_kg": "weight", "product_desc": "description"}
    )
    no_number = F.lit(None).cast("string")
    rows = rows.withColumns(
        {
            "supplier_dv_hashkey_company": hash_of("jurisdiction_supplier", no_number, pure_name("raw_shipper_name")),
            "buyer_dv_hashkey_company": hash_of("jurisdiction_buyer", no_number, pure_name("raw_consignee_name")),
            "export_port": hash_of("loading_port_code", "loading_port_name"),
            "import_port": hash_of("unloading_port_code", "unloading_port_name"),
        }
    )
    return _hashed_links(rows)


PORT_FIELDS = [
    "port_name", "emails", "address", "longitude", "latitude", "status", "locode", "state", "terminal",
    "website", "port_size", "port_type", "fax", "phone",
]


def us_ports(df, ports):
    """Unloading ports as registered and loading ports as printed, each once, for ``s_port/us_import``."""
    place = F.split("decimal", ",")
    located = ports.withColumns({"latitude": F.trim(F.get(place, 0)), "longitude": F.trim(F.get(place, 1))})
    printed = us_import_ports(df)
    unloading = printed.select(F.col("unloading_port_code").alias("port_code")).distinct().join(
        _known_ports(_complete(located, PORT_FIELDS), PORT_FIELDS), "port_code"
    )
    loading = printed.select(
        F.col("loading_port_code").alias("port_code"), F.col("loading_port_name").alias("port_name"),
        F.lit("Unknown").alias("state"),
    ).distinct()
    columns = ["port_code", *PORT_FIELDS]
    both = unloading.select(*columns).unionByName(_complete(loading, PORT_FIELDS).select(*columns))
    return both.distinct().withColumnsRenamed({"fax": "fax_number", "phone": "phone_number"})


def export_shipments(df, ports):
    """Shipments with the code and name of the seller's port, by port name and country; all rows stay."""
    known = small_side(
        first_per_key(ports.select("port_name", "country_name", "port_code"), ["port_name", "country_name"])
    ).select(
        F.col("port_name").alias("__name"), F.col("country_name").alias("__country"),
        F.col("port_code").alias("seller_port_code"),
    )
    return df.join(
        known, (F.col("seller_port") == F.col("__name")) & (F.col("seller_country") == F.col("__country")), "left"
    ).drop("__name", "__country")
