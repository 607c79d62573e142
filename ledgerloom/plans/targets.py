"""Contracts of the vault tables: columns, keys and partitions."""

from pyspark.sql.types import StructType

from ledgerloom.contract import TableContract

# Table columns as DDL, key columns, partition columns.
AUDIT = "dv_recsrc string, dv_loaddts timestamp, dv_source_version string"
PLACE = (
    "full_address string, street string, city string, region string, state string, province string, "
    "country_code string, country_name string, postal_code string, latitude float, longitude float, "
    "type int, start_date date, end_date date"
)
SHIPMENT = (
    "bol string, hs_code string, teu_number string, invoice_value float, value_usd float, "
    "exchange_rate float, description string, actual_arrival_date date, estimated_arrival_date date, "
    "vessel_name string, quantity int, quantity_unit string, weight float, weight_unit string"
)
TABLES = {
    "h_company": (
        f"dv_hashkey_company string, {AUDIT}, jurisdiction string, registration_number string, "
        "name string, pure_name string, has_regnum int",
        ["jurisdiction", "dv_hashkey_company"], ["jurisdiction"],
    ),
    "h_person": (
        f"dv_hashkey_person string, {AUDIT}, jurisdiction string, name string, full_address string",
        ["jurisdiction", "dv_hashkey_person"], ["jurisdiction"],
    ),
    "h_industry": (
        f"dv_hashkey_industry string, {AUDIT}, industry_code string, desc string, country_code string, "
        "standard_type string",
        ["dv_hashkey_industry"], [],
    ),
    "h_sanction": (
        f"dv_hashkey_sanction string, {AUDIT}, id string, sanction_id string, source_schema string, "
        "jurisdiction string",
        ["dv_hashkey_sanction"], ["jurisdiction"],
    ),
    "s_company_demographic": (
        f"dv_hashkey_company string, {AUDIT}, jurisdiction string, registration_number string, name string, "
        "pure_name string, lei_code string, description string, date_incorporated date, "
        "date_struck_off date, legal_form string, category array<string>, phone_numbers array<string>, "
        "emails array<string>, websites array<string>, linkedin_url string, twitter_url string, "
        "facebook_url string, fax_numbers array<string>, other_names array<string>, no_of_employees int, "
        "image_url string, authorised_capital decimal(10,0), paid_up_capital decimal(10,0), "
        "currency_code string, status string, status_code int, status_desc string, is_branch boolean",
        ["jurisdiction", "dv_hashdiff"], ["jurisdiction"],
    ),
    "s_company_address": (
        f"dv_hashkey_company string, {AUDIT}, jurisdiction string, registration_number string, name string, "
        f"pure_name string, {PLACE}",
        ["jurisdiction", "dv_hashdiff"], ["jurisdiction"],
    ),
    "s_person_demographic": (
        f"dv_hashkey_person string, {AUDIT}, jurisdiction string, name string, full_address string, "
        "first_name string, last_name string, middle_name string, is_person boolean, image_url string, "
        "dob string, birthplace string, nationality string, country_of_residence string, "
        "accuracy_level float, gender int, skills array<string>, job_summary string, salary string, "
        "yoe int, industry string, phone_numbers array<string>, emails array<string>, "
        "linkedin_url string, twitter_url string, facebook_url string",
        ["jurisdiction", "dv_hashkey_person"], ["jurisdiction"],
    ),
    "s_person_address": (
        f"dv_hashkey_person string, {AUDIT}, jurisdiction string, name string, {PLACE}",
        ["jurisdiction", "dv_hashkey_person"], ["jurisdiction"],
    ),
    "s_sanction": (
        f"dv_hashkey_sanction string, {AUDIT}, id string, sanction_id string, source_schema string, "
        "authority string, country string, program string, reason string, start_date string, "
        "end_date string, source_link string, jurisdiction string",
        ["dv_hashkey_sanction"], ["jurisdiction"],
    ),
    "s_port": (
        f"dv_hashkey_port string, {AUDIT}, dv_status int, dv_valid_from date, dv_valid_to date, "
        "port_code string, port_name string, emails string, address string, phone_number string, "
        "fax_number string, port_type string, port_size string, website string, terminal boolean, "
        "state string, locode string, status string, latitude float, longitude float, "
        "country_name string, country_code string",
        ["dv_hashkey_port"], [],
    ),
    "s_bol": (
        f"dv_hashkey_bol string, {AUDIT}, jurisdiction string, {SHIPMENT}, hs_code_ref string, "
        "pure_seller string, seller_country string, pure_buyer string, buyer_country string",
        ["dv_hashkey_bol"], ["jurisdiction"],
    ),
    "l_bol": (
        f"dv_hashkey_l_bol string, {AUDIT}, jurisdiction string, dv_hashkey_bol string, "
        "buyer_dv_hashkey_company string, supplier_dv_hashkey_company string, "
        "shipper_dv_hashkey_company string, import_port string, export_port string, bol string, "
        "actual_arrival_date date",
        ["dv_hashkey_l_bol", "dv_hashkey_bol"], ["jurisdiction"],
    ),
    "l_company_company_relationship": (
        f"dv_hashkey_l_company_company_relationship string, {AUDIT}, dv_hashkey_from_company string, "
        "dv_hashkey_to_company string, from_jurisdiction string, to_jurisdiction string, "
        "position string, position_code int, start_date date, end_date date",
        ["from_jurisdiction", "to_jurisdiction", "dv_hashkey_l_company_company_relationship"],
        ["to_jurisdiction"],
    ),
    "l_person_company_relationship": (
        f"dv_hashkey_l_person_company_relationship string, {AUDIT}, dv_hashkey_person string, "
        "dv_hashkey_company string, from_jurisdiction string, to_jurisdiction string, "
        "position string, position_code int, start_date date, end_date date",
        ["from_jurisdiction", "to_jurisdiction", "dv_hashkey_l_person_company_relationship"],
        ["to_jurisdiction"],
    ),
    "l_person_person_relationship": (
        f"dv_hashkey_l_person_person_relationship string, {AUDIT}, dv_hashkey_from_person string, "
        "dv_hashkey_to_person string, from_jurisdiction string, to_jurisdiction string, "
        "related_type string, start_date date, end_date date",
        ["from_jurisdiction", "to_jurisdiction", "dv_hashkey_l_person_person_relationship"],
        ["to_jurisdiction"],
    ),
    "l_company_industry": (
        f"dv_hashkey_l_c_i string, {AUDIT}, dv_hashkey_industry string, dv_hashkey_company string, "
        "jurisdiction string, type boolean",
        ["jurisdiction", "dv_hashkey_l_c_i"], ["jurisdiction"],
    ),
    "l_sanction_company": (
        f"dv_hashkey_link_sanction string, {AUDIT}, dv_hashkey_company string, dv_hashkey_sanction string",
        ["dv_hashkey_link_sanction"], [],
    ),
    "l_sanction_person": (
        f"dv_hashkey_link_sanction string, {AUDIT}, dv_hashkey_person string, dv_hashkey_sanction string",
        ["dv_hashkey_link_sanction"], [],
    ),
    "lookup_hscode": (
        f"dv_hashkey_hscode string, {AUDIT}, code string, description string, type string, "
        "country_code string, country_name string, parent_code string",
        ["dv_hashkey_hscode"], [],
    ),
}


def schema_of(table):
    return StructType.fromDDL(TABLES[table][0])


def contract_of(table, lake):
    """The contract of a vault table below a lake folder."""
    _, keys, partitions = TABLES[table]
    return TableContract(
        name=table,
        location=f"{lake.rstrip('/')}/{table}",
        unique_key=keys,
        partition_by=partitions,
        columns=tuple(schema_of(table).jsonValue()["fields"]),
    )
