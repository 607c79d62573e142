import hashlib
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.plans import bronze, recipes
from ledgerloom.plans.targets import TABLES, contract_of, schema_of


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


SQL_WORDS = {
    "concat_ws", "concat", "cast", "as", "string", "int", "null", "is", "not", "and", "or", "case", "when",
    "then", "end", "length", "md5", "substr", "array", "split", "from_json", "false", "true", "upper",
}


def source_columns(recipe):
    """The names a recipe reads, found in its texts."""
    texts = [recipe.where or "", recipe.keep or "", recipe.record_source or "", recipe.version or ""]
    texts += [sql for role in recipe.roles for sql in role.values()]
    texts += list(recipe.derive.values()) + list(recipe.rename) + list(recipe.pure.values())
    texts += [] if recipe.roles else list(TABLES[recipe.table][0].replace(",", " ").split()[::2])
    names = set()
    for text in texts:
        names |= set(re.findall(r"[a-z_]\w*", re.sub(r"'[^']*'", " ", text)))
    made = set(recipe.rename.values()) | set(recipe.hashes) | set(recipe.pure)
    made |= {n for n in recipe.derive if n not in recipe.derive[n]}
    read = set(re.findall(r"[a-z_]\w*", re.sub(r"'[^']*'", " ", recipe.where or "")))
    return sorted((names - SQL_WORDS - made) | set(recipe.rename) | (read - SQL_WORDS))


@pytest.mark.parametrize("name", list(recipes.RECIPES))
def test_recipe_fits_its_table(spark, name):
    recipe = recipes.RECIPES[name]
    lists = {
        f.name for f in schema_of(recipe.table).fields
        if f.dataType.simpleString().startswith("array") and f.name not in recipe.derive
    } | {"category_list"}
    schema = StructType([StructField(c, StringType()) for c in source_columns(recipe)])
    flag = {"is_sanction": "true", **{c: "array('x')" for c in lists}}
    source = spark.createDataFrame([tuple("x" for _ in schema.fields)], schema)
    source = source.withColumns({c: F.expr(sql) for c, sql in flag.items() if c in source.columns})
    got = recipes.rows_of(recipe, source, "somewhere", "v1", "2024-01-01 00:00:00")
    assert got.schema.simpleString() == schema_of(recipe.table).simpleString()
    got.collect()


def test_load_appends_once(spark):
    source = spark.createDataFrame(
        [("Acme Ltd", "NO", "1"), ("Acme Ltd", "NO", "1"), ("Beta", None, None)],
        "name string, jurisdiction string, registration_number string",
    ).withColumns({"data_source": F.lit("a"), "data_source_link": F.lit("b"), "pure_name": F.lower("name")})
    for table, recipe in (
        ("h_company", recipes.RECIPES["h_company/register"]),
        ("s_company_address", recipes.RECIPES["s_company_address/register"]),
    ):
        contract = contract_of(table, "/lake")
        first = recipes.load(recipe, None, source, contract, load_ts="2024-01-01 00:00:00")
        assert first.count() == 2
        assert recipes.load(recipe, first, source, contract, load_ts="2024-02-01 00:00:00").count() == 0


def test_wide_rows_become_companies(spark):
    source = spark.createDataFrame(
        [("Imp", "N1", "Exp", None, "Ship"), ("Imp", "N1", "Exp", "Peru", None)],
        "name_import string, regis_import string, name_export string, jurisdiction string, shipper_company string",
    )
    got = recipes.rows_of(recipes.RECIPES["h_company/colombia_import"], source, "trade")
    assert rows(got.where("name is not null"), "name", "jurisdiction", "registration_number", "has_regnum") == [
        ("Exp", "Peru", None, 0), ("Exp", "unspecified", None, 0), ("Imp", "Colombia", "N1", 1),
        ("Ship", "unspecified", None, 0),
    ]


def test_shipments_by_name_keep_unknown_parties(spark):
    ship = spark.createDataFrame(
        [("b1", "acme", "NO", "beta", "BD"), ("b2", "none", "NO", "beta", "XX")],
        "bol string, pure_seller string, seller_country string, pure_buyer string, buyer_country string",
    )
    companies = spark.createDataFrame(
        [("h1", "acme", "NO"), ("h2", "beta", "BD")],
        "dv_hashkey_company string, pure_name string, jurisdiction string",
    )
    got = recipes.shipments_by_name(ship, companies, companies.where("jurisdiction = 'BD'"), "buyer")
    assert rows(got, "bol", "supplier_dv_hashkey_company", "buyer_dv_hashkey_company") == [
        ("b1", "h1", "h2"), ("b2", "CANT MAP", "CANT MAP"),
    ]


def test_sanction_links_with_and_without_hub(spark):
    satellite = spark.createDataFrame([("c1", "s1"), ("c2", "s9")], "dv_hashkey_company string, sanction_id string")
    hub = spark.createDataFrame([("hs1", "s1")], "dv_hashkey_sanction string, sanction_id string")
    got = recipes.mapped_sanction_links(satellite, hub, "dv_hashkey_company")
    assert rows(got, "dv_hashkey_company", "dv_hashkey_sanction") == [("c1", "hs1"), ("c2", "CANT MAP")]


def test_us_ports_out_of_text(spark):
    df = spark.createDataFrame(
        [("57035, Shanghai, China", "2704, Los Angeles", "x"), ("57035", "2704", "CN, China, Asia")],
        "loading_port string, unloading_port string, country string",
    )
    got = recipes.us_import_ports(df)
    assert rows(got, "loading_port_code", "loading_port_name", "unloading_port_code") == [
        ("57035", "Shanghai, China, ", "2704"), ("57035", "Unknown, China, Asia", "2704"),
    ]


def test_new_york_addresses(spark):
    df = spark.createDataFrame(
        [("1", "ACME", "06/11/2024", "Kings", "New York", "LLC", "Ann", "1 Road", "NYC", None, "2 Way", None)],
        "`DOS ID` string, `Current Entity Name` string, `Initial DOS Filing Date` string, County string, "
        "Jurisdiction string, `Entity Type` string, `CEO Name` string, `CEO Address 1` string, `CEO City` string, "
        "`DOS Process Name` string, `Location Address 1` string, `Registered Agent City` string",
    )
    row = bronze.new_york(df, "2024-06-11").first()
    assert (row["ceo_full_address"], row["location_full_address"], row["registered_agent_full_address"]) == (
        "1 Road, NYC", "2 Way", None,
    )
    assert str(row["date_incorporated"]) == "2024-06-11" and row["is_branch"] is False


def test_kentucky_agents(spark):
    columns = (
        "`Organization Number` string, Name string, `Company Type` string, Status string, State string, "
        "`File Date` string, `Authority Date` string, `Organization Date` string, `Expiration Date` string, "
        "`Registered Agent` string"
    )
    agent = "['ANN LEE', '12 MAIN ST', 'TOWN']"
    df = spark.createDataFrame(
        [("7", "ACME", "KCO - Corporation", "A - Active", "KY", None, "3/4/2020", "1/1/2019", None, None),
         ("7", "ACME", "KCO - Corporation", "A - Active", "KY", None, None, "1/1/2019", None, agent)],
        columns,
    )
    got = bronze.kentucky(df)
    assert rows(got, "full_name", "full_address", "registration_number", "position_code", "is_person") == [
        ("ANN LEE", "12 MAIN ST, TOWN", "7", 4, True)
    ]


def test_newfoundland_directors(spark):
    office, outside = "registered_office", "registered_office_outside_nl"
    names = (
        ["business_type", "company_name", "company_number", "corporation_type"]
        + [f"director_{n}" for n in range(1, 9)]
        + ["incorporation_date", "registration_date", "status"]
        + [f"{office}_{p}" for p in ("address_1", "address_2", "address_3", "postal_zip_code", "province_state")]
        + [f"{outside}_{p}" for p in ("address_1", "address_2", "city", "postal_zip_code", "country")]
    )
    data = dict.fromkeys(names)
    data |= {
        "business_type": "Foreign", "company_name": "Acme Ltd.", "corporation_type": "N/A",
        "director_1": "Ann  ", "director_2": "Elected 2020", "registration_date": "2020-05-06",
        "status": "Dissolved - Voluntary", f"{office}_address_1": "1 Road",
    }
    df = spark.createDataFrame([tuple(data[n] for n in names)], ", ".join(f"{n} string" for n in names))
    got = bronze.newfoundland(df, "2024-12-31")
    assert got.count() == 8
    row = got.where("officer_name = 'Ann'").first()
    assert (row["legal_form"], row["is_branch"], row["status_code"]) == ("Foreign", False, 1)
    assert (row["main_full_address"], row["mailing_full_address"], row["pure_name"]) == ("1 Road", None, "acme ltd")
    assert str(row["date_incorporated"]) == "2020-05-06"


def test_turkey_last_alert(spark):
    details = spark.sql(
        """select * from values ('1', array('Open', 'KAPALI.')), ('2', array('kapalı', 'x')), ('3', array())
           as t(key, alerts)"""
    ).selectExpr(
        "key",
        """named_struct('CompanyTitle', 't', 'BusinessIssueOfTheFirm', 'b', 'DateOfEstablishmentReg', 'd',
           'Alerts', transform(alerts, x -> replace(x, 'KAPALI', 'Kapalı')), 'OfficeAddress', 'o',
           'NaceCodes', 'n', 'ProfessionalGroup', 'p', 'FaxNumber', 'f', 'PhoneNumber', 'q',
           'WebPageLink', 'w') as data""",
    )
    other = spark.sql("select '1' as key, 'v' as data")
    got = bronze.turkey(details, other, other, "2024")
    assert rows(got, "registration_number", "status", "employee") == [
        ("1", "inactive", "v"), ("2", "active", None), ("3", "active", None),
    ]


def test_taiwan_takes_the_latest_row(spark):
    df = spark.createDataFrame(
        [("1", "old", "核准", "2020"), ("1", "new", "核准", "2021")],
        "`統一編號` string, `公司名稱` string, `公司狀態` string, `產製日期` string",
    )
    assert rows(bronze.taiwan(df, {"核准": "Approved"}), "name", "status") == [("new", "Approved")]


def test_colombia_imports(spark):
    names = list(bronze.COLOMBIA_TRADE)
    base = dict.fromkeys(names, "1")
    base |= {"EMAIL_EXPORTADOR": "a@b.co", "PAIS_EXPORTADOR": "ZONA FRANCA", "UNIDAD_COMERCIAL": "Par",
             "FECHA_MANIFIESTO": "20200506.0", "CANTIDAD": "7"}
    other = base | {"UNIDAD_COMERCIAL": "Litro", "PAIS_EXPORTADOR": "CUBA", "EMAIL_EXPORTADOR": "Fax 55"}
    year = lambda r: spark.createDataFrame([tuple(r[n] for n in names)] * 2, ", ".join(f"{n} string" for n in names))
    lookup = spark.sql("select 'Colombia' as jurisdiction, 'CO' as country_code, 'Colombia' as country_name")
    got = bronze.colombia_imports([year(base), year(other)], lookup, "2024")
    assert rows(got, "email_export_std", "fax_export", "jurisdiction", "quantity_unit", "quantity", F.col("actual_arrival_date").cast("string")) == [
        ("a@b.co", None, "Colombia", "Pair", 7.0, "2020-05-06"), (None, "Fax 55", None, None, None, "2020-05-06"),
    ]


def test_seo_listing_places(spark):
    names = ["title", "contacts", "category_ids", "additional_categories", "url", "description",
             "`address_info.region`", "`address_info.country_code`"]
    contacts = '[{"type":"Mail","value":"a@b.c","source":"site"}]'
    df = spark.createDataFrame(
        [("Acme", contacts, "[x,y]", "null", "https://www.facebook.com/a", "d\ne", "TX", "US"),
         ("Beta", None, "null", "null", "https://b.no", None, None, "NO"),
         ("Nowhere", None, None, None, None, None, None, None)],
        ", ".join(f"{n} string" for n in names),
    )
    lookup = spark.createDataFrame(
        [("Norway", "Norway", "NO", "Kingdom of Norway"), ("United States", "US.Texas", "US", "USA")],
        "country_name string, jurisdiction string, alpha2_code string, official_name string",
    )
    got = bronze.seo_listing(df, lookup, "2024")
    assert rows(got, "name", "jurisdiction", "mail", "facebook_url", "website", "description") == [
        ("Acme", "US.Texas", "a@b.c", "https://www.facebook.com/a", None, "d e"),
        ("Beta", "Norway", "", None, "https://b.no", None),
    ]


def test_trade_feed_ports_and_hashes(spark):
    df = spark.createDataFrame(
        [("norway", "peru", "S", " oslo ", "Lima", "Imp", "Exp", "20240102", "p", "1", "u", "2", "kg", "84")],
        "import_country string, export_country_or_area string, data_source string, unloading_port string, "
        "loading_port string, importer string, exporter string, date string, products string, quantity string, "
        "unit_of_quantity string, weight string, unit_of_weight string, hs_code string",
    )
    ports = spark.createDataFrame(
        [("P1", "Oslo", None, "h1"), ("unspecified, Peru", "unspecified, Peru", None, "h2")],
        "port_code string, port_name string, previous_port_name string, dv_hashkey_port string",
    )
    got = bronze.trade_feed(
        df, ports, {"Norway": "Norway", "Peru": "Peru"}, {"S": "Source"}, "feed;link", "2024"
    )
    assert rows(got, "import_port", "export_port", "port_code_export", "actual_arrival_date", "weight_unit", "data_source") == [
        ("h1", "h2", "unspecified, Peru", "2024-01-02", "KG", "Source")
    ]


def test_sanction_lists(spark):
    company = spark.sql(
        """select 'c1' as id, 'Acme Ltd' as caption, 'Company' as schema, named_struct(
           'country', array('ru', 'by'), 'topics', array('sanction', 'linked'), 'name', array('Acme'),
           'alias', array('Acme', 'A'), 'innCode', array('1', '2'), 'notes', array('n')) as properties"""
    )
    row = bronze.sanction_company(company).first()
    assert (row["jurisdiction"], row["inn_code"], row["is_sanctioned"]) == ("ru", "1-2", True)
    assert row["other_names"] == ["Acme", "A"] and row["description_full"] == "Note: n"
    organisation = company.withColumn("schema", F.lit("Organization"))
    assert bronze.sanction_company(organisation, "Organization").first()["is_sanctioned"] is False
    edge = spark.sql(
        """select 'e1' as id, 'Vice director' as caption, 'Employment' as schema, named_struct(
           'employee', array('p'), 'employer', array('c'), 'startDate', array('2020-05'), 'endDate', array('2021')) as properties"""
    )
    got = bronze.sanction_edge(edge, "employment").first()
    assert (got["from_entity_id"], got["to_entity_id"], str(got["start_date"]), str(got["end_date"])) == (
        "p", "c", "2020-05-01", "2021-01-01",
    )
    assert (got["position"], got["position_code"]) == ("Director", 1)
    person = spark.sql(
        """select 'p1' as id, 'Ann' as caption, 'Person' as schema, named_struct('gender', array('female'),
           'country', cast(array() as array<string>), 'name', array('Ann'), 'topics', array('x')) as properties"""
    )
    got = bronze.sanction_person(person).first()
    assert (got["gender_numeric"], got["country_name"], got["is_sanctioned"]) == (1, "Unknown", False)
    assert got["description_full"] == "description: \nNote: \nSummary: \nPosition: \nEducation: "


def test_staging_uses_the_session_folder(spark, monkeypatch):
    from ledgerloom.sources import staging

    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging.new_location(spark, "x").startswith(folder)

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    assert staging.shared_folder(Session("local[2]")) == staging.shared_folder(Session("local[4]"))
    with pytest.raises(RuntimeError):
        staging.shared_folder(Session("yarn"))


def test_shipments_hash_their_own_columns(spark):
    ship = spark.createDataFrame(
        [("Imp A/S", "N1", "Exp", None), ("Imp A/S", None, None, "Peru")],
        "name_import string, regis_import string, name_export string, jurisdiction string",
    )
    ports = spark.createDataFrame(
        [("unspecified, Colombia", "p1"), ("unspecified, Peru", "p2")], "port_code string, dv_hashkey_port string"
    )
    place = "coalesce(jurisdiction, 'unspecified')"
    got = recipes.shipments_of_columns(
        ship,
        {"buyer": ("name_import", "'Colombia'", "regis_import"), "supplier": ("name_export", place, None),
         "shipper": ("name_export", "'unspecified'", None)},
        {"import": ("'unspecified, Colombia'", ports), "export": (f"concat('unspecified, ', {place})", ports)},
    )
    want = spark.sql("select md5('Colombia;N1;imp as') as a, md5('Colombia;imp as') as b").first()
    assert sorted(r[0] for r in got.select("buyer_dv_hashkey_company").collect()) == sorted(want)
    assert rows(got, "import_port", "export_port") == [("p1", "p2"), ("p1", None)]
    assert got.select("dv_hashkey_l_bol").distinct().count() == 2


def test_sanctioned_entities_without_record_stay(spark):
    entities = spark.createDataFrame(
        [("NO", "7", True), ("SE", "8", True), ("DK", "9", False)],
        "country_name string, id_number string, is_sanctioned boolean",
    )
    records = spark.createDataFrame([("7", "UN", "p")], "id string, authority string, program string")
    joined = recipes.sanctioned_entities(entities, records, "company")
    got = recipes.rows_of(recipes.RECIPES["s_sanction/company"], joined, "list")
    assert rows(got, "id", "sanction_id", "authority", "source_schema") == [
        ("7", "7", "UN", "company"), ("8", None, None, "company"),
    ]
    parties = spark.createDataFrame([("7", "h7")], "id string, dv_hashkey_company string")
    links = recipes.sanction_links(joined, parties, "id", "id", "dv_hashkey_company")
    assert links.count() == 1


def test_industry_takes_the_country_of_its_jurisdiction(spark):
    df = spark.createDataFrame([("Norway", "01", "xx"), ("Mars", "02", "yy")], "jurisdiction string, industry_code string, country_code string")
    lookup = spark.createDataFrame([("Norway", "NO"), ("Norway", "NO2")], "jurisdiction string, country_code string")
    got = recipes.with_country_code(df, lookup)
    assert rows(got, "jurisdiction", "country_code") == [("Mars", None), ("Norway", "NO")]


def test_register_rows_get_their_place(spark):
    df = spark.createDataFrame(
        [("ann b. lee", "texas", "us", "US", "1"), (None, "x", "us", "US", "2"), ("bo", None, None, None, "3")],
        "name string, jurisdiction string, country_name string, country_code string, id string",
    )
    lookup = spark.createDataFrame([("US", "US.Texas")], "country_name string, jurisdiction string")
    second = spark.createDataFrame([("zz", "Zed")], "jurisdiction string, country string")
    got = bronze.register_person(df, lookup, second, "2024")
    assert rows(got, "name", "jurisdiction") == [("Ann B. Lee", "US.Texas"), ("Bo", "Unknown")]


US_IMPORT = (
    "bill_of_lading string, loading_port string, unloading_port string, country string, state string, "
    "raw_shipper_name string, raw_consignee_name string, hs_code string, weight_in_kg string"
)
PORTS = "port_code string, port_name string, decimal string, state string, terminal string"


def us_rows(spark):
    df = spark.createDataFrame(
        [
            ("b1", "57035, Shanghai, China", "2704, Los Angeles", "CN, China, Asia", "CA", "Sea-Co", "Buy Inc", "1234", "5"),
            ("b2", "57035", "2704", "CN", "NY", "Sea Co", None, "12345678", None),
            ("b3", "1, A", "9999, Nowhere", "CN", "NY", "x", "y", None, None),
        ],
        US_IMPORT,
    )
    ports = spark.createDataFrame(
        [("2704", "Los Angeles", "33.7 , -118.2", "CA", "true"), ("2704", "LA again", None, None, None), ("1", None, None, None, None)],
        PORTS,
    )
    return df.selectExpr("*", "'1' as teu", "'things' as product_desc"), ports


def test_us_shipments_keep_known_ports_only(spark):
    got = {r["bill_of_lading"]: r for r in recipes.us_shipments(*us_rows(spark)).collect()}
    assert set(got) == {"b1", "b2"}
    assert got["b1"]["jurisdiction_supplier"] == "China, Asia" and got["b2"]["jurisdiction_supplier"] == "Unknown"
    assert [got[b]["jurisdiction_buyer"] for b in ("b1", "b2")] == ["CA", "NY"]
    assert {r["weight_unit"] for r in got.values()} == {"KG"}
    satellite = recipes.rows_of(recipes.RECIPES["s_bol/us_import"], recipes.us_shipments(*us_rows(spark)))
    refs = {r["bol"]: r["hs_code_ref"] for r in satellite.collect()}
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert refs == {"b1": md5("1234"), "b2": md5("12345678United States")}


def test_us_links_hash_parties_and_ports(spark):
    md5 = lambda *parts: hashlib.md5(";".join(parts).encode()).hexdigest()
    got = {r["bol"]: r for r in recipes.us_shipment_links(*us_rows(spark)).collect()}
    assert got["b1"]["supplier_dv_hashkey_company"] == md5("China, Asia", "seaco")
    assert got["b1"]["buyer_dv_hashkey_company"] == md5("CA", "buy inc")
    assert got["b1"]["export_port"] == md5("57035", "Shanghai, China, China, Asia")
    assert got["b1"]["import_port"] == got["b2"]["import_port"]
    assert got["b2"]["buyer_dv_hashkey_company"] == md5("NY")


def test_loaded_ports_are_in_force(spark):
    from ledgerloom.operators import merge

    rows = recipes.rows_of(
        recipes.RECIPES["s_port/us_import"], recipes.us_ports(*us_rows(spark)), "us", load_ts="2024-05-02 00:00:00"
    )
    assert merge.valid_at(rows, "2024-04-30").count() == 0
    now = {(r["port_code"], r["port_name"]): r for r in merge.valid_at(rows, "2024-05-01").collect()}
    assert ("2704", "LA again") in now or ("2704", "Los Angeles") in now
    assert ("57035", "Unknown, ") in now and ("57035", "Shanghai, China, China, Asia") in now
    assert all(r["dv_status"] == 1 and r["dv_valid_to"] is None for r in now.values())


def test_export_shipments_take_the_ports_code(spark):
    df = spark.createDataFrame([("Chittagong", "Bangladesh"), ("Dhaka", "Bangladesh")], "seller_port string, seller_country string")
    ports = spark.createDataFrame(
        [("Chittagong", "Bangladesh", "10"), ("Chittagong", "India", "11")], "port_name string, country_name string, port_code string"
    )
    assert rows(recipes.export_shipments(df, ports), "seller_port", "seller_port_code") == [
        ("Chittagong", "10"), ("Dhaka", None),
    ]
