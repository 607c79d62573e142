import datetime

from pyspark.sql import functions as F

from ledgerloom.functions import arrays, codes, contacts, dates, fixed, text
from ledgerloom.functions.keys import hash_key, hash_of, with_hash_diff
from ledgerloom.operators import frames


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_clean_text_in_order(spark):
    rows = [("a\n\tb",), ("x , , y",), ("wow!!! ok..",), ("end  .",), ("   ",), (None,), ("a,,b",)]
    got = values(spark, rows, "s string", text.clean_text("s"))
    assert got == [("a b",), ("x, y",), ("wow! ok.",), ("end.",), (None,), (None,), ("a,b",)]


def test_pure_name_keeps_letters_of_all_scripts(spark):
    rows = [("  ABC & Co., Ltd. ",), ("Công-ty  TNHH",), ("Общество №1",), (None,), ("***",)]
    got = values(spark, rows, "s string", text.pure_name("s"))
    assert got == [("abc co ltd",), ("côngty tnhh",), ("общество 1",), (None,), ("",)]


def test_legal_form_longest_suffix_then_prefix(spark):
    rows = [
        ("acme co ltd",), ("acme private limited company",), ("inc acme",), ("inc acme llc",),
        ("llc",), ("acmellc",), ("acme g m b h",), (None,), ("acme co c o",),
    ]
    got = values(spark, rows, "s string", text.strip_legal_form("s").alias("x"))
    plain = [(r[0]["regexed_name"], r[0]["pure_name_replaced_by"]) for r in got]
    assert plain == [
        ("acme", "suffix"), ("acme", "suffix"), ("acme", "prefix"), ("inc acme", "suffix"),
        ("llc", None), ("acmellc", None), ("acme", "suffix"), (None, None), ("acme co", "suffix"),
    ]


def test_legal_forms_are_unique_and_longest_first():
    forms = fixed.legal_suffixes()
    assert len(forms) == len(set(forms))
    assert [len(f) for f in forms] == sorted((len(f) for f in forms), reverse=True)


def test_full_name_parts(spark):
    rows = [("Ann",), ("Ann Lee",), ("Ann B Lee",), ("Ann B C D Lee",), (None,)]
    got = [r[0] for r in values(spark, rows, "s string", text.first_name_last_name("s").alias("n"))]
    assert [(n["first_name"], n["middle_name"], n["last_name"]) for n in got] == [
        ("Ann", None, "Ann"), ("Ann", None, "Lee"), ("Ann", "B", "Lee"), ("Ann", "B C D", "Lee"),
        (None, None, None),
    ]


def test_person_name_after_first_dot(spark):
    rows = [("JOHN q. public-smith",), ("mary 2nd",), ("dr.who is.it",), (None,)]
    got = values(spark, rows, "s string", text.person_name("s"))
    assert got == [("John Q. Public-smith",), ("Mary Nd",), ("Dr.Who Is.it",), (None,)]


def test_partial_and_compact_dates(spark):
    rows = [("2020-05-06",), ("2020-05",), ("2020",), ("20200506.0",), ("2020050",), ("x",), (None,)]
    got = values(spark, rows, "s string", dates.partial_date("s"), dates.compact_date("s"))
    day = datetime.date
    assert got[:3] == [
        (day(2020, 5, 6), None), (day(2020, 5, 1), None), (day(2020, 1, 1), None),
    ]
    assert got[3][1] == day(2020, 5, 6)
    assert got[4:] == [(None, None), (None, None), (None, None)]


def test_contact_precedence(spark):
    rows = [
        ("a(AT)b.com",), ("www.b.com/x",), ("FAX 123",), ("12-34",), ("12",), ("call me",), (None,),
    ]
    got = [r[0] for r in values(spark, rows, "s string", contacts.classify_contact("s").alias("c"))]
    assert [(c["email"], c["url"], c["fax"], c["phone"]) for c in got] == [
        ("a@b.com", None, None, None), (None, "www.b.com/x", None, None), (None, None, "123", None),
        (None, None, None, "12-34"), (None, None, None, None), (None, None, None, None),
        (None, None, None, None),
    ]


def test_person_classifier(spark):
    rows = [("ANN LEE",), ("ACME INC.",), ("A & B",), ("UNIT 7",), ("OFFICER JOE",), (None,)]
    got = values(spark, rows, "s string", contacts.is_person("s"))
    assert [r[0] for r in got] == [True, False, False, False, True, True]


def test_agent_from_printed_list(spark):
    rows = [("['ANN LEE', '12 MAIN ST', 'TOWN']",), ("['ANN', 'C/O X']",), ("['OAK STREET', '1 A']",)]
    got = [r[0] for r in values(spark, rows, "s string", contacts.agent_from_list("s").alias("a"))]
    assert [(a["agent_name"], a["agent_address"]) for a in got] == [
        ("ANN LEE", "12 MAIN ST, TOWN"), (None, "C/O X"), (None, "1 A"),
    ]


def test_role_order_and_default(spark):
    rows = [("CEO and founder",), ("Co-founder",), ("clerk",), (None,)]
    got = [r[0] for r in values(spark, rows, "s string", codes.role_position("s").alias("r"))]
    assert [(r["position"], r["position_code"]) for r in got] == [
        ("Director", 1), ("Beneficial Owner", 2), ("clerk", 0), (None, 0),
    ]


def test_strict_translation_fails_in_the_plan(spark):
    df = spark.createDataFrame([("a",), (None,)], "s string")
    assert codes.untranslated(df, "s", {"a": "A"}).count() == 0
    assert {r[0] for r in codes.require_translation(df, "s", {"a": "A"}).collect()} == {"A", None}
    missing = spark.createDataFrame([("b",)], "s string")
    try:
        codes.require_translation(missing, "s", {"a": "A"}).collect()
    except Exception as problem:
        assert "no translation of s: b" in str(problem)
    else:
        raise AssertionError("an untranslated value must fail")


def test_arrays_of_missing_values(spark):
    df = spark.createDataFrame([([], None)], "a array<string>, b array<string>")
    row = df.select(
        arrays.first_item("a"), arrays.joined("b"), arrays.union_names("a", "b"),
        arrays.has_topic("b", "sanction"),
    ).first()
    assert tuple(row) == (None, None, [], False)


def test_hash_skips_nulls_unless_told(spark):
    df = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    row = df.select(
        hash_of("x", "y", "z"), hash_of("x", "z"), hash_of("x", "y", "z", null_token="")
    ).first()
    assert row[0] == row[1] != row[2]


def test_hash_key_by_name_and_alias(spark):
    df = spark.createDataFrame([("NO", "1", "acme")], "jurisdiction string, registration_number string, pure_importer string")
    row = df.select(hash_key("company", pure_name="pure_importer"), F.md5(F.lit("NO;1;acme"))).first()
    assert row[0] == row[1]


def test_hash_diff_of_nested_values_ignores_audit(spark):
    rows = [("s1", ["a", None], {"k": "v"}, 1), ("s2", ["a", None], {"k": "v"}, 1)]
    df = spark.createDataFrame(rows, "dv_recsrc string, a array<string>, m map<string,string>, n int")
    assert with_hash_diff(df).select("dv_hashdiff").distinct().count() == 1


def test_snake_case_names():
    assert [frames.snake_case(n) for n in (" DOS ID", "entityName", "a.b  C", "HSCode2Digit")] == [
        "dos_id", "entity_name", "a_b_c", "hscode2_digit",
    ]


def test_explode_only_what_is_asked(spark):
    df = spark.sql("select 1 as id, named_struct('a', array(1, 2), 'b', array(3, 4, 5)) as properties")
    assert frames.flatten_properties(df).count() == 1
    assert frames.flatten_properties(df, explode=["a"]).count() == 2
    assert frames.flatten_properties(df, explode=["a", "b"]).count() == 6


def test_flatten_deep_structs(spark):
    df = spark.sql("select 1 as id, named_struct('a', named_struct('b', 2, 'c', array(1))) as s")
    flat = frames.flatten_structs(df)
    assert flat.columns == ["id", "s_a_b", "s_a_c"]
    assert tuple(flat.first()) == (1, 2, [1])
