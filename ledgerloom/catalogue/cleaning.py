"""Projection, cleaning and standardisation."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.catalogue.registry import query, table
from ledgerloom.catalogue.samples import COMPANY, companies, pure_sql, stripped_sql
from ledgerloom.functions import arrays, codes, contacts, dates, fixed, text
from ledgerloom.functions.keys import audit_columns
from ledgerloom.operators import frames
from ledgerloom.plans import bronze


def _clean_sql(column):
    value = rf"regexp_replace({column}, '[\n\r\t]', ' ', 'g')"
    value = f"replace({value}, ', ,', ',')"
    for mark in ".,!?;:":
        value = rf"regexp_replace({value}, '[{mark}]+', '{mark}', 'g')"
    value = rf"regexp_replace({value}, '\s+([.,!?;:])', '\1', 'g')"
    value = rf"regexp_replace({value}, '\s{{2,}}', ' ', 'g')"
    return f"nullif(trim({value}), '')"


@query(
    "clean_strings",
    f"""select doc_id, {_clean_sql('text')} as text, {_clean_sql('lang')} as lang,
        {_clean_sql('source')} as source, n_chars from documents""",
)
def clean_strings(spark, sf_dir):
    return frames.clean_strings(table(spark, sf_dir, "documents"))


@query(
    "clean_pages",
    f"select page_id, {_clean_sql('url')} as url, {_clean_sql('html')} as html from pages",
)
def clean_pages(spark, sf_dir):
    return frames.clean_strings(table(spark, sf_dir, "pages"))


@query(
    "blank_and_sentinel_nulls",
    """select c_custkey, case when c_mktsegment = 'BUILDING' then null else c_mktsegment end
        as segment, case when c_mktsegment in ('MACHINERY', 'FURNITURE') then null
        else c_name end as label from customer""",
)
def blank_and_sentinel_nulls(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "case when c_mktsegment = 'BUILDING' then '   ' else c_mktsegment end as segment",
        "case c_mktsegment when 'MACHINERY' then 'N/A' when 'FURNITURE' then 'x x' "
        "else c_name end as label",
    )
    return frames.sentinels_to_null(frames.blanks_to_null(raw))


@query("pure_name", f"select doc_id, {pure_sql('text')} as pure_name from documents")
def pure_name(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.pure_name("text").alias("pure_name"))


@query(
    "suffix_strip",
    f"""with {COMPANY}, named as (select source, k, {pure_sql('name')} as pure_name from company
        union all select 'prefixed', k, concat('llc ', lower(segment), ' ', k) from company
        union all select 'page', page_id, {pure_sql('url')} from pages)
    select source, k, pure_name, {stripped_sql('pure_name')[0]} as regexed_name,
        {stripped_sql('pure_name')[1]} as pure_name_replaced_by from named""",
)
def suffix_strip(spark, sf_dir):
    company = companies(spark, sf_dir)
    named = (
        company.select("source", "k", text.pure_name("name").alias("pure_name"))
        .union(company.selectExpr("'prefixed'", "k", "concat('llc ', lower(segment), ' ', k)"))
        .union(
            table(spark, sf_dir, "pages").select(F.lit("page"), "page_id", text.pure_name("url"))
        )
    )
    stripped = named.select("*", text.strip_legal_form("pure_name").alias("s"))
    return stripped.select("source", "k", "pure_name", "s.*")


@query(
    "snake_case_columns",
    "select page_id, url as page_url, length(html) as html_char_count from pages",
)
def snake_case_columns(spark, sf_dir):
    raw = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias(" Page.Id "), F.col("url").alias("pageUrl"),
        F.length("html").cast("bigint").alias("Html charCount"),
    )
    return frames.snake_case_columns(raw)


@query(
    "schema_contract",
    """select c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
        try_cast(c_mktsegment as integer) as c_mktsegment, cast(null as date) as founded
    from customer""",
)
def schema_contract(spark, sf_dir):
    """Declared columns cast, a missing one added, the undeclared balance dropped."""
    schema = StructType.fromDDL(
        "c_custkey bigint, c_name string, c_nationkey string, c_mktsegment int, founded date"
    )
    return frames.enforce_schema(table(spark, sf_dir, "customer"), schema)


def _event_structs(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "named_struct('type', event_type, 'detail', named_struct('user', user_id, 'k', "
        "cast(get_json_object(props, '$.k') as bigint))) as data",
    )


@query(
    "flatten_struct",
    """select event_id, event_type as data_type, user_id as data_detail_user,
        cast(json_extract_string(props, '$.k') as bigint) as data_detail_k from events""",
)
def flatten_struct(spark, sf_dir):
    return frames.flatten_structs(_event_structs(spark, sf_dir))


@query(
    "nested_path",
    """select event_id, user_id as owner, cast(json_extract_string(props, '$.k') as bigint) as k
    from events""",
)
def nested_path(spark, sf_dir):
    return frames.project_paths(
        _event_structs(spark, sf_dir),
        {"event_id": "event_id", "owner": "data.detail.user", "k": "data.detail.k"},
    )


@query(
    "explode_properties",
    """select event_id, event_type as caption, unnest(case when user_id % 5 = 0 then [null]
        else [event_type, cast(user_id as varchar)] end) as alias from events""",
)
def explode_properties(spark, sf_dir):
    """Struct fields lifted; one array exploded, an empty one kept as null."""
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """named_struct('caption', event_type, 'alias', case when user_id % 5 = 0
           then array() else array(event_type, cast(user_id as string)) end) as properties""",
    )
    return frames.flatten_properties(raw, explode=["alias"])


CONTACTS = """concat('[{"type":"Telephone","value":"+1-', user_id,
    '","source":"site"},{"type":"Mail","value":"u', user_id, '@x.org","source":"', event_type,
    '"},{"type":"Mail","value":"b', event_id, '@y.org","source":"backlinks"},'
    '{"type":"Mail","value":"e', event_id, '@z.org","source":"site"}]')"""


@query(
    "json_contacts",
    """select event_id, concat('+1-', user_id) as telephone,
        concat('u', user_id, '@x.org, e', event_id, '@z.org') as mail from events""",
)
def json_contacts(spark, sf_dir):
    parsed = table(spark, sf_dir, "events").select(
        "event_id", F.from_json(F.expr(CONTACTS), contacts.CONTACT_SCHEMA).alias("c")
    )
    return parsed.select(
        "event_id",
        contacts.contacts_of_type("c", "Telephone").alias("telephone"),
        contacts.contacts_of_type("c", "Mail").alias("mail"),
    )


@query(
    "json_array_roundup",
    """select user_id, array_to_string(list_sort(list(distinct n)), '|') as other_names
    from (select user_id, unnest([event_type, 'u' || (event_id % 7)]) as n from events)
    group by user_id""",
)
def json_array_roundup(spark, sf_dir):
    """Names out of a JSON array, distinct per key."""
    records = F.expr(
        """concat('[{"name":"', event_type, '","status":"A"},{"name":"u', event_id % 7, '"}]')"""
    )
    named = table(spark, sf_dir, "events").select(F.col("user_id").alias("organization_number"), records.alias("assumed_names"))
    return bronze.kentucky_other_names(named).select(
        F.col("organization_number").alias("user_id"), F.array_join("other_names", "|").alias("other_names")
    )


@query(
    "list_merge",
    """select event_id, array_to_string(string_split(case when user_id % 4 = 0
        then concat(event_type, ',', user_id) when user_id % 4 = 1 then 'null'
        else concat(event_type, ',', user_id, ' x,', event_id) end, ','), '|') as category_list
    from events""",
)
def list_merge(spark, sf_dir):
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case when user_id % 4 = 1 then 'null' else concat('[', event_type, ',', user_id, ']') end as a",
        "case when user_id % 4 > 1 then concat('[x,', event_id, ']') "
        "when user_id % 4 = 0 then 'null' end as b",
    )
    return raw.select(
        "event_id", F.array_join(contacts.merge_bracket_lists("a", "b"), "|").alias("category_list")
    )


_HOSTED = "case page_id % 5 when 0 then replace(url, 'example', 'facebook') when 1 then replace(url, 'example', 'linkedin') when 2 then 'https://x.com/u' when 3 then 'no address' else url end"


@query(
    "url_domain_class",
    rf"""with u as (select page_id, {_HOSTED} as url from pages),
    d as (select *, regexp_extract(url, 'https?://(www\.|m\.)?([^/]+)', 2) as domain from u)
    select page_id, domain,
        case when contains(domain, 'facebook') then url end as facebook_url,
        case when contains(domain, 'twitter') or domain = 'x.com' then url end as twitter_url,
        case when contains(domain, 'linkedin') then url end as linkedin_url,
        case when not (contains(domain, 'facebook') or contains(domain, 'twitter')
            or domain = 'x.com' or contains(domain, 'linkedin')) then url end as website
    from d""",
)
def url_domain_class(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").selectExpr("page_id", f"{_HOSTED} as url")
    return urls.select("page_id", contacts.classify_url("url").alias("c")).select("page_id", "c.*")


_CONTACT = """case c_custkey % 7 when 0 then concat('user', c_custkey, '@mail.example.com')
    when 1 then concat('user', c_custkey, '(at)mail.com') when 2 then concat('www.site', c_custkey, '.com/a b')
    when 3 then concat('FAX ', c_custkey, '555') when 4 then concat('+57 ', c_custkey)
    when 5 then 'not known' else concat('call ', c_custkey) end"""


@query(
    "contact_classify",
    rf"""with c as (
        select 'customer' as origin, c_custkey as id, {_CONTACT} as contact from customer
        union all select 'page', page_id, url from pages
        union all select 'turn', conv_id * 1000 + turn, text from conversations
        union all select 'supplier', s_suppkey, s_name from supplier
    ), e as (
        select *, case when regexp_matches(contact, '{fixed.EMAIL_PATTERN}') then contact end as m,
            case when regexp_matches(contact, '(?i)FAX[^\d]?\d+') then contact end as f,
            regexp_matches(contact, '{fixed.URL_PATTERN}') as is_url
        from c
    ), u as (select *, case when is_url and m is null then contact end as u from e)
    select origin, id, regexp_replace(m, '(?i)\(at\)', '@', 'g') as email, u as url,
        regexp_replace(f, '(FAX|fax)\s?', '', 'g') as fax,
        case when m is null and u is null and f is null and regexp_matches(contact, '\d')
            and not regexp_matches(contact, '[a-zA-Z]') and length(contact) >= 3
            then contact end as phone
    from u""",
)
def contact_classify(spark, sf_dir):
    rows = (
        table(spark, sf_dir, "customer")
        .selectExpr("'customer' as origin", "c_custkey as id", f"{_CONTACT} as contact")
        .union(table(spark, sf_dir, "pages").selectExpr("'page'", "page_id", "url"))
        .union(
            table(spark, sf_dir, "conversations").selectExpr("'turn'", "conv_id * 1000 + turn", "text")
        )
        .union(table(spark, sf_dir, "supplier").selectExpr("'supplier'", "s_suppkey", "s_name"))
    )
    return rows.select("origin", "id", contacts.classify_contact("contact").alias("c")).select(
        "origin", "id", "c.*"
    )


_PERSON = """case p_partkey % 4 when 0 then p_name when 1 then concat(p_name, ' llc.')
    when 2 then concat(p_name, ' & sons') else concat('Agents, ', p_name) end"""


@query(
    "person_or_org",
    rf"""with n as (select p_partkey as id, {_PERSON} as name from part
        union all select -1 - doc_id, text from documents)
    select id, not (regexp_matches(regexp_replace(upper(name), '[.,]', '', 'g'),
        '\b(?:{'|'.join(fixed.ORGANISATION_WORDS)})\b')
        or regexp_matches(name, '[0-9&|#]')) as is_person from n""",
)
def person_or_org(spark, sf_dir):
    names = (
        table(spark, sf_dir, "part")
        .selectExpr("p_partkey as id", f"{_PERSON} as name")
        .union(table(spark, sf_dir, "documents").selectExpr("-1 - doc_id", "text"))
    )
    return names.select("id", contacts.is_person("name").alias("is_person"))


_AGENT = """concat('[''', s_name, case s_suppkey % 3 when 0 then ' ST.' else '' end, ''', ''',
    case s_suppkey % 2 when 0 then concat(s_suppkey, ' MAIN') else 'Attention' end,
    ''', ''Town ', s_nationkey, ''']')"""


@query(
    "extract_list_text",
    f"""with a as (select s_suppkey, {_AGENT.replace('??', '')} as agent from supplier)
    select s_suppkey, case when s_suppkey % 2 = 0 and s_suppkey % 3 <> 0 then s_name end as agent_name,
        concat(case s_suppkey % 2 when 0 then concat(s_suppkey, ' MAIN') else 'Attention' end,
            ', Town ', s_nationkey) as agent_address,
        replace(replace(replace(agent, '[', ''), ']', ''), '''', '') as principal
    from a join supplier using (s_suppkey)""",
)
def extract_list_text(spark, sf_dir):
    agent = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.concat(
            F.lit("['"), "s_name", F.expr("case s_suppkey % 3 when 0 then ' ST.' else '' end"),
            F.lit("', '"),
            F.expr("case s_suppkey % 2 when 0 then concat(s_suppkey, ' MAIN') else 'Attention' end"),
            F.lit("', 'Town "), F.col("s_nationkey").cast("string"), F.lit("']"),
        ).alias("agent"),
    )
    return agent.select(
        "s_suppkey",
        contacts.agent_from_list("agent").alias("a"),
        contacts.printed_list_as_text("agent").alias("principal"),
    ).select("s_suppkey", "a.*", "principal")


_FULL = """case p_partkey % 4 when 0 then p_brand when 1 then p_name
    when 2 then concat(p_name, ' jr') else concat(p_name, ' ', p_type, ' of x') end"""


@query(
    "name_split",
    f"""with w as (select p_partkey, string_split({_FULL}, ' ') as w from part)
    select p_partkey, w[1] as first_name, w[len(w)] as last_name,
        case when len(w) > 2 then array_to_string(w[2:len(w)-1], ' ') end as middle_name from w""",
)
def name_split(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_FULL} as name")
    return names.select("p_partkey", text.first_name_last_name("name").alias("n")).select(
        "p_partkey", "n.*"
    )


def _initcap_sql(value):
    return (
        "array_to_string([concat(upper(w[1:1]), lower(w[2:])) "
        f"for w in string_split({value}, ' ')], ' ')"
    )


_PERSON_NAME = "case p_partkey % 3 when 0 then concat('dr.', p_name) when 1 then concat(p_name, ' 3RD-x') else concat('J. r.', p_type, '_', p_name) end"


@query(
    "name_normalise",
    f"""with k as (select p_partkey, regexp_replace(lower({_PERSON_NAME}), '[^a-zA-Z .-]', '', 'g') as n
        from part),
    i as (select p_partkey, {_initcap_sql('n')} as n from k)
    select p_partkey, case when contains(n, '.') then concat(n[1:position('.' in n)],
        {_initcap_sql("n[position('.' in n) + 1:]")}) else n end as name from i""",
)
def name_normalise(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_PERSON_NAME} as name")
    return names.select("p_partkey", text.person_name("name").alias("name"))


_DATE_TEXT = "case o_orderkey % 4 when 0 then {full} when 1 then {month} when 2 then {year} else 'unknown' end"


@query(
    "partial_dates",
    """select o_orderkey, cast(case o_orderkey % 4 when 0 then o_orderdate
        when 1 then date_trunc('month', o_orderdate) when 2 then date_trunc('year', o_orderdate) end
        as date) as day from orders""",
)
def partial_dates(spark, sf_dir):
    raw = _DATE_TEXT.format(
        full="date_format(o_orderdate, 'yyyy-MM-dd')", month="date_format(o_orderdate, 'yyyy-MM')",
        year="date_format(o_orderdate, 'yyyy')",
    )
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{raw} as day")
    return rows.select("o_orderkey", dates.partial_date("day").alias("day"))


@query(
    "compact_dates",
    """select o_orderkey, case when o_orderkey % 5 <> 4 then cast(o_orderdate as date) end as day,
        case when o_orderkey % 5 = 4 then '19-' || '-' else strftime(o_orderdate, '%Y-%m-%d') end as dashed
    from orders""",
)
def compact_dates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 5 = 4 then '19' when o_orderkey % 2 = 0 then "
        "concat(date_format(o_orderdate, 'yyyyMMdd'), '.0') else "
        "date_format(o_orderdate, 'yyyyMMdd') end as raw",
    )
    return rows.select(
        "o_orderkey", dates.compact_date("raw").alias("day"), dates.dashed_date("raw").alias("dashed")
    )


@query(
    "date_priority",
    """select o_orderkey, cast(case when o_orderkey % 3 = 0 then o_orderdate
        when o_orderkey % 3 = 1 then o_orderdate + interval 1 day
        else o_orderdate + interval 2 day end as date) as incorporated from orders""",
)
def date_priority(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 3 = 0 then date_format(o_orderdate, 'M/d/yyyy') end as file_date",
        "case when o_orderkey % 3 < 2 then date_format(date_add(o_orderdate, 1), 'M/d/yyyy') end as authority",
        "date_format(date_add(o_orderdate, 2), 'M/d/yyyy') as organization",
    )
    return rows.select(
        "o_orderkey", dates.first_date(["file_date", "authority", "organization"]).alias("incorporated")
    )


@query(
    "array_dates",
    """select o_orderkey, cast(o_orderdate as date) as single, cast(o_orderdate as date) as first_day,
        cast(o_orderdate + interval 7 day as date) as second_day from orders""",
)
def array_dates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'MM/dd/yyyy') as single",
        "array(date_format(o_orderdate, 'MM/dd/yyyy'), date_format(date_add(o_orderdate, 7), "
        "'MM/dd/yyyy')) as days",
    )
    parsed = dates.reformat_date(dates.reformat_date(rows, "single", "MM/dd/yyyy"), "days", "MM/dd/yyyy")
    return parsed.select(
        "o_orderkey", "single", F.get("days", 0).alias("first_day"), F.get("days", 1).alias("second_day")
    )


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


@query(
    "dict_translate",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high'
        when '3-MEDIUM' then 'medium' else o_orderpriority end as kept,
        case when contains(o_orderpriority, 'LOW') then 'none' else case o_orderpriority
        when '1-URGENT' then 'urgent' when '2-HIGH' then 'high' when '3-MEDIUM' then 'medium' end end
        as strict from orders""",
)
def dict_translate(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        codes.translate(priority, PRIORITIES).alias("kept"),
        codes.contains_override(
            priority, "LOW", "none", codes.translate(priority, PRIORITIES, keep_unmapped=False)
        ).alias("strict"),
    )


@query(
    "dict_strict_misses",
    """select distinct o_orderpriority from orders
    where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def dict_strict_misses(spark, sf_dir):
    return codes.untranslated(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES)


@query(
    "unit_whitelist",
    """with u as (select p_partkey, p_size, case p_brand when 'Brand#1' then 'Pair' when 'Brand#2'
        then 'Units' when 'Brand#3' then null when 'Brand#4' then null else null end as unit from part)
    select p_partkey, unit as quantity_unit, case when unit is not null then cast(p_size as float) end
        as quantity from u""",
)
def unit_whitelist(spark, sf_dir):
    raw = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "case p_brand when 'Brand#1' then 'Par' when 'Brand#2' then 'Unidades' when 'Brand#3' "
        "then 'Kilogramo' else p_brand end as unit",
        "cast(p_size as string) as quantity",
    )
    unit = codes.keep_listed(codes.translate("unit", fixed.TRADE_UNITS), fixed.COUNTABLE_UNITS)
    return raw.select(
        "p_partkey", unit.alias("quantity_unit"),
        codes.keep_if(unit.isNotNull(), F.col("quantity").try_cast("float")).alias("quantity"),
    )


_PARTS = {
    "street": "case when c_custkey % 2 = 0 then concat('Street ', c_custkey) end",
    "city": "case when c_custkey % 3 = 0 then concat('City ', c_nationkey) end",
    "state": "case when c_custkey % 5 = 0 then c_mktsegment end",
}


@query(
    "address_concat",
    f"""select c_custkey, nullif(concat_ws(', ', {', '.join(_PARTS.values())}), '') as full_address
    from customer""",
)
def address_concat(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", *[f"{sql} as {name}" for name, sql in _PARTS.items()]
    )
    return rows.select("c_custkey", text.join_address(*_PARTS).alias("full_address"))


@query(
    "description_builder",
    """select c_custkey, concat('Name: ', c_name, chr(10), 'Segment: ', coalesce(case when
        c_custkey % 2 = 0 then c_mktsegment end, ''), chr(10), 'Note: ') as description
    from customer""",
)
def description_builder(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "case when c_custkey % 2 = 0 then c_mktsegment end as segment",
        "cast(null as string) as note",
    )
    return rows.select(
        "c_custkey",
        text.describe([("Name", "c_name"), ("Segment", "segment"), ("Note", "note")]).alias("description"),
    )


@query(
    "provenance_split",
    """select page_id, case when page_id % 3 = 0 then 'crawl' else concat('site ', page_id) end
        as data_source, case when page_id % 3 = 0 then null when page_id % 3 = 1 then url
        else concat(url, ';x') end as link from pages""",
)
def provenance_split(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "case page_id % 3 when 0 then 'crawl' when 1 then concat('site ', page_id, ';', url) "
        "else concat('site ', page_id, ';', url, ';x') end as origin",
    )
    return rows.select("page_id", text.split_provenance("origin").alias("p")).select("page_id", "p.*")


_ROLE = "concat(p_type, case p_partkey % 7 when 0 then ' Director' when 1 then ' founder' when 2 then ' Shareholder' when 3 then ' employee' when 4 then ' Agent' when 5 then ' CEO' else '' end)"


@query(
    "role_codes",
    f"""with r as (select p_partkey, {_ROLE} as role from part)
    select p_partkey, case p_partkey % 7 when 0 then 'Director' when 1 then 'Beneficial Owner'
        when 2 then 'Shareholder' when 3 then 'Employee' when 4 then 'Registered Agent'
        when 5 then 'Director' else role end as position,
        cast(case p_partkey % 7 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 5
        when 4 then 4 when 5 then 1 else 0 end as integer) as position_code from r""",
)
def role_codes(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_ROLE} as role")
    return rows.select("p_partkey", codes.role_position("role").alias("r")).select("p_partkey", "r.*")


@query(
    "status_codes",
    """select o_orderkey, cast(case o_orderstatus when 'O' then 0 when 'F' then 1 else 3 end
        as integer) as status_code from orders""",
)
def status_codes(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case o_orderstatus when 'O' then 'Active (See Note)' when 'F' then 'Liquidated' "
        "else 'Pending' end as status",
    )
    return rows.select("o_orderkey", codes.status_code("status").alias("status_code"))


@query(
    "wide_to_rows",
    """select p_partkey, officer from (select p_partkey, unnest([p_name, p_brand,
        case when p_size > 25 then p_type end]) as officer from part) where officer is not null""",
)
def wide_to_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name as director_1", "p_brand as director_2",
        "case when p_size > 25 then p_type end as director_3",
    )
    return frames.columns_to_rows(
        rows, ["director_1", "director_2", "director_3"], "officer", drop_nulls=True
    )


@query(
    "alias_union",
    """select event_id, case when event_type = 'click' then concat('click|', user_id)
        else concat(event_type, '|click|', user_id) end as other_names, event_type as first_name,
        case when user_id % 2 = 0 then concat(event_type, '-', user_id) end as id_number
    from events""",
)
def alias_union(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "array(event_type) as name", "array('click', event_type) as alias",
        "cast(null as array<string>) as previous_name", "array(cast(user_id as string)) as second_name",
        "case when user_id % 2 = 0 then array(event_type, cast(user_id as string)) end as ids",
    )
    return rows.select(
        "event_id",
        F.array_join(
            arrays.union_names("name", "alias", "previous_name", "second_name"), "|"
        ).alias("other_names"),
        arrays.first_item("name").alias("first_name"),
        arrays.joined("ids").alias("id_number"),
    )


@query(
    "topic_flags",
    """select event_id, event_type in ('error', 'view') as is_sanction,
        event_type = 'error' as is_direct from events""",
)
def topic_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_type when 'error' then array('sanction') when 'view' then "
        "array('linked', 'sanction') when 'click' then array('linked') end as topics",
    )
    return rows.select(
        "event_id",
        arrays.has_topic("topics", "sanction").alias("is_sanction"),
        arrays.has_topic("topics", "sanction", without="linked").alias("is_direct"),
    )


@query(
    "reshape_columns",
    """select c_custkey as raw_id, c_name as raw_name, 'register' as raw_origin,
        cast(1 as integer) as raw_type from customer""",
)
def reshape_columns(spark, sf_dir):
    return frames.reshape(
        table(spark, sf_dir, "customer"),
        rename={"c_custkey": "id", "c_name": "name"},
        constants={"origin": "register", "type": 1},
        drop=["c_acctbal"],
        select=["id", "name", "origin", "type"],
        prefix="raw",
    )


@query(
    "audit_columns",
    """select c_custkey, concat('tpch;', c_mktsegment) as dv_recsrc, '2024-03-01 10:00:00' as dv_loaddts,
        'v2' as dv_source_version, '2024-03-01' as load_date from customer""",
)
def audit_columns_query(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        *audit_columns(F.concat(F.lit("tpch;"), "c_mktsegment"), "2024-03-01 10:00:00", "v2"),
    )
    return frames.with_load_date(
        rows.withColumn("dv_loaddts", F.col("dv_loaddts").cast("string")), "2024-03-01"
    )


@query(
    "array_wrap",
    """select c_custkey, c_mktsegment as first_category, cast(2 as integer) as n_names,
        concat(c_name, '|', c_mktsegment) as names from customer""",
)
def array_wrap(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        arrays.as_array("c_mktsegment").alias("category"),
        arrays.flatten_lists(F.array(F.array("c_name"), F.array("c_mktsegment"))).alias("names"),
    )
    return rows.select(
        "c_custkey", F.get("category", 0).alias("first_category"), F.size("names").alias("n_names"),
        F.array_join("names", "|").alias("names"),
    )
