"""Entity resolution, survivor keys and golden records."""

from pyspark.sql import functions as F

from ledgerloom.catalogue.registry import built_once, query
from ledgerloom.catalogue.samples import (
    COMPANY, LOAD_TS, RESOLVED, VERSION, companies, pure_sql, resolved_hub,
)
from ledgerloom.contract import TableContract
from ledgerloom.functions.keys import hash_key
from ledgerloom.functions.text import pure_name
from ledgerloom.operators import merge, resolve
from ledgerloom.operators.joins import anti
from ledgerloom.operators.similarity import blocking_features, levenshtein_match, matched_names
from ledgerloom.plans import golden
from ledgerloom.plans.vault import company_hub, load_history
from ledgerloom.sources.staging import staged

QUALITY = """case when regexp_replace(name, '[^a-zA-Z0-9&,. ]', '', 'g') = name then 0 else 1 end,
    length(name) desc, name, dv_hashkey_company"""
SUBJECT = ", ".join(f"t.{c}" for c in resolve.SUBJECT)
VERIFIED = ", ".join(f"v.{source} as {target}" for source, target in resolve.VERIFIED.items())

MATCHES = f"""{RESOLVED},
has_win as (select * from resolved where registration_number is not null
    qualify row_number() over (partition by jurisdiction, registration_number, regexed_name
                               order by {QUALITY}) = 1),
no_win as (select * from resolved where registration_number is null
    qualify row_number() over (partition by jurisdiction, regexed_name order by {QUALITY}) = 1),
has_has as (select {SUBJECT}, {VERIFIED},
        case when t.name <> v.name then '{resolve.HAS_HAS}' end as verify_method
    from resolved t join has_win v on t.jurisdiction = v.jurisdiction
        and t.registration_number = v.registration_number and t.regexed_name = v.regexed_name),
no_no as (select {SUBJECT}, {VERIFIED},
        case when t.name <> v.name then '{resolve.NO_NO}' end as verify_method
    from resolved t join no_win v on t.jurisdiction = v.jurisdiction
        and t.regexed_name = v.regexed_name where t.registration_number is null),
cross_win as (select * from has_has where verify_method is null
    qualify row_number() over (partition by jurisdiction, regexed_name order by {QUALITY}) = 1),
cross_sub as (select * from no_no where verify_method is null
    qualify row_number() over (partition by jurisdiction, regexed_name order by {QUALITY}) = 1),
no_has as (select {SUBJECT}, {VERIFIED}, '{resolve.NO_HAS}' as verify_method
    from cross_sub t join cross_win v on t.jurisdiction = v.jurisdiction
        and t.regexed_name = v.regexed_name),
flow as (
    select * from has_has
    union all
    select {SUBJECT},
        coalesce(n.verified_dv_hashkey_company, t.verified_dv_hashkey_company) as verified_dv_hashkey_company,
        coalesce(n.verified_registration_number, t.verified_registration_number) as verified_registration_number,
        coalesce(n.verified_regexed_name, t.verified_regexed_name) as verified_regexed_name,
        coalesce(n.verified_name, t.verified_name) as verified_name,
        case when n.dv_hashkey_company is not null then '{resolve.CROSS}' else t.verify_method end
    from no_no t left join no_has n on t.verified_dv_hashkey_company = n.dv_hashkey_company
)"""


@query("regex_names", f"with {RESOLVED} select dv_hashkey_company, jurisdiction, pure_name, regexed_name, pure_name_replaced_by from resolved")
def regex_names(spark, sf_dir):
    return resolved_hub(spark, sf_dir).select(
        "dv_hashkey_company", "jurisdiction", "pure_name", "regexed_name", "pure_name_replaced_by"
    )


@query("regex_match_has_reg", f"with {MATCHES} select * from has_has")
def regex_match_has_reg(spark, sf_dir):
    return resolve.match_registered(
        resolved_hub(spark, sf_dir).where("registration_number is not null")
    )


@query("regex_match_no_reg", f"with {MATCHES} select * from no_no")
def regex_match_no_reg(spark, sf_dir):
    return resolve.match_unregistered(
        resolved_hub(spark, sf_dir).where("registration_number is null")
    )


@query("regex_match_cross", f"with {MATCHES} select * from no_has")
def regex_match_cross(spark, sf_dir):
    hub = resolved_hub(spark, sf_dir)
    trusted = resolve.match_registered(hub.where("registration_number is not null"))
    open_rows = resolve.match_unregistered(hub.where("registration_number is null"))
    return resolve.match_cross(
        trusted.where("verify_method is null"), open_rows.where("verify_method is null")
    )


@built_once
def name_matches(spark, sf_dir):
    """The name match table."""
    return resolve.match_by_name(resolved_hub(spark, sf_dir))


@query("regex_match_flow", f"with {MATCHES} select * from flow")
def regex_match_flow(spark, sf_dir):
    return resolve.match_by_name(resolved_hub(spark, sf_dir), stage=staged)


@query(
    "blocking_features",
    f"""with {RESOLVED} select dv_hashkey_company, jurisdiction, substring(pure_name, 1, 8) as pure_name_first_char,
        cast(len(string_split(pure_name, ' ')) - 1 as integer) as pure_name_space_count,
        cast(length(pure_name) as integer) as pure_name_length from resolved""",
)
def blocking_features_query(spark, sf_dir):
    return blocking_features(resolved_hub(spark, sf_dir), "pure_name", 8).select(
        "dv_hashkey_company", "jurisdiction", "pure_name_first_char", "pure_name_space_count",
        "pure_name_length",
    )


def _labelled(spark, sf_dir):
    """Companies under their table names, which differ in a few digits."""
    rows = companies(spark, sf_dir).drop("name").withColumnRenamed("label", "name")
    return company_hub(rows, "tpch", LOAD_TS, VERSION)


LABELLED = f"""{COMPANY},
labelled as (
    select md5(concat_ws(';', jurisdiction, registration_number, {pure_sql('label')})) as dv_hashkey_company,
        jurisdiction, registration_number, label as name, {pure_sql('label')} as pure_name,
        'tpch' as dv_recsrc, '{VERSION}' as dv_source_version
    from company
)"""


def _pairs_sql(trusted, open_rows, threshold, first, lengths, spaces, name="pairs"):
    return f"""
{name} as (
    select t.jurisdiction, t.dv_hashkey_company, t.registration_number, t.name, t.pure_name, t.dv_recsrc,
        t.dv_source_version, m.dv_hashkey_company as verified_dv_hashkey_company,
        m.pure_name as verified_pure_name, m.registration_number as verified_registration_number,
        m.name as verified_name,
        cast(greatest(length(t.pure_name), length(m.pure_name)) as integer) as max_length,
        cast(levenshtein(t.pure_name, m.pure_name) as integer) as distance,
        (1 - levenshtein(t.pure_name, m.pure_name)
            / greatest(length(t.pure_name), length(m.pure_name))) * 100 as similarity_percentage
    from ({open_rows}) t join ({trusted}) m on t.jurisdiction = m.jurisdiction
        and substring(t.pure_name, 1, {first}) = substring(m.pure_name, 1, {first})
        and abs(length(t.pure_name) - length(m.pure_name)) <= {lengths}
        and abs(len(string_split(t.pure_name, ' ')) - len(string_split(m.pure_name, ' '))) <= {spaces}
    where (1 - levenshtein(t.pure_name, m.pure_name)
        / greatest(length(t.pure_name), length(m.pure_name))) * 100 >= {threshold}
)"""


_TOP1 = """qualify row_number() over (partition by dv_hashkey_company order by similarity_percentage desc,
    verified_pure_name, verified_dv_hashkey_company) = 1"""
_TRUSTED = "select * from labelled where registration_number is not null"
_OPEN = "select * from labelled where registration_number is null"


@query(
    "levenshtein_top1",
    f"""with {LABELLED},{_pairs_sql(_TRUSTED, _OPEN, 90, 6, 3, 3)}
    select *, 'levenshtein' as verify_method from pairs {_TOP1}""",
)
def levenshtein_top1(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return levenshtein_match(
        rows.where("registration_number is null"), rows.where("registration_number is not null"),
        threshold=90,
    )


@query(
    "levenshtein_all",
    f"""with {LABELLED},{_pairs_sql(_TRUSTED, _OPEN, 85, 8, 2, 2)}
    select jurisdiction, pure_name as name_text, verified_pure_name as verified_text, distance, max_length,
        similarity_percentage, count(distinct dv_hashkey_company) as n_rows,
        count(distinct verified_dv_hashkey_company) as n_verified
    from pairs group by all""",
)
def levenshtein_all(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return matched_names(
        rows.where("registration_number is null"), rows.where("registration_number is not null"),
        threshold=85, first_chars=8, length_diff=2, space_diff=2,
    )


VERIFICATION = TableContract(
    name="s_company_levenshtein_verification",
    location="",
    unique_key=["jurisdiction", "dv_hashkey_company"],
    columns=tuple(
        {"name": name, "type": kind}
        for name, kind in [
            ("dv_hashkey_company", "string"), ("jurisdiction", "string"),
            ("verified_pure_name", "string"), ("distance", "integer"), ("dv_status", "integer"),
            ("dv_valid_from", "date"), ("dv_valid_to", "date"),
        ]
    ),
)


@query(
    "levenshtein_satellite",
    f"""with {LABELLED},{_pairs_sql(_TRUSTED, _OPEN, 92, 6, 3, 3, "p1")},{_pairs_sql(_TRUSTED, _OPEN, 88, 9, 3, 3, "p2")},
    m1 as (select * from p1 {_TOP1}), m2 as (select * from p2 {_TOP1}),
    b1 as (select dv_hashkey_company, jurisdiction, verified_pure_name, distance from m1),
    b2 as (select dv_hashkey_company, jurisdiction, verified_pure_name, distance from m2),
    fresh as (select * from b2 except select * from b1)
    select b1.*, cast(case when f.dv_hashkey_company is null then 1 else 0 end as integer) as dv_status,
        date '2024-01-01' as dv_valid_from,
        cast(case when f.dv_hashkey_company is not null then date '2024-01-31' end as date) as dv_valid_to
    from b1 left join fresh f using (dv_hashkey_company, jurisdiction)
    union all select *, 1, date '2024-02-01', null from fresh""",
)
def levenshtein_satellite(spark, sf_dir):
    """Distance matches of two runs as a history."""
    rows = _labelled(spark, sf_dir)
    trusted = rows.where("registration_number is not null")
    open_rows = rows.where("registration_number is null")
    first = staged(levenshtein_match(open_rows, trusted, threshold=92), "first")
    second = staged(levenshtein_match(open_rows, trusted, threshold=88, first_chars=9), "second")
    state = load_history(None, first, VERIFICATION, "2024-01-01")
    return load_history(state, second, VERIFICATION, "2024-02-01").drop("dv_hashdiff")


CANDIDATES = f"""{MATCHES},
trusted as (select * from resolved h where registration_number is not null and not exists (
    select 1 from flow l where verify_method is not null and h.dv_hashkey_company = l.dv_hashkey_company)),
open_rows as (select * from resolved h where registration_number is null and not exists (
    select 1 from flow l where verify_method is not null and verify_method <> '{resolve.NO_NO}'
    and h.dv_hashkey_company = l.dv_hashkey_company))"""


def _candidates(spark, sf_dir):
    return resolve.match_candidates(resolved_hub(spark, sf_dir), name_matches(spark, sf_dir))


@query(
    "match_candidates",
    f"""with {CANDIDATES} select dv_hashkey_company, jurisdiction, 'trusted' as side from trusted
    union all select dv_hashkey_company, jurisdiction, 'open' from open_rows""",
)
def match_candidates(spark, sf_dir):
    trusted, open_rows = _candidates(spark, sf_dir)
    keep = ["dv_hashkey_company", "jurisdiction"]
    return trusted.select(*keep, F.lit("trusted").alias("side")).union(
        open_rows.select(*keep, F.lit("open").alias("side"))
    )


MERGED = f"""{CANDIDATES},{_pairs_sql('select * from trusted', 'select * from open_rows', 95, 8, 2, 2)},
lev as (select *, '{resolve.LEVENSHTEIN}' as verify_method from pairs {_TOP1}),
merged as (
    select t.jurisdiction, t.dv_hashkey_company,
        coalesce(v.verified_dv_hashkey_company, t.verified_dv_hashkey_company) as verified_dv_hashkey_company,
        coalesce(v.verified_pure_name, null) as verified_pure_name,
        case when v.dv_hashkey_company is not null then '{resolve.CROSS_LEVENSHTEIN}'
            else t.verify_method end as verify_method, t.dv_recsrc
    from flow t left join lev v on t.verify_method = '{resolve.NO_NO}'
        and v.dv_hashkey_company = t.verified_dv_hashkey_company
    union all
    select jurisdiction, dv_hashkey_company, verified_dv_hashkey_company, verified_pure_name,
        verify_method, dv_recsrc
    from lev where not exists (select 1 from flow l
            where lev.dv_hashkey_company = l.verified_dv_hashkey_company)
        and not exists (select 1 from flow l where lev.dv_hashkey_company = l.dv_hashkey_company)
)"""


@built_once
def distance_matches(spark, sf_dir):
    trusted, open_rows = _candidates(spark, sf_dir)
    return levenshtein_match(
        staged(open_rows, "open"), staged(trusted, "trusted"), method=resolve.LEVENSHTEIN, threshold=95, first_chars=8, length_diff=2,
        space_diff=2,
    )


def all_matches(spark, sf_dir):
    return resolve.merge_matches(name_matches(spark, sf_dir), distance_matches(spark, sf_dir))


@query("match_merge", f"with {MERGED} select * from merged")
def match_merge(spark, sf_dir):
    return all_matches(spark, sf_dir).select(
        "jurisdiction", "dv_hashkey_company", "verified_dv_hashkey_company", "verified_pure_name",
        "verify_method", "dv_recsrc",
    )


BRIDGE = f"""{MATCHES},
bridge as (
    select verified_dv_hashkey_company as to_key, dv_hashkey_company as from_key, jurisdiction, dv_recsrc,
        null as dv_source_version
    from flow where verify_method is not null
    union all
    select dv_hashkey_company, null, jurisdiction, dv_recsrc, dv_source_version from hub
    where not exists (select 1 from flow f where verify_method is not null
        and f.jurisdiction = hub.jurisdiction
        and hub.dv_hashkey_company in (f.dv_hashkey_company, f.verified_dv_hashkey_company))
)"""


@built_once
def bridge(spark, sf_dir):
    matches = name_matches(spark, sf_dir).where("verify_method is not null")
    return golden.survivor_bridge(resolved_hub(spark, sf_dir), matches)


@query("survivor_bridge", f"with {BRIDGE} select * from bridge")
def survivor_bridge(spark, sf_dir):
    return bridge(spark, sf_dir)


@query(
    "bridge_insert_only",
    f"""with {BRIDGE} select to_key, from_key, jurisdiction, min(case when from_key is null then 'first'
        else 'second' end) as dv_source_version from bridge group by to_key, from_key, jurisdiction""",
)
def bridge_insert_only(spark, sf_dir):
    """M6: a bridge of single companies, then the whole bridge twice."""
    rows = bridge(spark, sf_dir)
    keys = ["jurisdiction", "from_key", "to_key"]
    tagged = lambda df, name: df.select(*keys).withColumn("dv_source_version", F.lit(name))
    state = merge.insert_only(None, tagged(rows.where("from_key is null"), "first"), keys)
    for _ in range(2):
        state = merge.insert_only(state, tagged(rows, "second"), keys)
    return state


@query(
    "key_repoint",
    f"""with {BRIDGE} select h.jurisdiction, h.name, coalesce((select min(to_key) from bridge b
        where b.from_key = h.dv_hashkey_company and b.from_key <> b.to_key), h.dv_hashkey_company)
        as dv_hashkey_company from hub h""",
)
def key_repoint(spark, sf_dir):
    hub = resolved_hub(spark, sf_dir).select("jurisdiction", "name", "dv_hashkey_company")
    return golden.repoint(hub, bridge(spark, sf_dir), "dv_hashkey_company")


def satellite(spark, sf_dir):
    """Attributes of companies: scalars, an array, a boolean; some are missing."""
    return companies(spark, sf_dir).withColumn("pure_name", pure_name("name")).select(
        hash_key("company").alias("dv_hashkey_company"),
        F.concat(F.lit("tpch;"), "source").alias("dv_recsrc"),
        "jurisdiction", "name",
        F.expr("case when balance > 5000 then segment end").alias("legal_form"),
        F.expr("case when balance < 0 then 'closed' else 'open' end").alias("status"),
        "balance",
        F.expr("array(segment, concat('b', k % 3))").alias("category"),
        (F.col("balance") < 0).alias("is_branch"),
        "k",
    )


GOLDEN = f"""{BRIDGE},
sat_rows as (
    select md5(concat_ws(';', jurisdiction, registration_number, {pure_sql('name')})) as dv_hashkey_company,
        'tpch;' || source as dv_recsrc, jurisdiction, name,
        case when balance > 5000 then segment end as legal_form,
        case when balance < 0 then 'closed' else 'open' end as status, balance,
        [segment, concat('b', k % 3)] as category, balance < 0 as is_branch, k
    from company
), sat as (
    select dv_hashkey_company, min(jurisdiction) as jurisdiction,
        first(name order by name, k, dv_recsrc) as name,
        first(legal_form order by name, k, dv_recsrc) filter (where legal_form is not null) as legal_form,
        first(status order by name, k, dv_recsrc) as status,
        first(balance order by name, k, dv_recsrc) as balance,
        list_distinct(flatten(list(category))) as category, bool_or(is_branch) as is_branch,
        first(k order by name, k, dv_recsrc) as k
    from sat_rows group by dv_hashkey_company
), members as (
    select distinct to_key, jurisdiction, to_key as member, 1 as priority from bridge
    union
    select to_key, jurisdiction, from_key, 2 from bridge where from_key <> to_key
), golden as (
    select m.to_key as dv_hashkey_company, m.jurisdiction,
        first(name order by priority, member) as name,
        first(legal_form order by priority, member) filter (where legal_form is not null) as legal_form,
        first(status order by priority, member) as status,
        first(balance order by priority, member) as balance,
        array_to_string(list_sort(list_distinct(flatten(list(category)))), '|') as category,
        bool_or(is_branch) as is_branch, first(k order by priority, member) as k
    from members m join sat s on m.member = s.dv_hashkey_company and m.jurisdiction = s.jurisdiction
    group by all
)"""
GOLDEN_ORDER = ["name", "k", "dv_recsrc"]
GOLDEN_COLUMNS = [
    "dv_hashkey_company", "jurisdiction", "name", "legal_form", "status", "balance", "category",
    "is_branch", "k",
]


@built_once
def golden_records(spark, sf_dir):
    return golden.golden_record(bridge(spark, sf_dir), satellite(spark, sf_dir), GOLDEN_ORDER)


@query("golden_record", f"with {GOLDEN} select {', '.join(GOLDEN_COLUMNS)} from golden")
def golden_record(spark, sf_dir):
    record = golden_records(spark, sf_dir)
    return record.withColumn("category", F.array_join("category", "|")).select(*GOLDEN_COLUMNS)


@query(
    "golden_incremental",
    f"""with {GOLDEN}, verified as (select dv_hashkey_company, jurisdiction, 'verified' as status,
            cast(null as varchar) as legal_form from golden where is_branch)
    select g.dv_hashkey_company, g.jurisdiction, coalesce(v.status, g.status) as status,
        case when v.status is null then g.legal_form else (
            select first(s.legal_form order by s.dv_hashkey_company) from members m join sat s
            on m.member = s.dv_hashkey_company and m.jurisdiction = s.jurisdiction
            where m.priority = 2 and m.to_key = g.dv_hashkey_company and m.jurisdiction = g.jurisdiction
            and s.legal_form is not null) end as legal_form
    from golden g left join verified v using (dv_hashkey_company, jurisdiction)""",
)
def golden_incremental(spark, sf_dir):
    """Survivors that were consolidated before start from that record."""
    keys = bridge(spark, sf_dir)
    records = golden_records(spark, sf_dir)
    verified = records.where("is_branch").withColumns(
        {"status": F.lit("verified"), "legal_form": F.lit(None).cast("string")}
    )
    again = golden.golden_record(
        keys, satellite(spark, sf_dir), GOLDEN_ORDER, verified=verified
    )
    return again.select("dv_hashkey_company", "jurisdiction", "status", "legal_form")


@query("golden_by_load", f"with {GOLDEN} select {', '.join(GOLDEN_COLUMNS)} from golden")
def golden_by_load(spark, sf_dir):
    """A second load and matches that came with it reach some survivors; only those are folded again."""
    keys, rows = bridge(spark, sf_dir), satellite(spark, sf_dir)
    late = keys.where("from_key is not null and crc32(from_key) % 2 = 0")
    alone = late.select("jurisdiction", F.col("from_key").alias("to_key")).union(late.select("jurisdiction", "to_key"))
    alone = alone.distinct().withColumn("from_key", F.lit(None).cast("string"))
    columns = ["to_key", "from_key", "jurisdiction"]
    before = keys.where("from_key is null or crc32(from_key) % 2 <> 0").select(*columns).unionByName(alone)
    first, second = rows.where("k % 3 <> 0"), rows.where("k % 3 = 0")
    state = staged(golden.fold_state(first, GOLDEN_ORDER), "golden-state")
    records = staged(golden.golden_record(before, first, GOLDEN_ORDER), "golden-records")
    moved = late.select(*columns).unionByName(alone)
    _, again, gone = golden.golden_changes(state, keys, second, moved, GOLDEN_ORDER)
    key = ["dv_hashkey_company", "jurisdiction"]
    now = anti(records, gone, key).unionByName(again)
    return now.withColumn("category", F.array_join("category", "|")).select(*GOLDEN_COLUMNS)
