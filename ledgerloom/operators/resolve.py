"""Exact company matching on names without legal form."""

from pyspark.sql import functions as F

from ledgerloom.functions.text import prefix_pattern, suffix_pattern
from ledgerloom.operators.dedupe import first_per_key, name_quality
from ledgerloom.operators.joins import anti

SUBJECT = [
    "jurisdiction", "dv_hashkey_company", "dv_recsrc", "dv_source_version",
    "registration_number", "name", "pure_name", "regexed_name",
]
VERIFIED = {
    "dv_hashkey_company": "verified_dv_hashkey_company",
    "registration_number": "verified_registration_number",
    "regexed_name": "verified_regexed_name",
    "name": "verified_name",
}
HAS_HAS = "regexed_name_has_regis_vs_has_regis"
NO_NO = "regexed_name_no_regis_vs_no_regis"
NO_HAS = "regexed_name_no_regis_vs_has_regis"
CROSS = "regexed_name_cross_no_regis_vs_has_regis"
LEVENSHTEIN = "levenshtein_pure_name_no_regis_vs_has_regis"
CROSS_LEVENSHTEIN = "cross_levenshtein_regexed_name"


def regexed_names(df, pure="pure_name"):
    """Names without legal form, and what was cut.

    In steps, so that each pattern runs once per row, the prefixes only where
    no suffix went.
    """
    name = F.col(pure)
    cut = df.withColumn("__cut", F.regexp_replace(name, suffix_pattern(), ""))
    whole = F.col("__cut") == name
    both = cut.withColumn("__pre", F.when(whole, F.regexp_replace(name, prefix_pattern(), "")))
    return both.select(
        *df.columns,
        F.coalesce("__pre", "__cut").alias("regexed_name"),
        F.when(~whole, "suffix")
        .when(F.col("__pre") != name, "prefix")
        .alias("pure_name_replaced_by"),
    )


def _match_winner(df, keys, method):
    """Every row with the best row of its group.

    The winner comes from a per-task pre-selected row_number and goes back by a
    join, so no window ever holds a whole group. A winner and rows of equal
    name carry no method.
    """
    winner = first_per_key(df, keys, name_quality(), complete=False).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[F.col(source).alias(target) for source, target in VERIFIED.items()],
    )
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(winner, same).select(
        *SUBJECT,
        *VERIFIED.values(),
        F.when(F.col("name") != F.col("verified_name"), method).alias("verify_method"),
    )


def match_registered(df):
    """Companies with a registration number, by number and name."""
    known = df.where(F.col("jurisdiction").isNotNull() & F.col("regexed_name").isNotNull())
    return _match_winner(known, ["jurisdiction", "registration_number", "regexed_name"], HAS_HAS)


def match_unregistered(df):
    """Companies without a registration number, by name; all rows stay.

    Rows without jurisdiction or name have no winner, not even themselves.
    """
    keyed = F.col("jurisdiction").isNotNull() & F.col("regexed_name").isNotNull()
    unkeyed = df.where(~keyed).select(
        *SUBJECT, *[F.lit(None).cast("string").alias(c) for c in VERIFIED.values()],
        F.lit(None).cast("string").alias("verify_method"),
    )
    return _match_winner(df.where(keyed), ["jurisdiction", "regexed_name"], NO_NO).unionByName(unkeyed)


def match_cross(trusted, to_verify):
    """One unregistered winner per name against one registered winner."""
    keys = ["jurisdiction", "regexed_name"]
    subject = first_per_key(to_verify.select(*SUBJECT), keys, name_quality(), complete=False)
    master = first_per_key(trusted.select(*SUBJECT), keys, name_quality(), complete=False).select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[F.col(source).alias(target) for source, target in VERIFIED.items()],
    )
    return subject.join(master, [F.col(k) == F.col(f"__{k}") for k in keys]).select(
        *SUBJECT, *VERIFIED.values(), F.lit(NO_HAS).alias("verify_method")
    )


def match_by_name(df, stage=lambda frame, name: frame):
    """E5: the whole flow; ``stage`` may write the two first results out."""
    registered = stage(match_registered(df.where("registration_number is not null")), "registered")
    unregistered = stage(match_unregistered(df.where("registration_number is null")), "unregistered")
    cross = match_cross(
        registered.where("verify_method is null"), unregistered.where("verify_method is null")
    ).select(
        F.col("dv_hashkey_company").alias("__winner"),
        *[F.col(c).alias(f"__{c}") for c in VERIFIED.values()],
    )
    resolved = unregistered.join(
        cross, F.col("verified_dv_hashkey_company") == F.col("__winner"), "left"
    ).select(
        *SUBJECT,
        *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) for c in VERIFIED.values()],
        F.when(F.col("__winner").isNotNull(), CROSS)
        .otherwise(F.col("verify_method"))
        .alias("verify_method"),
    )
    return registered.unionByName(resolved)


def match_candidates(companies, verified):
    """Trusted companies, and those still to verify."""
    key = ["dv_hashkey_company"]
    merged = verified.where("verify_method is not null")
    trusted = anti(companies.where("registration_number is not null"), merged, key, null_safe=False)
    open_rows = anti(
        companies.where("registration_number is null"),
        merged.where(F.col("verify_method") != NO_NO),
        key,
        null_safe=False,
    )
    return trusted, open_rows


def merge_matches(regex, levenshtein, base=None):
    """The verification table from both match tables, as one plan.

    Name matches go in first. Where the winner of an unregistered name match
    was itself matched by edit distance, its rows point on to that company.
    Then the distance matches go in, but for those winners.
    """
    keys = ["jurisdiction", "dv_hashkey_company"]
    table = regex if base is None else base.unionByName(anti(regex, base, keys), allowMissingColumns=True)
    table = first_per_key(table, keys, [F.col("verified_dv_hashkey_company").asc_nulls_last()])
    onward = first_per_key(
        levenshtein, ["dv_hashkey_company"], [F.col("verified_dv_hashkey_company").asc()]
    ).select(
        F.col("dv_hashkey_company").alias("__via"),
        *[
            F.col(c).alias(f"__{c}")
            for c in (
                "verified_dv_hashkey_company", "verified_registration_number",
                "verified_pure_name", "verified_name",
            )
        ],
    )
    moved = (F.col("verify_method") == NO_NO) & F.col("__via").isNotNull()
    if "verified_pure_name" not in table.columns:
        table = table.withColumn("verified_pure_name", F.lit(None).cast("string"))
    pointed = table.join(
        onward, F.col("verified_dv_hashkey_company") == F.col("__via"), "left"
    ).select(
        *[
            (
                F.when(moved, CROSS_LEVENSHTEIN).otherwise(F.col(c))
                if c == "verify_method"
                else F.when(moved, F.col(f"__{c}")).otherwise(F.col(c))
                if c in ("verified_dv_hashkey_company", "verified_registration_number",
                         "verified_pure_name")
                else F.col(c)
            ).alias(c)
            for c in table.columns
        ]
    )
    winners = regex.select(F.col("verified_dv_hashkey_company").alias("dv_hashkey_company"))
    added = anti(levenshtein, winners, ["dv_hashkey_company"], null_safe=False)
    added = first_per_key(
        anti(added, table, keys), keys, [F.col("verified_dv_hashkey_company").asc()]
    )
    return pointed.unionByName(added, allowMissingColumns=True)
