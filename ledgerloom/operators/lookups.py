"""Jurisdiction and country standardisation against lookup tables."""

from pyspark.sql import functions as F

from ledgerloom.functions import fixed
from ledgerloom.functions.codes import literal_map, translate
from ledgerloom.operators.dedupe import first_per_key
from ledgerloom.operators.joins import small_side


def by_containment(df, lookup, second):
    """Jurisdiction by country, and by its text within the looked-up one.

    ``lookup`` holds country_name and jurisdiction, ``second`` jurisdiction and
    country. Lookups are made for the distinct pairs of country and text, of
    which there are few, and one match is kept, the first by name; so rows
    neither fan out nor get compared with the whole lookup.
    """
    pairs = df.select("country_name", "jurisdiction").distinct()
    found = (
        pairs.alias("p")
        .join(
            small_side(lookup.where("jurisdiction is not null")).alias("l"),
            (F.upper("l.country_name") == F.upper("p.country_name"))
            & F.contains(F.upper("l.jurisdiction"), F.upper("p.jurisdiction")),
        )
        .groupBy("p.country_name", "p.jurisdiction")
        .agg(F.min("l.jurisdiction").alias("__first"))
    )
    fallback = second.groupBy(F.upper("jurisdiction").alias("__text")).agg(
        F.min("country").alias("__second")
    )
    keys = ["country_name", "jurisdiction"]
    found = found.select(*[F.col(k).alias(f"__{k}") for k in keys], "__first")
    return (
        df.join(small_side(found), [F.col(k) == F.col(f"__{k}") for k in keys], "left")
        .join(small_side(fallback), F.upper("jurisdiction") == F.col("__text"), "left")
        .withColumn("jurisdiction", F.coalesce("__first", "__second"))
        .select(*df.columns)
    )


def by_last_segment(df, lookup):
    """Jurisdiction by the last part of ``US.Texas`` within its country.

    Adds ``is_correct``; rows without a match keep what they had. An unknown
    jurisdiction is first filled with the country.
    """
    resource = (
        lookup.groupBy(
            F.lower(F.element_at(F.split("jurisdiction", "[.]"), -1)).alias("__part"),
            F.lower("country_name").alias("__lower_country"),
        )
        .agg(F.min(F.struct("jurisdiction", "country_name")).alias("__hit"))
    )
    unknown = F.col("jurisdiction").isNull() | (F.col("jurisdiction") == "Unknown")
    filled = df.withColumn(
        "jurisdiction",
        F.when(unknown & F.col("country_name").isNotNull(), F.col("country_name")).otherwise(
            F.col("jurisdiction")
        ),
    )
    joined = filled.join(
        small_side(resource),
        (F.lower("jurisdiction") == F.col("__part"))
        & (F.lower("country_name") == F.col("__lower_country")),
        "left",
    )
    correct = F.coalesce(F.col("__hit.country_name") == F.col("country_name"), F.lit(False))
    return joined.select(
        *[
            F.when(correct, F.col("__hit.jurisdiction"))
            .otherwise(F.col("jurisdiction"))
            .alias("jurisdiction")
            if name == "jurisdiction"
            else F.col(name)
            for name in df.columns
        ],
        correct.alias("is_correct"),
    )


def by_address(df):
    """Where jurisdiction and country disagree, the address decides.

    If only one of both occurs in the address, the other takes its value.
    """
    address = F.lower("full_address")
    open_row = ~F.col("is_correct")
    in_text = lambda name: F.when(open_row, F.contains(address, F.lower(name)))
    frame = df.withColumns(
        {"__juris": in_text("jurisdiction"), "__country": in_text("country_name")}
    )
    only_juris = F.col("__juris") & ~F.col("__country")
    only_country = ~F.col("__juris") & F.col("__country")
    settled = only_juris | only_country | (F.col("__juris") & F.col("__country"))
    frame = frame.withColumns(
        {
            "is_correct": F.when(settled, True).otherwise(F.col("is_correct")),
            "jurisdiction": F.when(only_country, F.col("country_name")).otherwise(
                F.col("jurisdiction")
            ),
            "country_name": F.when(only_juris, F.col("jurisdiction")).otherwise(
                F.col("country_name")
            ),
        }
    ).drop("__juris", "__country")
    return frame.withColumn(
        "is_correct",
        F.col("is_correct")
        | F.coalesce(F.col("jurisdiction") == F.col("country_name"), F.lit(False)),
    )


def by_state_code(df, lookup):
    """US state codes, official and synonymous country names.

    Rows whose result is no jurisdiction of the lookup are dropped.
    """
    us_names = {code: f"US.{name}" for code, name in fixed.US_STATES.items()}
    us_names.update(fixed.US_SPELLINGS)
    official = lookup.groupBy(F.col("official_name").alias("__official")).agg(
        F.min("jurisdiction").alias("__jurisdiction")
    )
    valid = lookup.select(F.col("jurisdiction").alias("__valid")).distinct()
    text = F.col("jurisdiction")
    is_us = F.coalesce(F.col("country_code") == "US", F.lit(False))
    missing = text.isNull() | text.isin("", fixed.HIVE_NULL_PARTITION)
    name = (
        F.when(missing, "unspecified")
        .when(is_us, F.coalesce(literal_map(us_names)[text], F.concat_ws(".", "country_code", text)))
        .otherwise(F.coalesce(F.col("__jurisdiction"), translate(text, fixed.COUNTRY_SYNONYMS)))
    )
    return (
        df.join(small_side(official), text == F.col("__official"), "left")
        .withColumn("jurisdiction", name)
        .select(*df.columns)
        .join(small_side(valid), F.col("jurisdiction") == F.col("__valid"), "left_semi")
    )


def country_names(df, lookup, code="country_code"):
    """Country name by two-letter code, in any letter case."""
    names = (
        lookup.where("alpha2_code is not null")
        .groupBy(F.upper("alpha2_code").alias("__code"))
        .agg(F.min("country_name").alias("country_name"))
    )
    return df.drop("country_name").join(
        small_side(names), F.upper(code) == F.col("__code"), "left"
    ).drop("__code")


def one_per_jurisdiction(lookup, columns):
    """A lookup with one row per jurisdiction, so that joining it never multiplies."""
    return first_per_key(lookup.select("jurisdiction", *columns), ["jurisdiction"])
