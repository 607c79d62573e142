"""Port lookup, and ports of shipments."""

from pyspark.sql import functions as F

from ledgerloom.functions import fixed
from ledgerloom.functions.codes import translate
from ledgerloom.functions.keys import audit_columns, hash_key
from ledgerloom.operators.dedupe import first_value_by
from ledgerloom.operators.frames import union_all
from ledgerloom.operators.joins import small_side
from ledgerloom.operators.nesting import joined_values

OUTPUT = [
    "port_code", "port_name", "previous_port_name", "country_name", "latitude", "longitude",
    "country_code", "jurisdiction",
]


def world_ports(listing, countries):
    """One row per port code with official name and joined aliases.

    ``listing`` has port_code, kind (Official or Alias), port_name,
    country_name, latitude and longitude; ``countries`` country and country_code.
    """
    named = lambda kind: F.when(F.col("kind") == kind, F.col("port_name"))
    order = [F.col(c) for c in ("port_name", "country_name", "latitude", "longitude")]
    country = first_value_by("country_name", order)
    ports = listing.groupBy("port_code").agg(
        first_value_by(named("Official"), order).alias("port_name"),
        F.nullif(joined_values(named("Alias")), F.lit("")).alias("previous_port_name"),
        F.when(country.contains("China Taiwan"), "Taiwan").otherwise(country).alias("country_name"),
        first_value_by("latitude", order).alias("latitude"),
        first_value_by("longitude", order).alias("longitude"),
    )
    codes = countries.groupBy(F.col("country").alias("__country")).agg(
        F.min("country_code").alias("country_code")
    )
    return (
        ports.join(small_side(codes), F.col("country_name") == F.col("__country"), "left")
        .withColumn("jurisdiction", F.col("country_name"))
        .select(*OUTPUT)
    )


def us_ports(listing):
    """US ports, state from the name's tail; short codes zero-filled."""
    tail = F.element_at(F.split("port_name", ", "), -1)
    return listing.where("port_code is not null and port_name is not null").select(
        F.when(F.length("port_code") == 3, F.concat(F.lit("0"), "port_code"))
        .otherwise(F.col("port_code"))
        .alias("port_code"),
        "port_name",
        translate(tail, fixed.US_PORT_STATES).alias("jurisdiction"),
        F.lit("United States").alias("country_name"),
        F.lit("US").alias("country_code"),
    )


def with_unspecified(ports):
    """Plus one unspecified port per jurisdiction."""
    label = F.concat(F.lit("unspecified, "), "jurisdiction")
    extra = ports.select(
        "jurisdiction", "country_name", "country_code", label.alias("port_code"),
        label.alias("port_name"),
    ).distinct()
    return union_all(ports, extra)


def port_lookup(ports, record_source, load_ts=None, source_version=None):
    """Hashed lookup; undisclosed ports share one unspecified row."""
    hidden = F.coalesce(F.col("port_code").isin(*fixed.UNDISCLOSED_PORTS), F.lit(False))
    bucketed = ports.withColumns(
        {
            name: F.when(hidden, "unspecified").otherwise(F.col(name))
            for name in ("port_code", "port_name", "country_name", "jurisdiction")
        }
    )
    return bucketed.select(
        hash_key("port").alias("dv_hashkey_port"),
        *audit_columns(record_source, load_ts, source_version),
        *[c for c in OUTPUT if c in ports.columns],
    ).distinct()


def port_names(lookup, separator="; "):
    """Every name of a port, current and former, with one code each.

    A name that several ports share goes to the smallest code, so that a
    shipment keeps one row.
    """
    former = lookup.select(
        F.explode(F.split("previous_port_name", separator)).alias("port_name"), "port_code"
    )
    both = lookup.select("port_name", "port_code").union(former).where("port_name is not null")
    return both.groupBy(F.lower(F.trim("port_name")).alias("name_key")).agg(
        F.min_by(F.struct("port_name", "port_code"), F.struct("port_code", "port_name")).alias("port")
    ).select("name_key", "port.port_name", "port.port_code")


def resolve_ports(shipments, lookup, roles):
    """Port name, code and hash per role.

    ``roles`` maps a role to (port column, country column). An unknown port is
    the unspecified port of its country.
    """
    names = port_names(lookup)
    hashes = lookup.groupBy(F.col("port_code").alias("__code")).agg(
        F.min("dv_hashkey_port").alias("__hash")
    )
    df = shipments
    for role, (port, country) in roles.items():
        named = names.select(
            F.col("name_key").alias("__key"), F.col("port_name").alias("__name"),
            F.col("port_code").alias("__found"),
        )
        fallback = F.concat_ws(", ", F.lit("unspecified"), F.col(country))
        df = (
            df.join(small_side(named), F.lower(F.trim(port)) == F.col("__key"), "left")
            .withColumns(
                {
                    f"port_name_{role}": F.when(F.col("__found").isNull(), fallback).otherwise(
                        F.col("__name")
                    ),
                    f"port_code_{role}": F.when(
                        F.col("__found").isNull(),
                        F.when(fallback == "unspecified, unspecified", "unspecified").otherwise(
                            fallback
                        ),
                    ).otherwise(F.col("__found")),
                }
            )
            .drop("__key", "__name", "__found")
            .join(small_side(hashes), F.col(f"port_code_{role}") == F.col("__code"), "left")
            .withColumnRenamed("__hash", f"{role}_port")
            .drop("__code")
        )
    return df
