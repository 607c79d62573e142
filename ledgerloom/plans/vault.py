"""Hub, link and satellite loads (V3-V7)."""

from pyspark.sql import functions as F

from ledgerloom.functions.codes import has_regnum
from ledgerloom.functions.keys import audit_columns, hash_key, require_columns
from ledgerloom.functions.text import pure_name
from ledgerloom.operators.merge import new_rows, satellite_rows, scd2
from ledgerloom.operators.joins import role_play

HUB_KEY = {
    "company": ["jurisdiction", "dv_hashkey_company"],
    "person": ["jurisdiction", "dv_hashkey_person"],
}


def company_hub(source, record_source, load_ts=None, source_version=None):
    """V3: hub rows of a company source with jurisdiction, number and name."""
    return source.withColumn("pure_name", pure_name("name")).select(
        hash_key("company").alias("dv_hashkey_company"),
        *audit_columns(record_source, load_ts, source_version),
        "jurisdiction",
        "registration_number",
        "name",
        "pure_name",
        has_regnum().alias("has_regnum"),
    )


def load_hub(base, rows, keys, order=()):
    """V3: rows to append to a hub, one per key, none that is there."""
    return new_rows(base, require_columns(rows), keys, order)


def shipment_link(shipments, parties, ports, record_source, load_ts=None, source_version=None):
    """V7: shipments joined to their parties and ports, with shipment and link hash.

    ``parties`` maps role to (frame, key column of the frame, key column of the
    shipment), or to None where the shipments have ``<role>_dv_hashkey_company`` already; ``ports`` is a frame of port_key and dv_hashkey_port.
    """
    df = shipments
    for role, (frame, key, column) in ((r, p) for r, p in parties.items() if p is not None):
        df = role_play(df, frame, {role: column}, key, ["dv_hashkey_company"])
    df = role_play(
        df, ports, {"export": "export_port_key", "import": "import_port_key"}, "port_key",
        ["dv_hashkey_port"],
    ).withColumnsRenamed({"export_dv_hashkey_port": "export_port", "import_dv_hashkey_port": "import_port"})
    return df.withColumn("dv_hashkey_bol", hash_key("bol")).select(
        hash_key("l_bol").alias("dv_hashkey_l_bol"),
        "dv_hashkey_bol",
        *audit_columns(record_source, load_ts, source_version),
        *[f"{role}_dv_hashkey_company" for role in parties],
        "export_port",
        "import_port",
        "bol",
        "actual_arrival_date",
    )


def load_satellite(base, rows, contract, parent):
    """V5: rows to append to a satellite."""
    return satellite_rows(
        base, require_columns(rows), contract.struct_type, contract.unique_key, parent
    )


def load_history(base, rows, contract, as_of, reopen=True):
    """V6: next state of a history-keeping satellite."""
    return scd2(base, rows, contract.struct_type, contract.unique_key, as_of, reopen)
