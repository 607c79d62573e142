"""Hash keys, hash diffs and audit columns."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from ledgerloom.functions import fixed
from ledgerloom.functions.text import _col

REQUIRED_AUDIT = ("dv_recsrc", "dv_loaddts")


def hash_of(*columns, null_token=None):
    """V1: md5 of the ``;``-joined columns.

    Nulls are skipped, so that a missing part does not count; with a
    ``null_token`` they are written as that token.
    """
    texts = [_col(column).cast("string") for column in columns]
    if null_token is not None:
        texts = [F.coalesce(text, F.lit(null_token)) for text in texts]
    return F.md5(F.concat_ws(";", *texts))


def hash_key(kind, null_token=None, **renamed):
    """V1 by name of hub or link; ``renamed`` maps a key part to another column."""
    parts = [renamed.get(part, part) for part in fixed.HASH_KEYS[kind]]
    return hash_of(*parts, null_token=null_token)


def _as_text(field):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, ArrayType):
        if isinstance(field.dataType.elementType, (StructType, MapType, ArrayType)):
            return F.to_json(column)
        return F.array_join(F.transform(column, lambda x: x.cast("string")), ",", "null")
    if isinstance(field.dataType, (StructType, MapType)):
        return F.to_json(column)
    return column if isinstance(field.dataType, StringType) else column.cast("string")


def _written_out(text):
    """A text with its length in front, a null as a mark no text is written as."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hash_diff(schema, exclude=("created_at", "updated_at")):
    """V2: md5 over the payload, which is every column that is not ``dv_``.

    Each value is written with its length, a null as ``-``, so neither a value
    that moves between null columns nor a separator inside a value goes unseen.
    """
    return F.md5(
        F.concat_ws(
            ";",
            *[
                _written_out(_as_text(field))
                for field in schema.fields
                if not field.name.startswith("dv_") and field.name not in exclude
            ],
        )
    )


def with_hash_diff(df, column="dv_hashdiff", exclude=("created_at", "updated_at")):
    return df.withColumn(column, hash_diff(df.schema, exclude))


def audit_columns(record_source, load_ts=None, source_version=None):
    """Audit columns; a fixed load timestamp makes a load repeatable."""
    loaded = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    source = F.lit(record_source) if isinstance(record_source, str) else record_source
    return [
        source.alias("dv_recsrc"),
        loaded.alias("dv_loaddts"),
        F.lit(source_version).cast("string").alias("dv_source_version"),
    ]


def require_columns(df, required=REQUIRED_AUDIT):
    """The frame itself, or an error that names what is missing."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
